"""JDBC option building. No database is started in these tests, so the
reads and writes themselves are not exercised here."""

import pytest

from starload import EXAMPLE, JdbcConnection, JdbcPartitioning, create_table_column_types
from starload.sinks.jdbc import jdbc_write_options
from starload.sources.jdbc import jdbc_read_options


def test_connection_hides_password():
    c = JdbcConnection.postgres("db", 5432, "bank", "u", "secret")
    assert c.url == "jdbc:postgresql://db:5432/bank"
    assert "secret" not in repr(c)
    assert c.options()["password"] == "secret"


def test_partitioned_read_options():
    c = JdbcConnection("jdbc:x")
    o = jdbc_read_options(c, table="t", partitioning=JdbcPartitioning("id", 0, 1000, 4))
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4" and o["dbtable"] == "t"


def test_column_types_quote_and_skip_unbounded():
    types = create_table_column_types(EXAMPLE, {"Country name": 80})
    assert types == "`Country name` VARCHAR(80)"
    assert create_table_column_types(EXAMPLE) == ""




def test_overwrite_truncates_and_caps_connections():
    o = jdbc_write_options(JdbcConnection("jdbc:x"), "t", EXAMPLE, {"Series name": 40}, "overwrite", 8)
    assert o["truncate"] == "true" and o["numPartitions"] == "8"
    assert o["createTableColumnTypes"] == "`Series name` VARCHAR(40)"
    assert "truncate" not in jdbc_write_options(JdbcConnection("jdbc:x"), "t", mode="append")


def test_column_types_parse_as_spark_ddl(spark):
    """The writer parses createTableColumnTypes with Spark's DDL parser."""
    from starload import FDIC_BANKS
    lengths = {f.name: 64 for f in FDIC_BANKS.fields if f.dataType.typeName() == "string"}
    ddl = create_table_column_types(FDIC_BANKS, lengths)
    from pyspark.sql import types as T
    parsed = T.StructType.fromDDL(ddl)
    assert len(parsed.fields) == 101
    assert [f.name for f in parsed.fields] == list(lengths)
    assert all(f.dataType == T.VarcharType(64) for f in parsed.fields)
    weird = create_table_column_types(EXAMPLE, {"Country name": 80, "Series name": 10})
    assert [f.name for f in T.StructType.fromDDL(weird).fields] == ["Country name", "Series name"]


def test_predicate_read_properties_carry_credentials_not_url():
    from starload.sources.jdbc import jdbc_properties
    props = jdbc_properties(JdbcConnection("jdbc:x", user="u", password="p", driver="d", properties={"ssl": "true"}), 500)
    assert props == {"user": "u", "password": "p", "driver": "d", "ssl": "true", "fetchsize": "500"}


def test_numeric_bounds_become_whole_numbers():
    from decimal import Decimal

    from starload.sources.jdbc import whole_bounds
    assert whole_bounds(Decimal("-1.500000"), Decimal("9.000001")) == (-2, 10)
    assert whole_bounds(0.5, 1.5) == (0, 2) and whole_bounds("2020-01-01", "2021-01-01") == ("2020-01-01", "2021-01-01")


def test_overwriting_a_table_that_is_read_is_refused(spark):
    from starload.sinks.jdbc import assert_table_not_read
    from starload.sources.inputs import jdbc_tables
    url = "jdbc:postgresql://h:1/d"
    for source in ("banks", '"Banks"', "(select * from banks) t", "(SELECT a FROM x, banks)"):
        with pytest.raises(ValueError, match="refusing"):
            assert_table_not_read({(url, source)}, url, "banks")
        assert_table_not_read({(url + "2", source)}, url, "banks")
    assert_table_not_read({(url, "banks_old"), (url, "(select * from banks_old) t")}, url, "banks")
    assert jdbc_tables(spark.range(3).selectExpr("id")) == set()


def _quantiles(con, table, column, parts):
    """The query and the predicates, run by a database in this process."""
    from starload.sources.jdbc import quantile_predicates, quantile_query
    bounds = [r[0] for r in con.execute(quantile_query(table, column, parts)).fetchall()]
    preds = quantile_predicates(column, bounds)
    return preds, [con.execute(f"select count(*) from {table} where {p}").fetchone()[0] for p in preds]


@pytest.mark.parametrize("value", [
    "i * i * i",  # equal widths would put nearly all rows in the first of them
    "(i * i)::decimal(18, 3) / 7", "i::double / 3", "timestamp '2020-01-01' + to_seconds(i * i)", "date '2020-01-01' + i::integer",
    "'o''k ' || lpad(i::varchar, 9, '0')"])
def test_quantile_predicates_share_skewed_keys_evenly(value):
    import duckdb
    con = duckdb.connect()
    con.execute(f"create table t as select {value} as k from range(10000) r(i) union all select null from range(100)")
    preds, counts = _quantiles(con, "t", "k", 16)
    assert len(preds) == 16 and sum(counts) == 10100
    assert max(counts) <= 1.3 * 10000 / 16  # NULL goes with the first


def test_a_hot_key_gets_a_task_of_its_own():
    import duckdb
    con = duckdb.connect()
    con.execute("create table t as select case when i % 3 = 0 then 500 else i end as k from range(9000) r(i)")
    preds, counts = _quantiles(con, "t", "k", 12)
    assert sum(counts) == 9000 and "k = 500" in preds
    rest = [n for p, n in zip(preds, counts) if p != "k = 500"]
    assert counts[preds.index("k = 500")] == 3000 + 1 and max(rest) <= 800
    con.execute("create or replace table t as select 7 as k from range(50)")
    preds, counts = _quantiles(con, "t", "k", 4)
    assert sum(counts) == 50 and max(counts) == 50 and len(preds) == 3


def test_quantile_predicates_hold_rows_that_come_later():
    import duckdb

    from starload.sources.jdbc import literal, quantile_predicates
    con = duckdb.connect()
    con.execute("create table t(k integer)")
    assert _quantiles(con, "t", "k", 5) == (["1 = 1"], [0])
    for bounds in ([10], [10, 20, 30], [10, 10, 30], [10, 30, 30], [10, 10], [10, 10, 10, 20]):
        preds = quantile_predicates("k", bounds)
        for k in (None, -5, 10, 11, 20, 29, 30, 99):
            hits = [p for p in preds if con.execute(f"select count(*) from (select {'null' if k is None else k} as k) where {p}").fetchone()[0]]
            assert len(hits) == 1, (bounds, k, preds)
    for bad in (None, True, float("nan"), b"x"):
        with pytest.raises(TypeError):
            literal(bad)
