import os

from pyspark.sql import types as T

from starload import FDIC_BANKS, query_to_table, read_parquet, read_source
from starload.sinks.files import parquet_sink

CUSTOMER = "/root/testdata/sf0.001/customer.parquet"


def test_row_cap_bounds_rows_and_keeps_source_rows(spark):
    whole = read_source(spark, "parquet", path=CUSTOMER)
    capped = read_source(spark, "parquet", path=CUSTOMER, row_cap=40)
    assert capped.count() == 40
    assert capped.join(whole, capped.columns, "left_anti").count() == 0
    assert read_source(spark, "parquet", path=CUSTOMER).count() == whole.count()


def test_declared_column_missing_from_files_reads_null(spark):
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("nope", T.StringType())])
    rows = read_parquet(spark, CUSTOMER, schema).limit(3).collect()
    assert all(r.nope is None for r in rows)


def test_query_to_table_types_declared_columns(spark, tmp_out):
    base = spark.createDataFrame([(True, 1, "a"), (True, 1, "a")], "active boolean, state_fips_code int, other string")
    path = query_to_table(spark, "SELECT DISTINCT state_fips_code, active, other FROM {base};",
                          parquet_sink(tmp_out), "state_dim", schema=FDIC_BANKS, base=base)
    assert path == os.path.join(tmp_out, "state_dim")
    back = read_parquet(spark, path)
    assert back.columns == ["state_fips_code", "active", "other"]
    assert dict(back.dtypes)["state_fips_code"] == "string"
    assert back.count() == 1


def test_load_base_binds_by_position(spark):
    from starload import EXAMPLE, load_base
    df = spark.createDataFrame([("FR", "gdp", "1.5", "0.5")], "_c0 string, _c1 string, _c2 string, _c3 string")
    out = load_base(df, EXAMPLE, by_position=True)
    assert out.schema == EXAMPLE and out.collect()[0]["Value"] == 1.5
    import pytest
    with pytest.raises(ValueError):
        load_base(df.select("_c0"), EXAMPLE, by_position=True)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_cap_is_exact_and_gathers_nothing(spark, tmp_out):
    rows = spark.range(1000).selectExpr("id", "concat('t', id) AS t", "id AS _metadata")
    for fmt in ("parquet", "orc", "json", "csv"):
        path = os.path.join(tmp_out, fmt)
        rows.repartition(9).write.format(fmt).option("header", True).save(path)
        whole = {tuple(map(str, r)) for r in read_source(spark, fmt, {"header": "true"}, path=path).collect()}
        for cap in (1, 111, 112, 999, 1000, 5000):
            kept = read_source(spark, fmt, {"header": "true"}, path=path, row_cap=cap)
            assert kept.columns == read_source(spark, fmt, {"header": "true"}, path=path).columns
            got = [tuple(map(str, r)) for r in kept.collect()]
            assert len(got) == len(set(got)) == min(cap, 1000) and set(got) <= whole
            assert "Exchange" not in _plan(kept) and "Limit" not in _plan(kept)
        assert read_source(spark, fmt, path=path, row_cap=0).count() == 0
    import pytest
    with pytest.raises(ValueError):
        read_source(spark, "orc", path=os.path.join(tmp_out, "orc"), row_cap=-1)


def test_row_cap_of_parquet_leaves_the_files_behind_it_unread(spark, tmp_out):
    spark.range(0, 1000, numPartitions=10).write.parquet(tmp_out + "/p")
    kept = read_source(spark, "parquet", path=tmp_out + "/p", row_cap=250)
    assert sorted(r.id for r in kept.collect()) == list(range(250))  # the same files, the same rows
    scan = kept._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert "number of files read), value: 3)" in scan.metrics().toString()


def test_row_cap_of_an_empty_source(spark, tmp_out):
    for fmt in ("parquet", "csv"):
        spark.range(0).selectExpr("id", "id AS v").write.format(fmt).save(f"{tmp_out}/{fmt}")
        assert read_source(spark, fmt, path=f"{tmp_out}/{fmt}", schema=T.StructType([T.StructField("id", T.LongType())]),
                           row_cap=5).count() == 0
