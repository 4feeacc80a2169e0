import pytest
from pyspark.sql import types as T

from starload import EXAMPLE, FDIC_BANKS, conform, select_in_schema_order, subset_schema
from starload.schemas import sql_types


def test_declared_schemas():
    assert len(FDIC_BANKS.fields) == 121
    assert sum(isinstance(f.dataType, T.BooleanType) for f in FDIC_BANKS.fields) == 20
    assert all(f.nullable for f in FDIC_BANKS.fields)
    assert [f.name for f in EXAMPLE.fields] == ["Country name", "Series name", "Value", "value_percentile"]
    assert sql_types(EXAMPLE)["Value"] == "REAL"


def test_conform_extra_missing_shuffled(spark):
    df = spark.createDataFrame([("1.5", "x", "FR", 7), ("2", "y", "DE", 8)],
                               "Value string, `Series name` string, `Country name` string, extra int")
    out = conform(df, EXAMPLE)
    assert out.schema == EXAMPLE
    rows = sorted(out.collect())
    assert rows[0]["Country name"] == "DE" and rows[0]["Value"] == 2.0
    assert rows[1]["value_percentile"] is None and rows[1]["Value"] == 1.5


def test_lenient_and_strict_cast(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "Value string")
    got = [r.Value for r in conform(df, EXAMPLE).collect()]
    assert got == [1.5, None, None]
    with pytest.raises(Exception):
        conform(df, EXAMPLE, strict=True).collect()


def test_conform_is_idempotent(spark):
    df = spark.createDataFrame([("a", "b", "3")], "`Country name` string, `Series name` string, Value string")
    once = conform(df, EXAMPLE)
    twice = conform(once, EXAMPLE)
    assert once.schema == twice.schema
    assert once.collect() == twice.collect()


def test_conform_matches_case_insensitively(spark):
    df = spark.createDataFrame([("a",)], "`COUNTRY NAME` string")
    assert conform(df, EXAMPLE).collect()[0]["Country name"] == "a"


def test_subset_keeps_declared_order(spark):
    sub = subset_schema(FDIC_BANKS, ["city", "unknown", "fdic_certificate_number", "state_name"])
    assert sub.names == ["fdic_certificate_number", "state_name", "city"]
    df = spark.createDataFrame([("c", "x", "1")], "city string, unknown string, fdic_certificate_number string")
    assert select_in_schema_order(df, FDIC_BANKS).columns == ["fdic_certificate_number", "city"]


def test_conform_is_one_projection(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    schema = T.StructType([T.StructField("c_custkey", T.StringType()),
                           T.StructField("missing", T.BooleanType())])
    plan = conform(df, schema)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint>" in plan


def test_subset_and_declared_types_ignore_case(spark):
    from starload import FDIC_BANKS, subset_schema, type_declared
    assert subset_schema(FDIC_BANKS, ["ACTIVE", "State_Name"]).names == [
        n for n in FDIC_BANKS.names if n in ("active", "state_name")]
    typed = type_declared(spark.sql("select 1 as State_Fips_Code, 'true' as ACTIVE"), FDIC_BANKS)
    assert dict(typed.dtypes) == {"State_Fips_Code": "string", "ACTIVE": "boolean"}


CASTS = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("Day", T.DateType()), T.StructField("s", T.StringType()),
                      T.StructField("absent", T.IntegerType())])
TEXTS = [("1", "2024-01-01", "a", 1), ("x", "2024-13-01", "b", 2), (None, None, None, 3), ("", "never", "c", 4), ("9" * 12, "2024-02-29", "d", 5)]


def test_rejects_are_counted_by_the_pass_that_writes(spark, tmp_out):
    from starload import Rejects, rejected_rows, write_parquet
    df = spark.createDataFrame(TEXTS, "n string, day string, s string, `my id` int")
    rejects = Rejects()
    out = conform(df, CASTS, rejects=rejects)
    assert "CollectMetrics" in out._jdf.queryExecution().executedPlan().toString()
    write_parquet(out, tmp_out)
    assert rejects.counts() == {"n": 3, "Day": 2, "s": 0, "absent": 0} and rejects.total() == 5
    assert sorted(map(tuple, rejects.frame(spark).collect())) == [("Day", 2), ("absent", 0), ("n", 3), ("s", 0)]
    assert {(r["my id"], *r.rejected) for r in rejected_rows(df, CASTS).collect()} == {(2, "n", "Day"), (4, "n", "Day"), (5, "n")}
    with pytest.raises(ValueError, match="another frame"):
        conform(df, CASTS, rejects=rejects)
    same, strict = Rejects(), Rejects()
    conform(df, df.schema, rejects=same)
    conform(df, CASTS, strict=True, rejects=strict)
    assert set(same.counts().values()) == {0} and set(strict.counts().values()) == {0}
    assert rejected_rows(df, df.schema).count() == 0


@pytest.mark.parametrize("share", ["none", "stage", "auto"])
def test_a_load_counts_its_rejects_once(spark, tmp_out, share):
    """Whatever number of tables reads the rows."""
    from starload import Rejects, StarSpec, load_all, parquet_sink
    rejects = Rejects()
    df = spark.createDataFrame(TEXTS, "n string, day string, s string, `my id` int")
    load_all(df, CASTS, parquet_sink(tmp_out), "single", star=StarSpec({"d": ["n", "s"], "e": ["s"]}, {"f": ["Day", "n"]}),
             share=share, rejects=rejects)
    assert rejects.counts() == {"n": 3, "Day": 2, "s": 0, "absent": 0}


def test_an_extract_writes_the_rows_it_rejects(spark, tmp_out):
    from starload import Rejects, extract_load, parquet_sink
    source = f"{tmp_out}/source"
    spark.createDataFrame(TEXTS, "n string, day string, s string, `my id` int").write.parquet(source)
    rejects = Rejects()
    extract_load(spark, "parquet", CASTS, parquet_sink(tmp_out), "t", path=source, rejects=rejects, reject_table="t_rejected")
    bad = spark.read.parquet(f"{tmp_out}/t_rejected")
    assert sorted(r["my id"] for r in bad.collect()) == [2, 4, 5] and rejects.total() == 5
    assert spark.read.parquet(f"{tmp_out}/t").count() == 5
