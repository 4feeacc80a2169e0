import os

import pytest
from pyspark.sql import types as T

from starload import EXAMPLE, read_csv, read_parquet, write_csv, write_parquet
from starload.sinks.files import assert_not_reading


def test_parquet_roundtrip_and_append(spark, tmp_out):
    df = spark.createDataFrame([("FR", "gdp", "1.5", "x")], "`Country name` string, `Series name` string, Value string, junk string")
    path = os.path.join(tmp_out, "example")
    write_parquet(df, path, schema=EXAMPLE)
    back = read_parquet(spark, path, EXAMPLE)
    assert back.schema == EXAMPLE and back.collect()[0]["Value"] == 1.5
    write_parquet(df, path, schema=EXAMPLE, mode="append")
    assert read_parquet(spark, path, EXAMPLE).count() == 2


def test_partition_value_keeps_leading_zero(spark, tmp_out):
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("v", T.StringType())])
    df = spark.createDataFrame([("01", "x"), ("10", "y")], schema)
    path = os.path.join(tmp_out, "codes")
    write_parquet(df, path, partition_by=["code"])
    assert sorted(os.listdir(path))[:2] == ["_SUCCESS", "code=01"] or "code=01" in os.listdir(path)
    back = read_parquet(spark, path, schema)
    assert back.columns == ["code", "v"]
    assert sorted(r.code for r in back.collect()) == ["01", "10"]
    write_parquet(df, path + "_noshuffle", partition_by=["code"], shuffle=False)
    assert sorted(r.code for r in read_parquet(spark, path + "_noshuffle", schema).collect()) == ["01", "10"]


def test_partitioned_write_plan_rebalances(spark):
    from starload.sinks.files import rebalance
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    plan = rebalance(df, ["c_mktsegment"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_refuses_to_overwrite_its_own_input(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    with pytest.raises(ValueError):
        write_parquet(df, path)
    with pytest.raises(ValueError):
        assert_not_reading(df, "file:" + path)
    with pytest.raises(ValueError):
        assert_not_reading(df, os.path.relpath(path))
    assert_not_reading(df, path + "_other")
    assert spark.read.parquet(path).count() == 5
    df.createOrReplaceTempView("read_before")
    for through in (spark.sql("select 1 as a where 3 in (select id from read_before)"), df.join(spark.range(2), "id"),
                    df.groupBy("id").count(), df.unionAll(spark.range(1))):
        with pytest.raises(ValueError):
            assert_not_reading(through, path)
        with pytest.raises(ValueError):
            assert_not_reading(through, tmp_out)  # the folder above
        assert_not_reading(through, tmp_out + "_other")
    os.makedirs(path + "/_apart")
    assert_not_reading(spark.read.parquet(path), path + "/_apart")  # below the root, but not of the table
    kept = spark.range(3).checkpoint() if spark.sparkContext.getCheckpointDir() else spark.range(3)
    assert_not_reading(kept, path)


def test_csv_keeps_nulls_empty_strings_quotes_and_newlines(spark, tmp_out):
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("v", T.FloatType()),
                           T.StructField("f", T.BooleanType())])
    rows = [("", None, True), (None, 1.5, None), ('a,"b"\nc', 2.5, False),
            ("\\N", 3.5, True), ("\\", None, None), ("\\\\N", 0.0, False), ('"\\N"', -1.0, True)]
    df = spark.createDataFrame(rows, schema)
    path = os.path.join(tmp_out, "csv")
    write_csv(df, path, schema=schema)
    back = read_csv(spark, path, schema)
    key = lambda r: (r[0] is None, r[0] or "")
    assert sorted(map(tuple, back.collect()), key=key) == sorted(rows, key=key)


def test_hot_partition_value_is_split_cold_ones_are_not(spark, tmp_out):
    """One value holds a third of all rows: it is written by several tasks,
    while every other value stays in one file."""
    import glob

    from pyspark.sql import functions as F
    df = (spark.range(0, 300000, numPartitions=16)
          .select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
                  F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad")))
    path = os.path.join(tmp_out, "skewed")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "4m")
    try:
        write_parquet(df, path, partition_by=["k"])
    finally:
        spark.conf.set(key, old)
    assert len(glob.glob(path + "/k=hot/*.parquet")) > 1
    cold = [len(glob.glob(d + "/*.parquet")) for d in glob.glob(path + "/k=[0-9]*")]
    # values hashed together with the hot one are split with it; the rest
    # stay whole, far from one file per value per input task (16 each)
    assert len(cold) == 50 and cold.count(1) >= 35 and sum(cold) < 100
    back = read_parquet(spark, path)
    assert back.count() == 300000 and back.where("k = 'hot'").count() == 100000


def test_csv_roundtrip_of_typed_base_is_exact(spark, tmp_out):
    from starload.plans.standin import STANDIN_SCHEMA, standin_base
    base = standin_base(spark, "/root/testdata/sf0.001")
    path = os.path.join(tmp_out, "base_csv")
    write_csv(base, path, schema=STANDIN_SCHEMA)
    back = read_csv(spark, path, STANDIN_SCHEMA)
    assert back.schema == STANDIN_SCHEMA
    assert back.exceptAll(base).count() == 0 and base.exceptAll(back).count() == 0


def test_csv_read_refuses_a_header_that_does_not_match(spark, tmp_out):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    path = os.path.join(tmp_out, "ab")
    write_csv(spark.createDataFrame([("1", "2")], "b string, a string"), path)
    with pytest.raises(Exception):
        read_csv(spark, path, schema).collect()
    assert read_csv(spark, path, T.StructType(list(reversed(schema.fields)))).collect()[0].a == "2"


def test_partitioned_write_keeps_odd_names_and_values(spark, tmp_out):
    import pytest
    from pyspark.sql import types as T

    from starload import read_parquet, write_parquet
    schema = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("a.b", T.StringType()),
                           T.StructField("Country name", T.StringType())])
    rows = [(1, "01", "x y"), (2, None, "x/y"), (3, "1", None), (4, "01", "x y")]
    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            path = f"{tmp_out}/parts-{adaptive}"
            write_parquet(spark.createDataFrame(rows, schema), path, partition_by=["a.b", "Country name"])
            back = read_parquet(spark, path, schema)
            assert sorted(map(tuple, back.collect())) == rows
            with pytest.raises(Exception, match="empty string"):
                write_parquet(spark.createDataFrame([(1, "", "z")], schema), path + "-bad", partition_by=["a.b"])
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_csv_refuses_what_it_cannot_hold_and_bad_values(spark, tmp_out):
    import pytest
    from pyspark.sql import types as T

    from starload import read_csv, write_csv
    with pytest.raises(ValueError, match="no exact form"):
        write_csv(spark.sql("select cast('x' as binary) as b"), f"{tmp_out}/b")
    schema = T.StructType([T.StructField("v", T.FloatType())])
    spark.createDataFrame([("abc",), ("1.5",)], "v string").write.option("header", True).csv(f"{tmp_out}/bad")
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, f"{tmp_out}/bad", schema).collect()
    assert sorted(map(str, read_csv(spark, f"{tmp_out}/bad", schema, strict=False).collect())) == ["Row(v=1.5)", "Row(v=None)"]


def test_without_adaptive_execution_values_are_split_by_their_size(spark, tmp_out):
    """A third of all rows on one value makes a third of the tasks write it;
    every other value, NULL too, stays in one file."""
    import glob

    from pyspark.sql import functions as F

    from starload.sinks.files import heavy_values
    df = spark.range(0, 60000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 < 49, (F.col("id") % 50).cast("string")).alias("k 1"),
        (F.col("id") % 2 == 0).alias("even"), "id", F.lit("x").alias("parts"), F.lit("y").alias("v0"))
    heavy = {r.v0: r.parts for r in heavy_values(df, ["k 1"], 30).collect()}
    assert heavy == {"hot": 10}
    assert {(r.v0, r.v1): r.parts for r in heavy_values(df, ["k 1", "even"], 30).collect()} == {("hot", True): 5, ("hot", False): 5}
    path = os.path.join(tmp_out, "skewed")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        write_parquet(df, path, partition_by=["k 1"])
        write_parquet(df.limit(0), path + "-empty", partition_by=["k 1"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    files = {os.path.basename(d): len(glob.glob(d + "/*.parquet")) for d in glob.glob(path + "/k 1=*")}
    assert 5 <= files.pop("k 1=hot") <= 10  # ten parts, some of which a task writes together
    assert len(files) == 50 and set(files.values()) == {1}
    back = read_parquet(spark, path, df.schema)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


LINES = ["", None, "\\", "\\n", "\\N", "\\\\N", "\n", "\r\n", "a\\\nb", "\\\\n\\r\r", 'q"\n"', " \n ", ",\n,", "\\\\\\", "é \x85\n", "x" * 9 + "\n"]


def test_escaped_line_breaks_round_trip_and_split(spark, tmp_out):
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("a b", T.StringType()), T.StructField("c", T.StringType())])
    rows = [(i, a, c) for i, (a, c) in enumerate((a, c) for a in LINES for c in LINES)]
    path = os.path.join(tmp_out, "lines")
    df = spark.createDataFrame(rows * 20, schema).coalesce(1)
    write_csv(df, path, line_breaks="escaped")
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "20000")
    try:
        back = read_csv(spark, path, schema, line_breaks="escaped")
        assert back.rdd.getNumPartitions() > 3  # one file, several tasks
        assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows * 20))
    finally:
        spark.conf.unset(key)
    with pytest.raises(ValueError, match="line_breaks"):
        read_csv(spark, path, schema, line_breaks="other")
    with pytest.raises(ValueError, match="header"):
        write_csv(spark.range(1).toDF("a\nb"), path + "2", line_breaks="escaped")


def test_a_csv_sink_reads_its_escaped_tables_back(spark, tmp_out):
    from starload import StarSpec, csv_sink, star_load
    sink = csv_sink(tmp_out, mode="append", line_breaks="escaped")
    df = spark.createDataFrame([(t,) for t in LINES], "t string")
    for _ in range(2):
        paths = star_load(df, StarSpec({"d": ["t"]}, {"f": ["t"]}), sink)
    back = read_csv(spark, paths["d"], df.schema, line_breaks="escaped")
    assert sorted(repr(r.t) for r in back.collect()) == sorted(map(repr, LINES))
    assert read_csv(spark, paths["f"], df.schema, line_breaks="escaped").count() == 2 * len(LINES)
