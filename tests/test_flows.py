import os

from pyspark.sql import types as T

from starload import extract_load, parquet_sink, read_parquet

SUPPLIER = T.StructType([
    T.StructField("s_suppkey", T.LongType()),
    T.StructField("s_name", T.StringType()),
    T.StructField("s_nationkey", T.IntegerType()),
    T.StructField("s_acctbal", T.DoubleType()),
])


def test_extract_load_from_a_csv_source(spark, tmp_out):
    supplier = spark.read.parquet("/root/testdata/sf0.01/supplier.parquet")
    src = os.path.join(tmp_out, "src_csv")
    supplier.select("s_acctbal", "s_name", "s_suppkey", "s_nationkey").write.option("header", True).csv(src)
    path = extract_load(spark, "csv", SUPPLIER, parquet_sink(tmp_out), "supplier",
                        options={"header": "true"}, path=src)
    back = read_parquet(spark, path, SUPPLIER)
    assert back.schema == SUPPLIER
    assert back.exceptAll(supplier).count() == 0 and supplier.exceptAll(back).count() == 0

    capped = extract_load(spark, "csv", SUPPLIER, parquet_sink(os.path.join(tmp_out, "capped")), "supplier",
                          options={"header": "true"}, path=src, row_cap=7)
    rows = read_parquet(spark, capped, SUPPLIER)
    assert rows.count() == 7 and rows.exceptAll(supplier).count() == 0


def test_load_all_leaves_no_staged_copy(spark, tmp_out):
    import glob

    from starload import BANK_RELATIONAL, BANK_STAR, load_all, shared_dir
    from starload.plans.standin import bank_base, standin_base
    folder = shared_dir(spark).removeprefix("file://") + "/starload/shared-base-*"
    staged_before = set(glob.glob(folder))
    base = bank_base(standin_base(spark, "/root/testdata/sf0.001"))
    paths = load_all(base, "fdic_banks", parquet_sink(tmp_out), "fdic_banks", star=BANK_STAR, relational=BANK_RELATIONAL)
    assert set(paths) == {"fdic_banks", *BANK_STAR.tables(), "institution_table",
                          *[p.name for p in BANK_RELATIONAL.parents]}
    assert set(glob.glob(folder)) == staged_before
    n = base.count()
    assert read_parquet(spark, paths["fact_table"]).count() == n
    assert read_parquet(spark, paths["institution_table"]).count() == n


def test_appended_loads_add_facts_and_only_new_members(spark, tmp_out):
    from starload import StarSpec, csv_sink, load_all, read_csv, star_load
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])
    spec = StarSpec(dimensions={"dim": ["k"]}, facts={"f": ["v", "k"]})
    first = spark.createDataFrame([("a", 1), (None, 2), ("a", 1)], schema)
    second = spark.createDataFrame([("b", 3), (None, 4), ("a", 5)], schema)
    for make, read in ((parquet_sink, read_parquet), (csv_sink, read_csv)):
        sink = make(os.path.join(tmp_out, make.__name__), mode="append")
        for rows in (first, second):
            paths = load_all(rows, schema, sink, "single", star=spec)
        assert sorted(str(r.k) for r in read(spark, paths["dim"], T.StructType([schema["k"]])).collect()) == ["None", "a", "b"]
        assert read(spark, paths["f"], T.StructType([schema["v"], schema["k"]])).count() == 6
        assert read(spark, paths["single"], schema).count() == 6
    sink = parquet_sink(os.path.join(tmp_out, "star"), mode="append")
    for rows in (first, first, second):
        paths = star_load(rows, spec, sink, parallel=1)
    assert read_parquet(spark, paths["dim"]).count() == 3 and read_parquet(spark, paths["f"]).count() == 9

    def blind(df, name):
        return name
    blind.mode = "append"
    import pytest
    with pytest.raises(ValueError, match="existing"):
        star_load(first, spec, blind)


def test_share_decisions_are_right_under_threads(spark, tmp_out):
    import sys
    from concurrent.futures import ThreadPoolExecutor

    from starload import resolve_share
    path = os.path.join(tmp_out, "plain")
    spark.range(10).write.parquet(path)
    plain = spark.read.parquet(path)
    out = sys.stdout
    with ThreadPoolExecutor(6) as pool:
        said = list(pool.map(lambda _: resolve_share(plain.filter("id > 1"), "auto"), range(48)))
    assert set(said) == {"none"} and sys.stdout is out
    assert resolve_share(plain.union(plain), "auto") == "none"
    assert resolve_share(plain.join(plain, "id"), "auto") == "stage"


def test_an_appended_load_reads_its_costly_base_once(spark, tmp_out, monkeypatch):
    from starload import StarSpec, TableStore, load_all, star_load
    from starload.plans import flows
    from starload.sinks import tables
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("k", "g", "v")])
    spec = StarSpec(dimensions={"dim": ["k", "g"], "group": ["g"]}, facts={"f": ["v", "k"]})
    copies = []

    def scratch(spark, label):
        copies.append(label)
        return os.path.join(tmp_out, f"scratch-{len(copies)}")

    def staged(base, columns, share):
        raise AssertionError("the wide rows are written once more")
    monkeypatch.setattr(tables, "scratch_path", scratch)
    monkeypatch.setattr(flows, "share_base", staged)

    def rows(*values):  # a join: no cheap base
        df = spark.createDataFrame(list(values), schema)
        return df.join(df.select("v").distinct(), "v").select("k", "g", "v")
    first, second = rows(("a", "x", "1"), (None, "x", "2")), rows(("a", "x", "3"), ("b", "y", "4"))
    sink, store = parquet_sink(os.path.join(tmp_out, "plain"), mode="append"), TableStore(spark, os.path.join(tmp_out, "store"))

    def read(name):
        return read_parquet(spark, sink.path(name)), store.read(name)
    for base, more in ((first, []), (second, ["member-dim"] * 2)):
        load_all(base, schema, sink, "single", star=spec)
        store.load(str(more), lambda s: load_all(base, schema, s, "single", star=spec), mode="append")
        assert copies == more  # tables that are not there yet get all rows and are read back
    for t in read("single"):
        assert sorted(map(str, t.select("v").collect())) == sorted(map(str, first.union(second).select("v").collect()))
    for name, n in (("dim", 3), ("group", 2), ("f", 4)):
        assert [t.count() for t in read(name)] == [n, n]
    assert not [n for n in os.listdir(sink.path("single")) if n.startswith("_load-")]


def test_appended_rows_are_told_from_older_ones(spark, tmp_out):
    sink = parquet_sink(tmp_out, mode="append", partition_by={"parts": ["k"]})
    df = spark.createDataFrame([(1,), (2,)], "k long")
    sink(df, "t")
    path, rows = sink.appended(df.selectExpr("k + 10 AS k"), "t")
    assert sorted(r.k for r in rows.collect()) == [11, 12]
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 11, 12]
    assert not sink.appends_apart(df, "parts")
    assert sink.appended(df.limit(0), "empty")[1].count() == 0
