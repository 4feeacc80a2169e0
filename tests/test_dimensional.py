from starload import BANK_STAR, build_star, dimension, fact, parquet_sink, read_parquet, run_star, shared_dir
from starload.plans.standin import STANDIN_STAR, bank_base, standin_base

SF = "/root/testdata/sf0.001"


def test_distinct_keeps_one_null_member(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, None), (1, None)], "a int, b int")
    assert dimension(df, ["a", "b"]).count() == 2


def test_several_rows_per_key_when_attributes_vary(spark):
    df = spark.createDataFrame([("k1", "old", "2020"), ("k1", "new", "2021"), ("k1", "new", "2022")],
                               "k string, attr string, date string")
    assert sorted(r.attr for r in dimension(df, ["k", "attr"]).collect()) == ["new", "old"]


def test_fact_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "k int, v string")
    assert fact(df, ["k", "v"]).count() == 2


def test_dimension_plan_is_partial_and_final_aggregate(spark):
    base = standin_base(spark, SF)
    plan = dimension(base, ["c_mktsegment"])._jdf.queryExecution().executedPlan().toString()
    agg_before, _, after = plan.partition("Exchange hashpartitioning(c_mktsegment")
    assert "HashAggregate(keys=[c_mktsegment" in agg_before  # final, above the exchange
    assert "HashAggregate(keys=[c_mktsegment" in after  # partial, below it


def _null_safe_orphans(fact_df, dim_df, cols):
    cond = None
    for c in cols:
        e = fact_df[c].eqNullSafe(dim_df[c])
        cond = e if cond is None else cond & e
    return fact_df.join(dim_df, cond, "left_anti").count()


def test_star_invariants_and_share_modes(spark):
    base = standin_base(spark, SF)
    n = base.count()
    results = {}
    for share in ("none", "persist", "checkpoint", "stage"):
        star = build_star(base, STANDIN_STAR, share=share)
        try:
            results[share] = {k: sorted(map(tuple, v.collect())) for k, v in star.frames.items()}
            assert star["fact"].count() == n
            for name, cols in STANDIN_STAR.dimensions.items():
                assert star[name].count() == base.select(*cols).distinct().count()
            assert _null_safe_orphans(star["fact"], star["dim_single"], ["c_mktsegment"]) == 0
        finally:
            star.release()
    assert results["none"] == results["persist"] == results["checkpoint"] == results["stage"]
    staged = build_star(base, STANDIN_STAR, share="stage")
    assert staged.staged_path and staged.staged_path.startswith(shared_dir(spark))
    assert build_star(base, STANDIN_STAR, share="none").staged_path is None


def test_bank_star_keys_resolve(spark):
    star = build_star(bank_base(standin_base(spark, SF)), BANK_STAR, share="none")
    f = star["fact_table"]
    assert _null_safe_orphans(f, star["state_dimension_table"], ["state_fips_code"]) == 0
    assert _null_safe_orphans(f, star["chartering_agency_dimension_table"], ["chartering_agency"]) == 0
    assert _null_safe_orphans(f, star["bank_dimension_table"].select("fdic_certificate_number", "city"),
                              ["fdic_certificate_number", "city"]) == 0
    # a certificate number has several bank rows when its attributes vary
    versions = star["bank_dimension_table"].groupBy("fdic_certificate_number").count()
    assert versions.where("count > 1").count() > 0


def test_run_star_writes_all_and_releases(spark, tmp_out):
    base = standin_base(spark, SF)
    star = build_star(base, STANDIN_STAR, share="persist")
    paths = run_star(star, parquet_sink(tmp_out), parallel=3)
    assert set(paths) == set(STANDIN_STAR.tables())
    assert not star.base.is_cached
    assert read_parquet(spark, paths["fact"]).count() == base.count()
    assert read_parquet(spark, paths["dim_single"]).count() == base.select("c_mktsegment").distinct().count()


def test_concurrent_writes_inherit_the_callers_job_group(spark, tmp_out):
    from starload import write_tables
    seen = {}

    def sink(df, name):
        seen[name] = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
        return name

    spark.sparkContext.setJobGroup("starload-test-group", "test")
    try:
        write_tables({"a": spark.range(1), "b": spark.range(2)}, sink, parallel=2)
    finally:
        spark.sparkContext.setJobGroup(None, None)
    assert seen == {"a": "starload-test-group", "b": "starload-test-group"}


def test_dimensions_are_derived_from_the_smallest_that_holds_them(spark, tmp_out):
    from starload.operators.lattice import Member, containment, depth
    dims = {"wide": ["a", "b", "c", "d"], "mid": ["c", "a", "b"], "pair": ["a", "b"], "same": ["b", "a"], "one": ["a"], "other": ["e"]}
    parents = containment({n: Member(c) for n, c in dims.items()})
    assert parents == {"wide": None, "mid": "wide", "pair": "mid", "same": "pair", "one": "pair", "other": None}
    assert [depth(parents, n) for n in dims] == [0, 1, 2, 3, 3, 0]
    assert set(containment({"x": Member(["A"]), "y": Member(["a", "b"])}).values()) == {None}  # names as they are written
    less = {"keyed": Member(["a", "b"], holds=["a"]), "b": Member(["b"]), "a": Member(["a"])}
    assert containment(less) == {"keyed": None, "b": None, "a": "keyed"}  # what a table holds, not what made it


def test_written_dimensions_read_the_base_only_where_no_other_holds_them(spark, tmp_out):
    import os

    from starload import write_parquet
    base_path = os.path.join(tmp_out, "base")
    write_parquet(bank_base(standin_base(spark, SF)).select(*BANK_STAR.columns()), base_path)
    for make, reads in ((parquet_sink, "/out/bank_dimension_table/"), (lambda root: _Plain(root), "/member-bank_dimension_table")):
        sink = make(os.path.join(tmp_out, "out"))
        seen = {}

        def watched(df, name):
            seen[name] = {f.removeprefix("file://") for f in df.inputFiles()}
            return sink(df, name)
        for attr in ("reread", "rereads", "mode"):
            if hasattr(sink, attr):
                setattr(watched, attr, getattr(sink, attr))
        for parallel in (1, 2, None):
            star = build_star(spark.read.parquet(base_path), BANK_STAR)
            paths = run_star(star, watched, parallel=parallel)
            assert list(paths) == BANK_STAR.tables()
            from_base = {n for n, files in seen.items() if any(f.startswith(base_path) for f in files)}
            derived = {"city_dimension_table", "chartering_agency_dimension_table"}
            staged = set() if make is parquet_sink else {"bank_dimension_table"}
            assert from_base == {"state_dimension_table", "fact_table", "bank_dimension_table"} - staged
            assert all(reads in f for n in derived for f in seen[n])
            for name, cols in BANK_STAR.dimensions.items():
                want = spark.read.parquet(base_path).select(*cols).distinct()
                got = read_parquet(spark, paths[name], want.schema)
                assert got.count() == want.count() and got.exceptAll(want).isEmpty()


class _Plain:
    """A sink that cannot give back what it wrote."""

    def __init__(self, root):
        self.inner = parquet_sink(root)

    def __call__(self, df, name):
        return self.inner(df, name)


def test_a_dimension_that_fails_fails_those_derived_from_it(spark):
    import pytest

    def sink(df, name):
        if name == "bank_dimension_table":
            raise OSError("no room")
        return name
    for parallel in (1, 2, None):
        with pytest.raises(OSError, match="no room"):
            run_star(build_star(bank_base(standin_base(spark, SF)), BANK_STAR, share="none"), sink, parallel=parallel)
