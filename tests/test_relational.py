import duckdb
import pytest

from starload import Parent, RelationalSpec, relational
from starload.functions.columns import hash_key, hash_key_sql


def test_null_positions_give_different_keys(spark):
    df = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    keys = [r.k for r in df.select(hash_key(["a", "b"]).alias("k")).collect()]
    assert keys[0] != keys[1]


def test_separator_inside_values_does_not_collide(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("~", None), (None, "~")], "a string, b string")
    keys = [r.k for r in df.select(hash_key(["a", "b"]).alias("k")).collect()]
    assert len(set(keys)) == 4


def test_sql_form_equals_spark_form(spark):
    rows = [("a|b", 1), (None, 2), ("", None), ("ü:x", 10)]
    df = spark.createDataFrame(rows, "a string, b int")
    got = [r.k for r in df.select(hash_key(["a", "b"]).alias("k")).collect()]
    con = duckdb.connect()
    con.execute("create table t(i int, a varchar, b int)")
    con.executemany("insert into t values (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(rows)])
    want = [r[0] for r in con.sql(f"select {hash_key_sql(['a', 'b'])} from t order by i").fetchall()]
    assert got == want


def test_every_child_key_has_a_parent(spark):
    df = spark.createDataFrame([(1, "A", None), (2, "A", None), (3, None, 5), (4, "B", 5)],
                               "id int, seg string, nat int")
    spec = RelationalSpec(child="c", child_columns=["id"],
                          parents=[Parent(name="p", key="pk", natural_key=["seg", "nat"])])
    out = relational(df, spec)
    assert out["p"].count() == 3
    assert out["c"].count() == 4
    assert out["c"].join(out["p"], "pk", "left_anti").count() == 0
    assert out["p"].groupBy("pk").count().where("count > 1").count() == 0


def test_bank_relational_keys_resolve_and_are_unique(spark):
    from starload import BANK_RELATIONAL
    from starload.plans.standin import bank_base, standin_base
    base = bank_base(standin_base(spark, "/root/testdata/sf0.001"))
    out = relational(base, BANK_RELATIONAL)
    child = out[BANK_RELATIONAL.child]
    assert child.count() == base.count()
    for p in BANK_RELATIONAL.parents:
        parent = out[p.name]
        assert parent.groupBy(p.key).count().where("count > 1").count() == 0, p.name
        assert child.join(parent, p.key, "left_anti").count() == 0, p.name


def test_build_relational_share_modes_agree(spark):
    from starload import BANK_RELATIONAL, build_relational
    from starload.plans.standin import bank_base, standin_base
    base = bank_base(standin_base(spark, "/root/testdata/sf0.001"))
    got = {}
    for share in ("none", "stage", "persist"):
        out = build_relational(base, BANK_RELATIONAL, share=share)
        try:
            got[share] = {k: sorted(map(tuple, v.collect()), key=repr) for k, v in out.frames.items()}
        finally:
            out.release()
    assert got["none"] == got["stage"] == got["persist"]


CITY = Parent(name="city", key="ck", natural_key=["city", "state"], references="state")
STATE = Parent(name="state", key="sk", natural_key=["state", "fips"])
CHAIN = RelationalSpec(child="c", child_columns=["id"], parents=[CITY, STATE])


def test_a_parent_holds_the_key_of_the_one_it_references(spark):
    from starload import joined_back
    rows = [(1, "A", "X", "1"), (2, "A", "X", "1"), (3, None, "X", "1"), (4, "A", None, None), (5, "B", "Y", None), (6, "A|NULL", "Z", "9")]
    df = spark.createDataFrame(rows, "id int, city string, state string, fips string")
    out = relational(df, CHAIN)
    assert out["c"].columns == ["id", "ck"] and out["city"].columns == ["ck", "city", "state", "sk"]
    assert out["city"].count() == 5 and out["state"].count() == 4
    assert out["city"].join(out["state"], "sk", "left_anti").count() == 0
    assert sorted(map(tuple, joined_back(out, CHAIN).select(*df.columns).collect())) == rows


def test_a_parent_with_two_of_the_one_it_references_is_refused(spark, tmp_out):
    from starload import load_all, parquet_sink
    for rows in ([(1, "A", "X", "1"), (2, "A", "X", "2")], [(1, "A", "X", None), (2, "A", "X", "2")]):
        df = spark.createDataFrame(rows, "id int, city string, state string, fips string")
        with pytest.raises(Exception, match=r"city: more than one row of state for A\|X"):
            relational(df, CHAIN)["city"].collect()
        with pytest.raises(Exception, match="more than one row of state"):
            load_all(df, df.schema, parquet_sink(tmp_out), "single", relational=CHAIN)


def test_references_lead_somewhere():
    for parents in ([Parent("a", "k", ["x"], references="nowhere")],
                    [Parent("a", "k", ["x"], references="b"), Parent("b", "l", ["y"], references="a")]):
        with pytest.raises(ValueError, match="references"):
            RelationalSpec(child="c", child_columns=[], parents=parents)


def test_the_snowflake_is_derived_from_written_members(spark, tmp_out):
    from starload import BANK_SNOWFLAKE, BANK_STAR, FDIC_BANKS, joined_back, load_all, parquet_sink, read_parquet
    from starload.plans.standin import bank_base, standin_base
    base = bank_base(standin_base(spark, "/root/testdata/sf0.001"))
    paths = load_all(base, "fdic_banks", parquet_sink(tmp_out), "fdic_banks", star=BANK_STAR, relational=BANK_SNOWFLAKE)
    tables = {name: read_parquet(spark, p) for name, p in paths.items()}
    assert "state_key" not in tables["institution_table"].columns
    back = joined_back(tables, BANK_SNOWFLAKE).select(*FDIC_BANKS.names)
    assert back.exceptAll(base).isEmpty() and base.exceptAll(back).isEmpty()


def test_wide_rows_stay_where_they_are_when_joined_back(spark):
    from starload import BANK_SNOWFLAKE, joined_back
    from starload.operators.relational import parents_kept
    from starload.plans.standin import bank_base, standin_base
    base = bank_base(standin_base(spark, "/root/testdata/sf0.001"), dealt=True)
    tables = parents_kept(relational(base, BANK_SNOWFLAKE), BANK_SNOWFLAKE)
    back = joined_back(tables, BANK_SNOWFLAKE)
    plan = back._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 3
    assert back.count() == base.count()
