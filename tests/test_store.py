"""Atomic and repeatable loads: a store's commits, ledger and readers."""

import os

import pytest
from pyspark.sql import types as T

from starload import CommitConflict, StarSpec, TableStore, load_all, parquet_sink, star_load

ROWS = T.StructType([T.StructField("k", T.StringType()), T.StructField("a", T.StringType()), T.StructField("v", T.IntegerType())])
SPEC = StarSpec(dimensions={"wide": ["k", "a"], "dim": ["k"]}, facts={"f": ["v", "k"]})


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def write(df, **kw):
    return lambda sink: load_all(df, ROWS, sink, "single", star=SPEC, **kw)


def held(store, version=None):
    return {t: sorted(map(str, store.read(t, version).collect())) for t in ("single", "wide", "dim", "f")}


def test_appended_loads_and_their_versions(spark, tmp_out):
    store = TableStore(spark, tmp_out)
    assert store.snapshot() is None
    with pytest.raises(KeyError):
        store.read("f")
    one, two = batch(spark, ("a", "x", 1), (None, "x", 2), ("a", "x", 1)), batch(spark, ("a", "y", 3), ("b", None, 4))
    store.load("day 1", write(one), mode="append")
    first = held(store)
    assert store.load("day 2", write(two), mode="append").version == 2
    assert held(store, 1) == first
    assert store.read("f").count() == 5 and store.read("single").count() == 5
    assert sorted(str(r.k) for r in store.read("dim").collect()) == ["None", "a", "b"]
    assert store.read("wide").count() == 4


def test_a_load_of_the_ledger_is_not_run_again(spark, tmp_out):
    store = TableStore(spark, tmp_out)
    calls = []

    def run(sink):
        calls.append(1)
        return write(batch(spark, ("a", "x", 1)))(sink)

    for _ in range(3):
        snap = store.load("day 1", run, mode="append")
    assert len(calls) == 1 and snap.version == 1 and store.read("f").count() == 1
    assert store.load("day 2", run, mode="append").version == 2 and store.read("f").count() == 2
    assert TableStore(spark, tmp_out).committed("day 1").version == 1
    assert store.committed("day 3") is None


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_a_load_that_fails_half_way_leaves_the_store_as_it_was(spark, tmp_out, mode):
    store = TableStore(spark, tmp_out)
    store.load("good", write(batch(spark, ("a", "x", 1), ("b", "x", 2))))
    before = held(store)

    def breaks(sink):
        def failing(df, table):
            if table == "dim":
                raise OSError("disk full")
            return sink(df, table)
        failing.mode = mode
        failing.existing = sink.existing
        load_all(batch(spark, ("z", "z", 9)), ROWS, failing, "single", star=SPEC, parallel=1)

    with pytest.raises(OSError, match="disk full"):
        store.load("bad", breaks, mode=mode)
    assert held(store) == before and store.snapshot().version == 1 and store.committed("bad") is None
    assert all(len(os.listdir(f"{tmp_out}/{t}")) == 1 for t in ("single", "f"))  # what was written is gone
    store.load("bad", write(batch(spark, ("z", "z", 9))), mode=mode)  # the same id may be tried again
    assert store.read("f").count() == (1 if mode == "overwrite" else 3)


def test_what_a_killed_load_leaves_is_not_read_and_can_be_dropped(spark, tmp_out):
    store = TableStore(spark, tmp_out)
    store.load("good", write(batch(spark, ("a", "x", 1))))
    before = held(store)
    batch(spark, ("z", "z", 9)).write.parquet(f"{tmp_out}/f/killed")
    open(f"{tmp_out}/_commits/.draft-0", "w").write("{half a com")
    open(f"{tmp_out}/_commits/000000000002.claim", "w").close()
    assert held(store) == before
    with pytest.raises(CommitConflict):  # the claim is taken until it is given up
        store.load("next", write(batch(spark, ("b", "x", 2))))
    assert store.vacuum() == ["f/killed"]
    assert store.load("next", write(batch(spark, ("b", "x", 2)))).version == 2
    assert store.read("dim").collect()[0].k == "b"
    store.vacuum(keep=2)
    assert held(store, 1) == before
    assert len(store.vacuum()) == 4 and store.committed("good").version == 1


def test_side_by_side_loads_the_first_to_commit_wins(spark, tmp_out):
    store = TableStore(spark, tmp_out)

    def outer(sink):
        write(batch(spark, ("outer", "x", 1)))(sink)
        store.load("inner", write(batch(spark, ("inner", "x", 2))))

    with pytest.raises(CommitConflict):
        store.load("outer", outer)
    assert [r.k for r in store.read("dim").collect()] == ["inner"] and store.committed("outer") is None


def test_other_tables_stay_and_schemas_may_widen(spark, tmp_out):
    store = TableStore(spark, tmp_out)
    store.load("1", write(batch(spark, ("a", "x", 1))))
    wider = T.StructType([T.StructField("v", T.LongType()), T.StructField("k", T.StringType()), T.StructField("new", T.StringType())])
    store.load("2", lambda sink: sink(spark.createDataFrame([(2**40, "b", "n")], wider), "f"), mode="append")
    assert sorted(map(tuple, store.read("f").collect())) == [(1, "a", None), (2**40, "b", "n")]
    assert store.read("f").schema == wider and store.read("single").count() == 1
    with pytest.raises(ValueError, match="twice"):
        store.load("3", lambda sink: [sink(spark.range(1), "t") for _ in range(2)])
    with pytest.raises(ValueError, match="folder"):
        store.load("4", lambda sink: sink(spark.range(1), "_commits"))
    assert store.snapshot().version == 2


def test_appended_members_keep_declared_types(spark, tmp_out):
    """Tables whose declared types or columns differ from the frames': two loads of each kind of sink."""
    from starload import csv_sink, read_csv, read_parquet
    declared = {"dim": T.StructType([T.StructField("k", T.StringType()), T.StructField("extra", T.StringType())]),
                "wide": T.StructType([T.StructField("v", T.StringType()), T.StructField("k", T.StringType())])}
    spec = StarSpec(dimensions={"wide": ["k", "v"], "dim": ["k"]}, facts={"f": ["v", "k"]})
    one, two = batch(spark, ("a", "x", 1), (None, "x", 2)), batch(spark, ("a", "y", 1), ("b", None, 4), (None, "y", None))
    for make, read in ((parquet_sink, read_parquet), (csv_sink, read_csv)):
        sink = make(os.path.join(tmp_out, make.__name__), mode="append", schemas=declared)
        for df in (one, two, two):
            paths = star_load(df, spec, sink)
        assert sorted(str(tuple(r)) for r in read(spark, paths["dim"], declared["dim"]).collect()) == [
            "('a', None)", "('b', None)", "(None, None)"]
        assert read(spark, paths["wide"], declared["wide"]).count() == 4
    store = TableStore(spark, os.path.join(tmp_out, "store"))
    for i, df in enumerate((one, two, two)):
        store.load(str(i), lambda sink, df=df: star_load(df, spec, sink), mode="append", schemas=declared)
    assert store.read("dim").count() == 3 and store.read("wide").count() == 4 and store.read("f").count() == 8
    assert store.read("wide").schema == declared["wide"]
