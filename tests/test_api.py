"""Argument checks and small API paths."""

import os

import pytest

from starload import (EXAMPLE, build_star, csv_sink, get_schema, read_csv, read_source, register_schema,
                      write_tables)
from starload.plans.standin import STANDIN_STAR


def test_unknown_schema_and_registration():
    with pytest.raises(KeyError):
        get_schema("no_such_table")
    register_schema("example_copy", EXAMPLE)
    assert get_schema("example_copy") == EXAMPLE


def test_bad_share_and_row_cap(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        build_star(df, STANDIN_STAR, share="sometimes")
    with pytest.raises(ValueError):
        read_source(spark, "parquet", path="/root/testdata/sf0.001/nation.parquet", row_cap=-1)


def test_csv_sink_writes_each_table(spark, tmp_out):
    frames = {"one": spark.createDataFrame([("a",)], "`Country name` string"),
              "two": spark.createDataFrame([("b",)], "`Country name` string")}
    paths = write_tables(frames, csv_sink(tmp_out, schemas={"one": EXAMPLE, "two": EXAMPLE}))
    assert paths == {"one": os.path.join(tmp_out, "one"), "two": os.path.join(tmp_out, "two")}
    assert read_csv(spark, paths["two"], EXAMPLE).collect()[0]["Country name"] == "b"


def test_a_failing_write_is_reported(spark):
    def sink(df, name):
        if name == "bad":
            raise RuntimeError("sink failed")
        return name

    with pytest.raises(RuntimeError):
        write_tables({"good": spark.range(1), "bad": spark.range(1)}, sink, parallel=2)


def test_unknown_save_mode_is_refused(spark, tmp_out):
    from starload import write_csv, write_parquet
    with pytest.raises(ValueError):
        write_parquet(spark.range(1), os.path.join(tmp_out, "p"), mode="upsert")
    with pytest.raises(ValueError):
        write_csv(spark.range(1), os.path.join(tmp_out, "c"), mode="merge")
