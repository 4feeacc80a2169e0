"""Property tests: each example set runs as one Spark job."""

import os
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from starload import read_csv, write_csv
from starload.functions.columns import hash_key

text = st.one_of(st.none(), st.text(alphabet=st.sampled_from(list('ab,"|~:\\N\n\r ;ü')), max_size=6))
SETTINGS = settings(max_examples=25, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(text, text), min_size=1, max_size=40))
def test_csv_round_trip_is_exact_for_any_text(spark, tmp_path, rows):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    path = os.path.join(str(tmp_path), uuid.uuid4().hex)
    write_csv(spark.createDataFrame(rows, schema), path)
    back = [tuple(r) for r in read_csv(spark, path, schema).collect()]
    assert sorted(back, key=repr) == sorted(rows, key=repr)


@SETTINGS
@given(st.lists(st.tuples(text, text), min_size=1, max_size=40, unique=True))
def test_hash_key_is_injective_on_distinct_tuples(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string")
    keys = [r.k for r in df.select(hash_key(["a", "b"]).alias("k")).collect()]
    assert len(set(keys)) == len(rows)


names = st.sampled_from(["Country name", "Series name", "Value", "value_percentile", "extra", "Other col"])


@SETTINGS
@given(st.lists(names, min_size=1, max_size=6, unique=True), st.lists(text, min_size=6, max_size=6))
def test_conform_gives_the_declared_schema_by_name_and_is_idempotent(spark, cols, values):
    from starload import EXAMPLE, conform
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    row = tuple(values[: len(cols)])
    df = spark.createDataFrame([row], schema)
    once = conform(df, EXAMPLE)
    assert once.schema == EXAMPLE
    got = once.collect()[0].asDict()
    given_by_name = dict(zip(cols, row))
    assert got["Country name"] == given_by_name.get("Country name")
    assert got["Series name"] == given_by_name.get("Series name")
    assert repr(conform(once, EXAMPLE).collect()) == repr(once.collect())  # repr: NaN != NaN
