"""Any registered Spark data source (S3-S6).

The warehouse extract of a single-machine client is re-aimed at Spark's
data source API: a warehouse connector for Spark (when installed on the
cluster), Parquet, ORC, JSON or JDBC all read in parallel on the
executors. The source's own schema fixes the columns and their order (S5);
``load_base`` then binds the declared schema by name (S6).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.columns import quoted, scratch_column
from starload.operators.conform import Rejects, conform


def read_source(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None,
                path: str | None = None, schema: T.StructType | None = None,
                row_cap: int | None = None) -> DataFrame:
    """``spark.read.format(fmt)`` with options; whole source by default.

    ``row_cap`` keeps exactly that many rows, or all if there are fewer (the
    extract cap of the original tool, made explicit); see ``capped``.
    """
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path is not None else reader.load()
    return df if row_cap is None else capped(df, int(row_cap), fmt)


#: Formats whose rows can be counted without being parsed.
_COUNTED = ("parquet", "orc")


def capped(df: DataFrame, cap: int, fmt: str) -> DataFrame:
    """The first ``cap`` rows of a source that is read as it stands.

    The rows are counted by file (Parquet) or by scan partition first; the
    running total says where the cap falls, and every task keeps its own part:
    whole files or partitions before that place, some rows of the one it falls
    in. So no task gathers the rows of others, and rows stay where they are
    read. Parquet files are taken in the order of their paths, those behind
    the cap are not read, and the same files give the same rows. Other sources
    must split alike each time they are read. A database gets the cap as a
    LIMIT of its own.
    """
    if cap < 0:
        raise ValueError("row_cap must be >= 0")
    if cap == 0 or fmt == "jdbc":
        return df.limit(cap)
    if fmt == "parquet":
        file, row = (df.metadataColumn("_metadata")[c] for c in ("file_path", "row_index"))
        at = _place(df.groupBy(file.alias("at")).agg(F.count(F.lit(1)).alias("n")), cap)
        return df if at is None else df.filter(file <= at[0]).filter((file < at[0]) | (row < at[1]))
    number = scratch_column(df)
    counted = F.count(F.lit(1)) if fmt in _COUNTED else F.count(F.struct(*[F.col(quoted(c)) for c in df.columns]))
    at = _place(df.groupBy(F.spark_partition_id().alias("at")).agg(counted.alias("n")), cap)
    if at is None:
        return df
    # the id of a row is its partition's number, then its place in the partition
    return df.withColumn(number, F.monotonically_increasing_id()).filter(
        F.col(number) < F.lit((at[0] << 33) + at[1])).drop(number)


def _place(counts: DataFrame, cap: int) -> tuple | None:
    """Where the running total of ``n`` over ``at`` reaches the cap, and how
    many rows are taken there; None if there are no more rows than that. The
    counts come in order, a partition at a time, and only up to that place."""
    before = 0
    for r in counts.orderBy("at").toLocalIterator():
        if before + r.n > cap:
            return (r["at"], cap - before)
        before += r.n
    return None


def load_base(df: DataFrame, schema: T.StructType, strict: bool = False,
              by_position: bool = False, rejects: Rejects | None = None) -> DataFrame:
    """Typed ingest: bind the declared base schema to a source frame.

    By name by default: casting, filling absent columns with NULL and
    dropping undeclared ones. ``by_position=True`` binds the i-th source
    column to the i-th declared field (for sources without usable names,
    such as header-less files); the column counts must then agree.
    ``rejects`` gets the numbers of values that a lenient cast loses.
    """
    if by_position:
        if len(df.columns) != len(schema.fields):
            raise ValueError(f"source has {len(df.columns)} columns, schema declares {len(schema.fields)}")
        df = df.toDF(*schema.names)
    return conform(df, schema, strict=strict, rejects=rejects)
