"""File sinks: Parquet (W1-W3) and CSV (W4).

A declared schema is applied with ``conform`` before writing, so the files
carry exactly the declared columns and types. Overwriting a path that the
same plan reads is refused (the overwrite would delete the input first).

Partitioned writes use Spark's REBALANCE on the partition columns: rows of
one partition value are gathered, and adaptive execution splits any value
too large for one task (a hot value holding a third of all rows is written
by many tasks) and merges small ones, so there are neither huge tasks nor a
file per value per input task. With adaptive execution off, values are counted
first: one that holds more rows than a task's share is dealt into as many parts
as shares, all others stay whole.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.columns import quoted, scratch_column
from starload.operators.conform import conform
from starload.session import _context
from starload.sources.files import CSV_OPTIONS, csv_escape_exprs, read_csv, read_parquet
from starload.sources.inputs import file_roots

log = logging.getLogger("starload")


def _norm(path: str) -> str:
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return path.rstrip("/")


def _qualify(spark, path: str) -> tuple[str, bool | None]:
    """The path qualified by its Hadoop FileSystem (relative paths resolved
    as Spark resolves them) and whether it exists; unchanged and None when
    the JVM is not reachable (Spark Connect)."""
    sc = _context(spark)
    if sc is None:
        log.warning("no JVM at hand: %s is compared with the inputs as it is written", path)
        return path, None
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    return str(fs.makeQualified(hpath).toString()), bool(fs.exists(hpath))


def assert_not_reading(df: DataFrame, path: str) -> None:
    """Refuse to overwrite ``path`` when ``df`` reads files under it.

    An absent target is settled by one ``exists`` call; otherwise the roots of
    the tables that the frame reads are compared with it. Only a target below
    such a root has the table's files listed.
    """
    qualified, exists = _qualify(df.sparkSession, path)
    if exists is False:
        return  # nothing there yet, so nothing of it can be read
    target = _norm(qualified)
    read = set(df.inputFiles()) if exists is None else file_roots(df)
    if any(target.startswith(_norm(r) + "/") for r in read):
        read |= set(df.inputFiles())
    for src in sorted(map(_norm, read)):
        if src == target or src.startswith(target + "/"):
            raise ValueError(f"refusing to overwrite {path}: the frame reads from it ({src})")


def _prepare(df: DataFrame, path: str, schema: T.StructType | None, mode: str,
             strict: bool) -> DataFrame:
    if mode not in ("overwrite", "append", "error", "errorifexists", "ignore"):
        raise ValueError(f"unknown save mode {mode!r}")
    if schema is not None:
        df = conform(df, schema, strict=strict)
    if mode == "overwrite":
        assert_not_reading(df, path)
    return df


def heavy_values(df: DataFrame, columns: Sequence[str], tasks: int) -> DataFrame:
    """Values of ``columns`` that hold more than one of ``tasks`` equal shares
    of all rows, and the number of such shares (``parts``): fewer than
    ``tasks`` rows, however many values there are."""
    share = max(1, -(-df.count() // tasks))
    counts = df.groupBy(*[F.col(quoted(c)) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    kept = counts.filter(F.col("n") > share)
    return kept.select(*[F.col(quoted(c)).alias(f"v{i}") for i, c in enumerate(columns)],
                       F.ceil(F.col("n") / share).cast("int").alias("parts"))


def rebalance(df: DataFrame, columns: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Co-locate rows by ``columns``, with large values split as their size
    asks: by adaptive execution, or, where that is off, by counting the values
    first (two more scans of the columns). Which part a row goes to follows
    from its contents, so that a task that is run again writes the same rows."""
    spark = df.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled", "true") == "true":
        return df.hint("rebalance", *[F.col(quoted(c)) for c in columns])
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    def own(c: str):
        return F.col(f"rows.{quoted(c)}")

    heavy = F.broadcast(heavy_values(df, columns, tasks)).alias("heavy")  # fewer rows than tasks
    same = reduce(lambda a, b: a & b, (own(c).eqNullSafe(F.col(f"heavy.v{i}")) for i, c in enumerate(columns)))
    part = scratch_column(df)
    salt = F.pmod(F.xxhash64(*map(own, df.columns)), F.coalesce("heavy.parts", F.lit(1)))
    dealt = df.alias("rows").join(heavy, same, "left").select(*map(own, df.columns), salt.alias(part))
    return dealt.repartition(tasks, *[F.col(quoted(c)) for c in columns], part).drop(part)


def _no_empty_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fails on an empty string in a partition column: a directory cannot tell it from NULL."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)} & set(columns)
    return df.select(*[
        F.when(F.col(quoted(c)) == "", F.raise_error(F.lit(f"partition column {c} holds an empty string")).cast("string"))
        .otherwise(F.col(quoted(c))).alias(c) if c in text else F.col(quoted(c)) for c in df.columns])


def write_parquet(df: DataFrame, path: str, schema: T.StructType | None = None,
                  mode: str = "overwrite", partition_by: Sequence[str] = (),
                  strict: bool = False, shuffle: bool = True) -> None:
    """Write Parquet; ``partition_by`` gives hive-style directories.

    A partitioned write shuffles the rows (REBALANCE) so each value is
    written by few tasks. An empty string in a partition column is refused,
    because it would be read as NULL. ``shuffle=False`` skips that for input already
    clustered by the partition columns (each task then holds few values).
    """
    df = _prepare(df, path, schema, mode, strict)
    writer = df.write
    if partition_by:
        df = _no_empty_values(df, partition_by)
        src = rebalance(df, list(partition_by)) if shuffle else df
        writer = src.write.partitionBy(*partition_by)
    writer.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, schema: T.StructType | None = None,
              mode: str = "overwrite", strict: bool = False, line_breaks: str = "quoted") -> None:
    """Write CSV with a header, one file per task, NULL written as ``\\N``
    (distinct from the empty string and from any text: text starting with a
    backslash gets one more, which ``read_csv`` removes) and quotes/line
    breaks quoted. Binary and nested columns are refused.

    ``line_breaks="escaped"`` writes them as ``\\n`` and ``\\r`` and every
    backslash of a text twice, so that a record is always one line and
    ``read_csv`` with the same setting can split a file between tasks."""
    df = _prepare(df, path, schema, mode, strict)
    if line_breaks == "escaped" and any(b in n for n in df.columns for b in "\r\n"):
        raise ValueError("a header whose names hold line breaks is not one line")
    unfit = [f.name for f in df.schema.fields
             if isinstance(f.dataType, (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    if unfit:
        raise ValueError(f"CSV has no exact form for the columns {unfit}")
    df.selectExpr(*csv_escape_exprs(df.schema, line_breaks)).write.options(**CSV_OPTIONS).mode(mode).csv(path)


@dataclass(frozen=True)
class FileSink:
    """A ``sink(frame, table)`` writing each table to ``<root>/<table>``."""

    root: str
    mode: str
    write: Callable[..., None]
    read: Callable[..., DataFrame]
    schemas: Mapping[str, T.StructType] = field(default_factory=dict)
    strict: bool = False
    partitioned: Collection[str] = ()

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def __call__(self, df: DataFrame, table: str, schema: T.StructType | None = None) -> str:
        self.write(df, table, self.path(table), schema or self.schemas.get(table))
        return self.path(table)

    def shaped(self, df: DataFrame, table: str) -> DataFrame:
        """A frame of distinct rows as the table holds them: conformed to its
        declared schema, with rows that became equal in it merged."""
        declared = self.schemas.get(table)
        if declared is None or declared == df.schema:
            return df
        return conform(df, declared, strict=self.strict).distinct()

    def existing(self, df: DataFrame, table: str) -> DataFrame | None:
        """The table as written so far, read as it was declared, with the
        columns of ``df``; None if there is none."""
        spark = df.sparkSession
        exists = _qualify(spark, self.path(table))[1]
        if exists is False:
            return None
        try:
            old = self.read(spark, self.path(table), self.schemas.get(table) or df.schema)
            old.schema  # under Spark Connect the path is met only here
        except AnalysisException as e:
            if exists is None and e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return old

    def rereads(self, df: DataFrame, table: str) -> bool:
        """Whether ``reread`` gives the rows of ``df`` once they are written:
        Parquet, replaced as a whole, in the frame's own types."""
        return self.mode == "overwrite" and self._as_is(df, table)

    def reread(self, df: DataFrame, table: str) -> DataFrame:
        return self.read(df.sparkSession, self.path(table), df.schema)

    def _as_is(self, df: DataFrame, table: str) -> bool:
        return self.read is read_parquet and (self.schemas.get(table) or df.schema) == df.schema

    def appends_apart(self, df: DataFrame, table: str) -> bool:
        """Whether ``appended`` can tell the rows of ``df`` from older ones."""
        return (self.mode == "append" and table not in self.partitioned and self._as_is(df, table)
                and _context(df.sparkSession) is not None)

    def appended(self, df: DataFrame, table: str) -> tuple[str, DataFrame]:
        """Appends ``df`` and reads back its rows and no others: they are
        written to a hidden folder of the table, and the files are moved in
        when all are whole."""
        spark, path = df.sparkSession, self.path(table)
        apart = f"{path}/_load-{uuid.uuid4().hex}"
        self.write(df, table, apart, self.schemas.get(table))
        return path, spark.read.schema(df.schema).parquet(*_moved(spark, apart, path))


def _moved(spark, source: str, target: str) -> list[str]:
    """Moves the data files of a folder, whose names Spark makes unique, and
    drops the folder; the files' paths after that."""
    sc = _context(spark)
    new = sc._jvm.org.apache.hadoop.fs.Path
    fs = new(source).getFileSystem(sc._jsc.hadoopConfiguration())
    out = []
    for status in fs.listStatus(new(source)):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        to = new(f"{target}/{name}")
        if not fs.rename(status.getPath(), to):
            raise OSError(f"could not move {status.getPath().toString()} to {target}")
        out.append(to.toString())
    fs.createNewFile(new(f"{target}/_SUCCESS"))
    fs.delete(new(source), True)
    return out


def parquet_sink(root: str, mode: str = "overwrite", partition_by: dict[str, Sequence[str]] | None = None,
                 schemas: dict[str, T.StructType] | None = None, strict: bool = False) -> FileSink:
    """A sink writing Parquet tables. ``schemas`` declares tables by name
    (``starload.schemas.SCHEMAS`` for the registered ones)."""
    def write(df: DataFrame, table: str, path: str, schema: T.StructType | None) -> None:
        write_parquet(df, path, schema=schema, mode=mode, partition_by=(partition_by or {}).get(table, ()), strict=strict)
    return FileSink(root, mode, write, read_parquet, schemas or {}, strict, frozenset(t for t, by in (partition_by or {}).items() if by))


def csv_sink(root: str, mode: str = "overwrite", schemas: dict[str, T.StructType] | None = None,
             strict: bool = False, line_breaks: str = "quoted") -> FileSink:
    """A sink writing CSV tables; ``line_breaks`` as in ``write_csv``."""
    def write(df: DataFrame, table: str, path: str, schema: T.StructType | None) -> None:
        write_csv(df, path, schema=schema, mode=mode, strict=strict, line_breaks=line_breaks)
    return FileSink(root, mode, write, partial(read_csv, line_breaks=line_breaks), schemas or {}, strict)
