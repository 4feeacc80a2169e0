"""Helpers shared by the operators: staging, text access and Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.session import drop_path, scratch_path

#: ASCII white space of the contracts, as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Whether the shuffle files of a query go when it ends (they may be made again).
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: it is
    computed once, its lineage ends here, and lost executors cost only a reread.
    The shuffle files of the write, which nothing reads again, go as it ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more (see ``staged``)."""
    for t in tables:
        for root in {f.rsplit("/", 1)[0] for f in t.inputFiles()[:1]}:
            drop_path(t.sparkSession, root)


#: A bitmap's pages of 32768 bits; it has 16 bits for each key and at most 16 MB in all, twice that as broadcast numbers.
PAGE_BITS, MOST_PAGES = 32_768, 4096


def picked(rows: DataFrame, key: str, wanted: DataFrame, name: str, keep: Column | None = None) -> DataFrame:
    """``rows`` whose ``key`` the bitmap of ``wanted``'s column ``name`` holds:
    all that are wanted and few others, as long as the bitmap's bound is not
    reached, and rows for which ``keep`` is true. Nothing is shuffled but the
    bitmap, which is broadcast; what must be exact is joined afterwards, when
    hardly anything else is left to move. NULL is a key."""
    pages = max(1, min(MOST_PAGES, -(-16 * wanted.count() // PAGE_BITS)))

    def spot(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(pages * PAGE_BITS))

    def page(c: Column) -> Column:
        return F.floor(c / PAGE_BITS).cast("int")

    # each page's bytes are made numbers once, so that no row's bit is found by way of texts
    numbers = F.expr(f"transform(sequence(1, {PAGE_BITS // 8}), i -> CAST(CAST(conv(hex(substring(__bits, i, 1)), 16, 10)"
                     " AS INT) AS SMALLINT))")
    bits = wanted.select(spot(name).alias("__spot")).groupBy(page(F.col("__spot")).alias("__page")).agg(
        F.bitmap_construct_agg(F.pmod(F.col("__spot"), F.lit(PAGE_BITS))).alias("__bits")).select(
        "__page", numbers.alias("__bytes"))
    at = F.pmod(F.col("__spot"), F.lit(PAGE_BITS)).cast("int")
    byte = F.get("__bytes", F.shiftright(at, 3))
    found = F.coalesce(F.call_function("getbit", byte, F.pmod(at, F.lit(8))) == 1, F.lit(False))
    met = rows.withColumn("__spot", spot(key)).withColumn("__page", page(F.col("__spot"))).join(
        F.broadcast(bits), "__page", "inner" if keep is None else "left")  # at most MOST_PAGES pages of 8 KB
    return met.filter(found if keep is None else found | keep).select(*rows.columns)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(col, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gives_back(run: Callable) -> Callable:
    """A batch function whose worker, which Spark keeps for later tasks,
    returns freed memory to the system when its task ends."""
    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    return wrapped


def per_row(fn: Callable[..., tuple], inputs: list[str], schema: pa.Schema,
            batch_bytes: int = 8 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function: the input's first column, the row's id, is
    copied; ``fn`` gets the others of ``inputs`` and gives the output's other
    columns. Input is taken in slices of bounded size, so that a run of long
    texts never stands in memory as Python objects at once."""
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch_bytes):
                rows = [fn(*row) for row in zip(*(part.column(c).to_pylist() for c in inputs[1:]))]
                columns = zip(*rows) if rows else [[] for _ in schema.names[1:]]
                arrays = [pa.array(list(c), f.type) for c, f in zip(columns, list(schema)[1:])]
                yield pa.RecordBatch.from_arrays([part.column(inputs[0]).cast(schema.field(0).type), *arrays],
                                                 schema=schema)
    return run


def slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows of about ``most`` bytes each (one row at least)."""
    if not batch.num_rows:
        return
    step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)
