"""Exact deduplication by content-defined chunk recipes.

A text, with white space deleted, is cut where a rolling hash of the last
eight bytes says so: equal texts are cut alike. Each chunk gets a digest, and
a document's recipe is its ordered list of digests (fixed width, packed). The
chunks themselves move once: one shuffle of the distinct (digest, bytes) pairs
verifies that no digest stands for two contents. If one does, the corpus is
chunked again with a longer digest. Recipes over verified identifiers are
equal exactly if the texts are, so documents are compared and counted by
recipe and their texts never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import gives_back, per_row, slices, staged, text_or_empty

WHITE = b" \t\n\x0b\x0c\r"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MEAN_BITS = 11          # a cut every 2 KiB in the mean
SHORTEST, LONGEST = 256, 32768
SLAB = 1 << 20
DIGEST_BYTES = (16, 32, 64)


def normalised(text: str) -> bytes:
    return text.encode("utf-8").translate(None, WHITE)


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``: a function of the content alone."""
    n = len(data)
    ends, last = [], 0
    if n > SHORTEST:
        raw = np.frombuffer(data, np.uint8)
        for lo in range(0, n - 7, SLAB):
            part = raw[lo:lo + SLAB + 7]
            windows = np.lib.stride_tricks.sliding_window_view(part, 8)
            value = np.ascontiguousarray(windows).view(np.uint64).ravel()
            hits = np.flatnonzero((value * MULTIPLIER) >> np.uint64(64 - MEAN_BITS) == 0) + lo + 8
            for p in hits.tolist():
                while p - last > LONGEST:
                    last += LONGEST
                    ends.append(last)
                if p - last >= SHORTEST:
                    last = p
                    ends.append(p)
    while n - last > LONGEST:
        last += LONGEST
        ends.append(last)
    if n > last:
        ends.append(n)
    return ends


def chunks(data: bytes) -> list[bytes]:
    start, out = 0, []
    for end in cut_points(data):
        out.append(data[start:end])
        start = end
    return out


def digest(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def recipes(docs: DataFrame, digest_bytes: int) -> DataFrame:
    """One row per document: row_id, doc_id, n_chars, text_sha256 and recipe."""
    schema = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
                        ("text_sha256", pa.string()), ("recipe", pa.binary())])

    def row(doc_id, text):
        data = normalised(text)
        return (doc_id, len(text), hashlib.sha256(data).hexdigest(),
                b"".join(digest(c, digest_bytes) for c in chunks(data)))

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty().alias("text"))
    return rows.mapInArrow(per_row(row, ["row_id", "doc_id", "text"], schema),
                           "row_id long, doc_id long, n_chars long, text_sha256 string, recipe binary")


def chunk_contents(docs: DataFrame, digest_bytes: int) -> DataFrame:
    """The distinct (digest, content) pairs of the corpus."""
    schema = pa.schema([("digest", pa.binary()), ("content", pa.binary())])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 8 << 20):
                found = {c for t in part.column(0).to_pylist() for c in chunks(normalised(t))}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(c, digest_bytes) for c in found], pa.binary()),
                     pa.array(list(found), pa.binary())], schema=schema)

    return docs.select(text_or_empty().alias("text")).mapInArrow(run, "digest binary, content binary").distinct()


def verified(docs: DataFrame, digest_bytes: int) -> bool:
    """Whether no digest of the corpus stands for two contents."""
    clashes = chunk_contents(docs, digest_bytes).groupBy("digest").count().filter("count > 1")
    return clashes.isEmpty()


def exact_dedup(docs: DataFrame, digest_sizes: tuple[int, ...] = DIGEST_BYTES) -> DataFrame:
    """Classes of texts that are equal without white space, of documents (doc_id, text).

    One row per input row: doc_id, keep_id, group_size, kept, text_sha256. Of
    equal texts the row with the most code points stays, then the smallest
    doc_id (a null doc_id last), then, where rows repeat a doc_id, one of them.
    Null and white-space texts are equal to the empty one. Counting and the
    choice of the row are partial aggregates, so a large group of copies adds
    one row per task to its group; the join back is by recipe, whose large
    partitions Spark splits.
    """
    size = next((s for s in digest_sizes if verified(docs, s)), None)
    if size is None:
        raise ValueError(f"chunk digests of up to {max(digest_sizes)} bytes clash")
    rows = staged(recipes(docs, size), "recipes")
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("z"), "doc_id", "row_id"))
    groups = staged(rows.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")), "classes")
    return rows.join(groups, "recipe").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"), "text_sha256")
