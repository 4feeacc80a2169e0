"""SimHash near-duplicates by pigeonring filtering.

Fingerprints of 64 bits are cut into four segments on a ring. If two differ in
at most 3 bits, there is a segment from which every chain of 1, 2, 3, 4
consecutive segments differs in at most 0, 1, 2, 3 bits: the chain's share of
the budget, rounded down. So candidates agree in one segment and differ in at
most one bit of the next. That pair of segments is the join key: once as it
stands, and once for each bit of the second segment, masked, between
fingerprints that differ there. Candidates must pass the longer chains before
their full distance is counted.

Copies share a fingerprint, so only distinct fingerprints are joined. A bucket
of many distinct fingerprints (a large group of near copies) is not paired
off: its blocks are compared in place and only a spanning forest of links
leaves (``components.dense_links``), so no link between fingerprints is lost.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import per_row, shuffle_partitions, staged, text_or_empty
from starload.llm.components import SMALL_BUCKET, components, dense_links

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS, WIDTH = 4, 16
SLAB = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of the text's word shingles, as an unsigned number. Words are
    split at ASCII white space, A-Z is lower-cased (what bytes do)."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, SLAB):
        hi = min(n, lo + SLAB)
        shingles = map(b" ".join, zip(*(words[lo + i:hi + i] for i in range(k))))
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, hi - lo)
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) per input row; fp is the fingerprint's bits as a long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def row(text):
        f = fingerprint(text, shingle_words)
        return (f - (1 << 64) if f >> 63 else f,)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(per_row(row, ["doc_id", "text"], schema), "doc_id long, fp long")


def _rotated(fp: Column, chain: int) -> Column:
    """The fingerprint turned so that segment ``chain`` is the highest."""
    by = WIDTH * chain
    return fp if not by else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def _keys(fp: Column) -> Column:
    """Array of (key, side): side 0 meets side 1 of the same key; side 2 meets itself."""
    keys = []
    for chain in range(SEGMENTS):
        pair = F.shiftrightunsigned(_rotated(fp, chain), 64 - 2 * WIDTH)
        name = F.lit(chain << 40)
        keys.append(F.struct(pair.bitwiseOR(name).alias("key"), F.lit(2).alias("side")))
        for bit in range(WIDTH):
            masked = pair.bitwiseAND(F.lit(~(1 << bit)))
            keys.append(F.struct(masked.bitwiseOR(name).bitwiseOR(F.lit((bit + 1) << 34)).alias("key"),
                                 F.shiftrightunsigned(pair, bit).bitwiseAND(F.lit(1)).cast("int").alias("side")))
    return F.array(*keys)


def _chain_holds(a: Column, b: Column, key: Column) -> Column:
    """Pigeonring test of a candidate: three segments, then all of them.
    Chains of one and two segments hold by the key."""
    chain = F.shiftright(key, 40)
    turned = a.bitwiseXOR(b)
    third = F.coalesce(*[F.when(chain == c, F.shiftrightunsigned(_rotated(turned, c), 64 - 3 * WIDTH))
                         for c in range(SEGMENTS)])
    return (F.bit_count(third) <= 3 * MAX_BITS // SEGMENTS) & (F.bit_count(turned) <= MAX_BITS)


def _near(x: list, y: list) -> np.ndarray:
    a, b = np.array(x, np.int64).view(np.uint64), np.array(y, np.int64).view(np.uint64)
    return np.bitwise_count(a[:, None] ^ b[None, :]) <= MAX_BITS


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (fp) within MAX_BITS."""
    spread = fps.repartition(shuffle_partitions(fps.sparkSession), "fp")  # a row becomes 68
    rows = spread.select("fp", F.explode(_keys(F.col("fp"))).alias("k")).select("fp", "k.key", "k.side")
    met = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("side").alias("lo"),
                                  F.max("side").alias("hi"))
    met = staged(met.filter("size > 1 and (lo < hi or lo = 2)").select("key", "size"), "simhash_buckets")
    rows = staged(rows.join(met, "key"), "simhash_members")
    small = rows.filter(F.col("size") <= SMALL_BUCKET)
    a, b = small.alias("a"), small.alias("b")
    meets = (F.col("a.key") == F.col("b.key")) & (
        ((F.col("a.side") == 0) & (F.col("b.side") == 1))
        | ((F.col("a.side") == 2) & (F.col("b.side") == 2) & (F.col("a.fp") < F.col("b.fp"))))
    pairs = a.join(b, meets & _chain_holds(F.col("a.fp"), F.col("b.fp"), F.col("a.key")))
    near = pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    large = rows.filter(F.col("size") > SMALL_BUCKET).select(
        F.col("key").alias("bucket"), F.col("fp").alias("node"), F.col("fp").alias("bits"), "size")
    return near.unionByName(dense_links(large, _near, "bits"))


def simhash_dedup(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Near-duplicate classes of documents (doc_id, text).

    One row per input row: doc_id, fingerprint (16 hex digits), component_id
    (the smallest doc_id reachable by links of at most 3 differing bits).
    A text without words, null ones too, has fingerprint zero and is linked
    like any other. Rows that repeat a doc_id each count. A null doc_id gets a
    row; it names a component only if no other member has an id.
    """
    docs_fp = staged(fingerprints(docs, shingle_words), "simhash")
    distinct = staged(docs_fp.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash_distinct")
    classes = components(links(distinct))
    named = distinct.join(classes, distinct["fp"] == classes["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    names = named.join(least, "root").select("fp", "component_id")
    return docs_fp.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
