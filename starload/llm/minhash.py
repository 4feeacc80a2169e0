"""MinHash near-duplicates by tensored banding.

A document's set of word shingles is named by 64-bit hashes. Two small
collections of ``SIDE`` hash values each are made of it, every value over
``ROWS`` minhashes. A table key is a pair, one value of either collection, so
SIDE x SIDE tables of 2 x ROWS rows come from 2 x SIDE x ROWS minhashes: about
the square root of what tables of their own would need. Sets of similarity
0.8 miss each other in all 144 tables with probability 0.0004.

Documents of equal sets are one node. Of the nodes that share a key
(candidates), pairs that cannot reach the similarity by their sizes, or by the
parities of their hashed shingles, are left out; both are bounds, so nothing
similar is lost. The others are compared on their full sets, read again from
the documents.

Buckets are settled in two steps, so that a large group of near copies is not
paired off. First every member is compared with its bucket's smallest node
only. Where a bucket then still holds several components, its members of
different components are compared: pair by pair in small buckets; in large
ones block by block, each pair of blocks being a group of its own that tests
the bounds in place and names an open pair only in the first table that both
its nodes share. So no pair of different components is left out, and none is
named once for each table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import dropped, per_row, picked, shuffle_partitions, staged, text_or_empty
from starload.llm.components import SMALL_BUCKET, components

SHINGLE_WORDS = 2
#: Linked from 80 shared shingles of 100 on; smaller sets than LEAST cannot be that similar without being equal.
SHARED, OF = 80, 100
LEAST = 4
SIDE, ROWS = 12, 3
PARITIES = 512
BLOCK = 4096
SLAB = 4096

_NUMBERS = np.random.default_rng(11).integers(0, 1 << 63, (2, 2 * SIDE * ROWS), dtype=np.uint64)
TURN, FACTOR = _NUMBERS[0][:, None], (_NUMBERS[1] | np.uint64(1))[:, None]
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit names of the text's distinct word shingles; the whole
    sequence where it has fewer words, none where it has no word."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = _mixed(out * MIX + h[i:i + n])
    return np.unique(out)


def sketch(shingles: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """The two collections of hash values of a set, and the parities of its shingles by their last bits."""
    low = np.full(2 * SIDE * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), SLAB):
        np.minimum(low, ((shingles[None, lo:lo + SLAB] ^ TURN) * FACTOR).min(axis=1), out=low)
    values = np.arange(2 * SIDE, dtype=np.uint64)
    for row in low.reshape(2 * SIDE, ROWS).T:
        values = _mixed(values * MIX + row)
    odd = np.bincount((shingles & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    values = values.view(np.int64).tolist()
    return values[:SIDE], values[SIDE:], np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _names(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    h = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def sketches(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n, h1, h2, left, right, parity) per input row; small sets have no collections."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                        ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))])

    def row(text):
        s = shingle_set(text, shingle_words)
        return (len(s), *_names(s), *(sketch(s) if len(s) >= LEAST else ([], [], [])))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(per_row(row, ["doc_id", "text"], schema),
                           "doc_id long, n long, h1 long, h2 long, left array<long>, right array<long>, parity array<long>")


def _members(nodes: DataFrame) -> DataFrame:
    """(key, table, node, pivot, size) of every node in every bucket of two nodes or more; pivot is its smallest node."""
    spread = nodes.repartition(shuffle_partitions(nodes.sparkSession), "node")  # a row becomes SIDE x SIDE
    one = spread.select("node", "right", F.posexplode("left").alias("i", "l"))
    rows = one.select("node", "i", "l", F.posexplode("right").alias("j", "r")).select(
        "node", F.xxhash64("l", "r").alias("key"), (F.col("i") * SIDE + F.col("j")).cast("short").alias("table"))
    met = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot"))
    return rows.join(met.filter("size > 1"), "key")


def _sizes_fit(a: Column, b: Column) -> Column:
    return F.least(a, b) * OF >= F.greatest(a, b) * SHARED


def _may_be_similar(x: pd.DataFrame, y: pd.DataFrame) -> np.ndarray:
    """Boolean matrix: pairs that the bounds on sizes and parities leave open."""
    n, m = x["n"].to_numpy(np.int64)[:, None], y["n"].to_numpy(np.int64)[None, :]
    open_ = (np.minimum(n, m) * OF >= np.maximum(n, m) * SHARED) & (
        x["root"].to_numpy(np.int64)[:, None] != y["root"].to_numpy(np.int64)[None, :])
    bits = [np.stack([np.asarray(p, np.int64) for p in t["parity"]]).view(np.uint64) for t in (x, y)]
    apart = np.zeros(open_.shape, np.uint16)
    for w in range(bits[0].shape[1]):
        apart += np.bitwise_count(bits[0][:, w][:, None] ^ bits[1][:, w][None, :])
    return open_ & (apart * np.int64(SHARED + OF) <= (n + m) * (OF - SHARED))


def _open_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of crowded buckets that the bounds leave open. ``rows``:
    key, table, node, size, root, n, parity, left, right. A bucket's members
    are dealt into blocks by a hash; each pair of blocks is compared in a
    group of its own. A pair leaves only the first of the tables it shares."""
    payload = ["table", "node", "root", "n", "parity", "left", "right"]
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = rows.select("key", *payload, blocks.alias("k"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("s"))
    copied = dealt.filter("k > 1").withColumn("t", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    dealt = dealt.filter("k = 1").withColumn("t", F.lit(0)).unionByName(copied).select(
        "key", *payload, "s", F.least("s", "t").alias("x"), F.greatest("s", "t").alias("y"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        same = group["x"].iloc[0] == group["y"].iloc[0]
        left = group if same else group[group["s"] == group["x"]]
        right = left if same else group[group["s"] == group["y"]]
        table = int(group["table"].iloc[0])
        here = {"left": table // SIDE, "right": table % SIDE}
        found = [(np.empty(0, np.int64),) * 2]
        for lo in range(0, len(left) if len(right) else 0, 256):
            part = left.iloc[lo:lo + 256]
            i, j = np.nonzero(_may_be_similar(part, right))
            for side, own in here.items():
                shared = np.stack(part[side].to_numpy())[i] == np.stack(right[side].to_numpy())[j]
                at = shared.argmax(axis=1) == own
                i, j = i[at], j[at]
            found.append((part["node"].to_numpy(np.int64)[i], right["node"].to_numpy(np.int64)[j]))
        a, b = (np.concatenate(c) for c in zip(*found))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    return dealt.groupBy("key", "x", "y").applyInPandas(compare, "a long, b long")


def _bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct ``pairs`` (a, b) that may be similar by sizes and parities."""
    facts = nodes.select("node", "n", "parity")
    a = facts.toDF("a", "na", "pa")
    b = facts.toDF("b", "nb", "pb")
    near = pairs.distinct().join(a, "a").join(b, "b").filter(_sizes_fit(F.col("na"), F.col("nb")))
    apart = sum((F.bit_count(F.col("pa")[w].bitwiseXOR(F.col("pb")[w])) for w in range(PARITIES // 64)), F.lit(0))
    return near.filter(apart * (SHARED + OF) <= (F.col("na") + F.col("nb")) * (OF - SHARED)).select("a", "b")


def _full_sets(docs: DataFrame, wanted: DataFrame, shingle_words: int) -> DataFrame:
    """(node, shingles) of the nodes of ``wanted`` (node, first, h1, h2), made again from one document each."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def row(text, h1, h2):
        s = shingle_set(text, shingle_words)
        return (s.view(np.int64) if _names(s) == (h1, h2) else None,)  # another text of a repeated doc_id

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = picked(rows, "doc_id", wanted, "first")  # before texts move
    rows = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["first"])).select("node", "text", "h1", "h2")
    sets = rows.mapInArrow(per_row(row, ["node", "text", "h1", "h2"], schema), "node long, shingles array<long>")
    return sets.filter("shingles is not null").dropDuplicates(["node"])


def _linked(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, shingle_words: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are similar. A hub's set is copied
    to as many partitions as its partners need, never once for each partner."""
    spark = docs.sparkSession
    pairs = staged(pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(shuffle_partitions(spark))).cast("int")),
                   "minhash_pairs")
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = staged(nodes.select("node", "first", "h1", "h2").join(used, "node"), "minhash_wanted")
    sets = staged(_full_sets(docs, wanted, shingle_words), "minhash_sets")
    hubs = pairs.select("a", "salt").distinct().join(sets.toDF("a", "sa"), "a")
    met = pairs.join(sets.toDF("b", "sb"), "b").join(hubs, ["a", "salt"])
    both = F.size(F.array_intersect("sa", "sb"))
    near = met.filter(both * OF >= (F.size("sa") + F.size("sb") - both) * SHARED)
    links = staged(near.select("a", "b"), "minhash_links")
    dropped(pairs, wanted, sets)
    return links


def minhash_dedup(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Near-duplicate classes of documents (doc_id, text) by word shingles.

    One row per input row: doc_id, n_shingles (distinct shingles), component_id
    (the smallest doc_id reachable over links of Jaccard similarity 0.8 or
    more, itself included) and kept (doc_id = component_id). A text of fewer
    words than a shingle is one shingle; a text without words, null ones too,
    has none and is linked with nothing. Rows that repeat a doc_id each count,
    whatever their texts. A null doc_id gets a row; it names a component only
    if no other member has an id. Shingles are compared by 64-bit names, sets
    are named by 128 bits. Links are always right; one of similarity 0.8 is
    missed with probability 0.0004, unless other links join its ends anyhow.
    """
    rows = staged(sketches(docs, shingle_words), "minhash_sketches")
    distinct = rows.filter("n > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("first"), *[F.first(c).alias(c) for c in ("n", "left", "right", "parity")])
    nodes = staged(distinct.withColumn("node", F.monotonically_increasing_id()), "minhash_nodes")
    members = staged(_members(nodes.filter(F.col("n") >= LEAST).select("node", "left", "right")), "minhash_members")

    first = members.filter("node > pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = _linked(docs, _bounded(first, nodes), nodes, shingle_words)
    classes = staged(components(links), "minhash_classes")
    rooted = members.join(classes, "node", "left").select(
        "key", "table", "node", "pivot", "size", F.coalesce("root", "node").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    facts = nodes.select("node", "n", "parity", "left", "right")
    rest = staged(rooted.join(mixed, "key").join(facts, "node"), "minhash_rest")
    dropped(members, classes)
    small = rest.filter(F.col("size") <= SMALL_BUCKET)
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))
                   & (F.col("x.root") != F.col("y.root")) & _sizes_fit(F.col("x.n"), F.col("y.n"))
                   & (F.col("x.node") != F.col("x.pivot"))).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    pairs = pairs.unionByName(_open_pairs(rest.filter(F.col("size") > SMALL_BUCKET)))
    more = _linked(docs, _bounded(pairs, nodes), nodes, shingle_words)
    dropped(rest)
    classes = components(links.unionByName(more))

    named = nodes.join(classes, "node", "left").select("h1", "h2", "first", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    names = named.join(least, "root").select("h1", "h2", "least")
    met = rows.select("doc_id", "n", "h1", "h2").join(names, ["h1", "h2"], "left")
    return met.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
