"""Connected components and bucketed links, for the operators on pairs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import dropped, staged

#: Buckets up to this size are joined pair by pair; larger ones go by blocks.
SMALL_BUCKET = 32
BLOCK = 512


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): root is the
    smallest node reachable.

    Alternates two contractions until the links are stars: every neighbour of a
    node is linked to the smallest one, first the larger neighbours, then the
    smaller ones. Each is a partial aggregate and a join, so a hub's edges are
    never gathered; rounds grow as the logarithm of a component's diameter.
    Each round is written to the shared folder, and the one before is dropped.
    """
    pairs = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    pairs = staged(pairs.filter("lo < hi").distinct(), "edges")
    while not _are_stars(pairs):
        before, pairs = pairs, staged(_small_star(_large_star(pairs)), "edges")
        dropped(before)
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and that one none.
    Then the smaller one is the smallest node that can be reached."""
    upper = pairs.groupBy("hi").agg(F.count(F.lit(1)).alias("n"))
    if not upper.filter("n > 1").isEmpty():
        return False
    return pairs.join(upper.select(F.col("hi").alias("lo")), "lo", "left_semi").isEmpty()


def _large_star(pairs: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to its smallest neighbour."""
    smallest = pairs.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
    joined = pairs.join(smallest, pairs["lo"] == smallest["u"], "left")
    return joined.select(F.coalesce("m", "lo").alias("lo"), "hi").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Links the smaller neighbours of each node, and the node, to the smallest."""
    smallest = pairs.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = pairs.join(smallest, "hi")
    linked = joined.filter("lo > m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return linked.unionByName(smallest.select(F.col("m").alias("lo"), "hi")).distinct()


def dense_links(members: DataFrame, linked: Callable[[list, list], np.ndarray], payload: str,
                block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect what is linked within large buckets.

    ``members``: (bucket, node, payload) with their bucket's ``size``.
    ``linked(x, y)`` gives the boolean matrix of links between two lists of
    payloads. Members are dealt into blocks by a hash; each pair of blocks is
    a group of its own, in which every pair is verified but only a spanning
    forest of the links leaves. So no link between classes is lost, no task
    holds more than two blocks, and the rows that leave grow with the members
    of a block and not with its pairs.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / block)).cast("int")
    rows = members.select("bucket", "node", payload, blocks.alias("k"), F.pmod(F.xxhash64("node"), blocks).alias("s"))
    rows = rows.select("bucket", "node", payload, "s", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("t"))
    rows = rows.select("bucket", "node", payload, "s", F.least("s", "t").alias("x"), F.greatest("s", "t").alias("y"))

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        same = group["x"].iloc[0] == group["y"].iloc[0]
        left = group if same else group[group["s"] == group["x"]]
        right = left if same else group[group["s"] == group["y"]]
        if left.empty or right.empty:
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        near = linked(left[payload].tolist(), right[payload].tolist())
        a, b = spanning(near, same)
        return pd.DataFrame({"a": left["node"].to_numpy()[a], "b": right["node"].to_numpy()[b]})

    return rows.groupBy("bucket", "x", "y").applyInPandas(forest, "a long, b long")


def spanning(near: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of links that connect all that the matrix links."""
    n, m = near.shape
    a, b = [], []
    free_rows = np.ones(n, bool)
    free_cols = free_rows if same else np.ones(m, bool)
    for start in range(n):
        if not free_rows[start]:
            continue
        free_rows[start] = False
        rows, cols = [start], []
        while rows or cols:
            if rows:
                r = rows.pop()
                hit = np.flatnonzero(near[r] & free_cols)
                free_cols[hit] = False
                a += [r] * len(hit)
                b += hit.tolist()
                (rows if same else cols).extend(hit.tolist())
            else:
                c = cols.pop()
                hit = np.flatnonzero(near[:, c] & free_rows)
                free_rows[hit] = False
                a += hit.tolist()
                b += [c] * len(hit)
                rows.extend(hit.tolist())
    return np.array(a, np.int64), np.array(b, np.int64)
