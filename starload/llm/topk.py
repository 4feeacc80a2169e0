"""Exact top-k inner products by no-random-access aggregation.

Vectors hold integers. For every dimension there are two sorted lists of the
candidates, by falling and by rising value; a query reads the first where its
own component is positive and the second where it is negative. All lists are
read on in lockstep, a stretch at a time. What a stretch brings tightens two
bounds of every candidate that is still open: the lower one takes the list's
worst value where the candidate was not met yet, the upper one the value last
read. With one depth for all lists both are inner products, of the query with
the candidates' values clipped at the depth, so the bounds of a block of
queries are two matrix products over the open candidates.

After each stretch the k-th best lower bound of a query closes every candidate,
met or not, whose upper bound is below it: it cannot qualify any more, and is
not looked at again. A query stops when only about k candidates are open; their
final scores are resolved exactly. Where the lists end first, the bounds are
the scores.

Candidates are rows, whatever their ids. Candidates and queries are dealt into
blocks of bounded size by hash, every block of queries meets every block of
candidates in a task of its own, and the k best of each block are ranked
together. Blocks are large, so that a row is copied once for several thousand
rows of the other side.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import staged

SCALE = 64
TOP = 20
#: Shares of the lists that have been read after each stretch.
DEPTHS = (0.5, 0.875, 0.95, 1.0)
QUERY_BLOCK, CANDIDATE_BLOCK = 8192, 8192
#: Queries of a block that are bounded together: so many rows of the bound matrices.
ABREAST = 256
RESULT = "query long, query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): floor(scale * component), of vectors without null or
    non-finite components. Rows that repeat a vec_id all count; a null vec_id
    takes no part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform("embedding", lambda e: e.cast("double")).alias("v"))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    x = F.transform("v", lambda e: F.floor(F.lit(float(scale)) * e).cast("long"))
    return v.select("vec_id", x.alias("x"))


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(r, np.int64) for r in rows])


def _dtype(q: np.ndarray, x: np.ndarray):
    """The narrowest type in which all inner products are exact."""
    most = float(max(1, np.abs(q).max(initial=0))) * float(max(1, np.abs(x).max(initial=0))) * max(1, q.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


def _clipped(x: np.ndarray, up: np.ndarray, down: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
    """Candidates as they count in upper and in lower bounds: ``up`` and
    ``down`` are the values last read and the worst ones of the falling and of
    the rising lists."""
    (last_up, worst_up), (last_down, worst_down) = up, down
    upper = np.hstack([np.maximum(x, last_up), np.minimum(x, last_down)])
    lower = np.hstack([np.where(x >= last_up, x, worst_up), np.where(x <= last_down, x, worst_down)])
    return upper.astype(kind), lower.astype(kind)


def best_of_block(q_rows: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int,
                  depths=DEPTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best candidates of one block for each query, ties to smaller ids:
    positions of queries, ids, scores, and the share of the lists each query read."""
    order = np.lexsort((rows, ids))
    rows, ids, x = rows[order], ids[order], x[order]
    kind = _dtype(q, x)
    lists = np.sort(x, axis=0)
    by_row = np.argsort(rows)
    at = np.minimum(np.searchsorted(rows[by_row], q_rows), max(len(rows) - 1, 0))
    own = np.where(rows[by_row][at] == q_rows, by_row[at], -1) if len(rows) else np.full(len(q), -1)
    found, read = [], np.zeros(len(q))
    for lo in range(0, len(q), ABREAST):
        part = slice(lo, lo + ABREAST)
        for i, at, score, depth in _search(q[part], own[part], x, lists, k, depths, kind):
            found.append((np.full(len(at), lo + i), ids[at], score))
            read[lo + i] = depth
    none = np.empty(0, np.int64)
    return *(np.concatenate([f[c] for f in found]) if found else none for c in range(3)), read


def _search(q: np.ndarray, own: np.ndarray, x: np.ndarray, lists: np.ndarray, k: int, depths, kind):
    """(query, candidates, scores, depth) for each query, at the depth where it stops."""
    n = len(x)
    if not n:
        return
    both = np.hstack([np.maximum(q, 0), np.minimum(q, 0)]).astype(kind)
    alive = np.arange(len(q))
    open_ = np.ones((len(q), n), bool)
    open_[np.flatnonzero(own >= 0), own[own >= 0]] = False
    for depth in depths:
        read = n if depth >= 1 else max(1, int(n * depth))
        columns = np.flatnonzero(open_[alive].any(axis=0))
        up, down = (lists[n - read], lists[0]), (lists[read - 1], lists[-1])
        upper, lower = _clipped(x[columns], up, down, kind)
        held = open_[np.ix_(alive, columns)]
        minus = -np.inf if kind is not object else -(10**40)
        below = np.where(held, both[alive] @ lower.T, minus)
        if len(columns) > k:
            bar = (np.partition(below, len(columns) - k, axis=1) if kind is not object
                   else np.sort(below, axis=1))[:, len(columns) - k]
            held &= (both[alive] @ upper.T) >= bar[:, None]
        open_[np.ix_(alive, columns)] = held
        stops = (held.sum(axis=1) <= 2 * k) | (read == n)
        for i in np.flatnonzero(stops):
            at = columns[held[i]]
            score = x[at] @ q[alive[i]]
            best = np.argsort(-score, kind="stable")[:k]
            yield alive[i], at[best], score[best].astype(np.int64), depth
        alive = alive[~stops]
        if not len(alive):
            return


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """The k best of ``vectors`` (row, vec_id, x) for each of ``queries`` (row, vec_id, x).

    (query_id, rank, vec_id, score) by falling integer inner product, ties to
    the smaller vec_id; fewer rows if there are fewer candidates. ``row`` tells
    rows apart that share a vec_id: a query is not its own candidate, other
    rows of its vec_id are, and queries of one vec_id each have their result.
    Candidates have the query's number of components.
    """
    n_q, n_c = queries.count(), vectors.count()
    q_blocks, c_blocks = max(1, -(-n_q // query_block)), max(1, -(-n_c // candidate_block))
    dim = F.size("x").alias("dim")
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")  # noqa: E731  cogroups need equal types
    q = queries.select("row", "vec_id", "x", dim, block(q_blocks).alias("qb"),
                       F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("cb"))
    c = vectors.select("row", "vec_id", "x", dim, block(c_blocks).alias("cb"),
                       F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in ("query", "query_id", "vec_id", "score")}).astype("int64")
        asked, ids, score, _ = best_of_block(
            left["row"].to_numpy(np.int64), _matrix(left["x"]), right["row"].to_numpy(np.int64),
            right["vec_id"].to_numpy(np.int64), _matrix(right["x"]), k)
        return pd.DataFrame({"query": left["row"].to_numpy(np.int64)[asked], "query_id": left["vec_id"].to_numpy(np.int64)[asked],
                             "vec_id": ids, "score": score})

    keys = ["dim", "qb", "cb"]
    near = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(meet, RESULT)
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_embeddings(embeddings: DataFrame, every: int = 20, k: int = TOP) -> DataFrame:
    """``top_k`` of embeddings (vec_id, embedding) for the rows whose vec_id
    is divisible by ``every``, against all rows."""
    x = staged(integer_vectors(embeddings).withColumn("row", F.monotonically_increasing_id()), "vectors")
    return top_k(x, x.filter(F.pmod(F.col("vec_id"), F.lit(every)) == 0), k)
