"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Learning. A bounded sample of labelled rows of each class (``examples``) gives
the features: whole words of any length and word beginnings whose presence
tells the classes apart beyond chance, at most ``features`` of them. Document
frequencies count all documents. The examples' TF-IDF vectors over these features, normed, form
a block-max inverted index: per feature a posting list of (example, weight),
and per feature and block of examples the largest weight.

Scoring reads a document's text alone. Its cosine with a block's examples is
at most the sum of its weights times the block's largest weights. Blocks are
visited by falling bound, their postings are summed exactly, and the search
ends when the next bound cannot reach the k-th best: the neighbours are exact.
Neighbours vote with weight 1 / (distance^2 + 0.05), distance^2 = 2 - 2 cosine,
times the weight that undoes the sampling of their class. Votes are mapped to
calibrated scores by the label rates, made monotone, that examples get from
the other examples. The nearest examples are a score's evidence.

Index and sample are bounded by parameters and so travel to every task; the
passes over the corpus are maps and a partial aggregate of at most
``features`` rows per task.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import gives_back, per_row, shuffle_partitions, slices, staged, text_or_empty

EXAMPLES = 10_000        # of each class, at most
FEATURES = 4096          # at most
NEIGHBOURS = 15
BLOCK = 64
BINS = 20
FOLDS = 5                # rows of fold 0 are held out
SHORTEST, LONGEST = 3, 8  # letters of a beginning
KNOWN = 1 << 17          # words whose features a worker remembers
WORD = re.compile(r"[^\W\d_]+")
ASCII_WORDS = "".join(c if c.islower() else " " for c in map(chr, range(128)))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def words_of(text: str) -> list[str]:
    """The words of a text, in lower case. In ASCII texts all but a-z parts
    them, which needs no regular expression."""
    text = text.lower()
    return text.translate(ASCII_WORDS).split() if text.isascii() else WORD.findall(text)


def word_counts(text: str) -> Counter:
    return Counter(words_of(text))


def beginnings(word: str) -> list[str]:
    """Features of one word: its beginnings, and the word as a whole."""
    return [word[:n] for n in range(SHORTEST, min(LONGEST + 1, len(word)))] + [word + "$"]


class Vectorizer:
    """Counts of the selected features in a text."""

    def __init__(self, features: list[str]):
        self.number = {f: i for i, f in enumerate(features)}
        self.heads = {f.removesuffix("$")[:SHORTEST] for f in features}
        self.known: dict[str, tuple[int, ...]] = {}  # features of words met that have any
        self.idle: set[str] = set()                  # words met that have none; KNOWN of both at most

    def numbers(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            found = ()
            if word[:SHORTEST] in self.heads:
                found = tuple(self.number[f] for f in beginnings(word) if f in self.number)
            if len(word) <= 32:
                if len(self.known) + len(self.idle) >= KNOWN:
                    self.known.clear()
                    self.idle.clear()
                if found:
                    self.known[word] = found
                else:
                    self.idle.add(word)
        return found

    def counts(self, text: str) -> dict[int, int]:
        out: dict[int, int] = {}
        words = words_of(text)
        # most words have no features: those met before go at once, and the others alone are counted
        telling = {w: f for w in set(words).difference(self.idle) if (f := self.numbers(w))}
        if len(telling) > 8:
            times = Counter(words)
            found = {w: times[w] for w in telling}
        else:
            found = {w: words.count(w) for w in telling}
        for word, n in found.items():
            for i in telling[word]:
                out[i] = out.get(i, 0) + n
        return out


def unit(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights (1 + log tf) * idf, of norm 1."""
    at = np.array(sorted(counts), np.int64)
    w = np.array([1 + math.log(counts[i]) for i in at.tolist()]) * idf[at] if len(at) else np.empty(0)
    return at, w / np.sqrt((w * w).sum()) if len(at) else w


class Index:
    """Block-max inverted index of the examples' vectors."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_features: int, block: int = BLOCK):
        self.block, self.size = block, len(vectors)
        self.n_blocks = -(-max(1, len(vectors)) // block)
        rows = np.concatenate([np.full(len(a), i) for i, (a, _) in enumerate(vectors)] or [np.empty(0)]).astype(np.int64)
        cols = np.concatenate([a for a, _ in vectors] or [np.empty(0)]).astype(np.int64)
        vals = np.concatenate([w for _, w in vectors] or [np.empty(0)])
        order = np.lexsort((rows, cols))
        self.example, self.weight = rows[order], vals[order]
        self.most = np.zeros((n_features, self.n_blocks))
        np.maximum.at(self.most, (cols, rows // block), vals)
        cells = cols[order] * self.n_blocks + rows[order] // block
        self.starts = np.searchsorted(cells, np.arange(n_features * self.n_blocks + 1))

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int,
                skip: frozenset[int] = frozenset()) -> list[tuple[float, int]]:
        """The k examples of highest cosine above 0 as (cosine, example), ties to
        the smaller number; those of ``skip`` are left out."""
        if not len(at):
            return []
        bounds = weights @ self.most[at]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bounds, kind="stable").tolist():
            if bounds[b] <= 0 or len(best) == k and bounds[b] < -best[-1][0] - 1e-12:
                break
            total = np.zeros(self.block)
            for f, w in zip(at.tolist(), weights.tolist()):
                lo, hi = self.starts[f * self.n_blocks + b], self.starts[f * self.n_blocks + b + 1]
                if lo < hi:
                    total[self.example[lo:hi] - b * self.block] += w * self.weight[lo:hi]
            hits = np.flatnonzero(total > 0)
            if len(hits) > k + len(skip):
                hits = hits[np.argsort(-total[hits], kind="stable")[:k + len(skip)]]
            found = [(-round(float(total[h]), 12), b * self.block + h) for h in hits.tolist()]
            best = sorted(best + [x for x in found if x[1] not in skip])[:k]
        return [(-c, int(i)) for c, i in best]


@dataclass
class Model:
    """All that scoring needs; bounded by the parameters of ``fit``."""
    features: list[str]
    idf: np.ndarray
    index: Index
    labels: np.ndarray
    ids: np.ndarray
    class_weight: tuple[float, float]
    prior: float
    edges: np.ndarray | None = None
    rates: np.ndarray | None = None

    def __post_init__(self):
        self.vectorizer = Vectorizer(self.features)

    def neighbours(self, text: str) -> list[tuple[float, int]]:
        return self.index.nearest(*unit(self.vectorizer.counts(text), self.idf), NEIGHBOURS)

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Weighted share of toxic neighbours; the prior has one vote at distance 1.4."""
        total = 1 / 2.05
        toxic = self.prior * total
        for cosine, i in near:
            w = self.class_weight[int(self.labels[i])] / (2 - 2 * min(cosine, 1.0) + 0.05)
            total += w
            toxic += w * self.labels[i]
        return toxic / total

    def calibrated(self, vote: float) -> float:
        if self.edges is None:
            return vote
        return float(np.interp(vote, self.edges, self.rates))


def sample_examples(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic) of at most ``per_class`` rows of each class, by a hash of
    the id, outside the held-out fold; and how many rows each class has."""
    rows = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = rows.filter(fold(F.col("doc_id")) != 0)
    rows = rows.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    rows = staged(rows, "labelled")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [rows.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return staged(parts[0].unionByName(parts[1]), "examples"), totals


def feature_counts(texts: DataFrame) -> DataFrame:
    """(feature, n_toxic, n_clean): in how many example texts a feature is."""
    schema = pa.schema([("feature", pa.string()), ("n_toxic", pa.int64()), ("n_clean", pa.int64())])

    def flush(found):
        return pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in found], pa.string()), pa.array([n if t else 0 for (_, t), n in found.items()]),
             pa.array([0 if t else n for (_, t), n in found.items()])], schema=schema)

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for part in slices(batch, 4 << 20):
                for toxic, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found.update({(f, toxic) for w in word_counts(text) for f in beginnings(w)})
                if len(found) > 300_000:
                    yield flush(found)
                    found.clear()
        if found:
            yield flush(found)

    return texts.mapInArrow(run, "feature string, n_toxic long, n_clean long").groupBy("feature").agg(
        F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


def select_features(counts: DataFrame, n_toxic: int, n_clean: int, most: int) -> list[str]:
    """Features that mark toxic examples: a likelihood ratio that chance would
    reach about once among all features tested; the strongest of them."""
    counts = staged(counts, "feature_counts")
    tested = max(2, counts.count())
    a, b = F.col("n_toxic").cast("double"), F.col("n_clean").cast("double")
    total = float(n_toxic + n_clean)

    def part(n, share):
        return F.when(n > 0, n * F.log(n / share)).otherwise(0.0)
    with_f, without = a + b, F.lit(total) - a - b
    g2 = 2 * (part(a, with_f * n_toxic / total) + part(b, with_f * n_clean / total)
              + part(n_toxic - a, without * n_toxic / total) + part(n_clean - b, without * n_clean / total))
    toxic_side = a / max(1, n_toxic) > 5 * b / max(1, n_clean)
    best = counts.withColumn("g2", g2).filter(toxic_side & (F.col("g2") > 2 * math.log(tested)))
    return [r["feature"] for r in best.orderBy(F.col("g2").desc(), "feature").limit(most).collect()]


def document_frequencies(docs: DataFrame, features: list[str]) -> tuple[np.ndarray, int]:
    """In how many of all documents each feature is, and the number of documents."""
    vectorizer = Vectorizer(features)
    schema = pa.schema([("feature", pa.int64()), ("n", pa.int64())])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for part in slices(batch, 4 << 20):
                found[-1] += part.num_rows
                for text in part.column(0).to_pylist():
                    found.update(vectorizer.counts(text).keys())
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
                                         schema=schema)

    rows = docs.select(text_or_empty().alias("text")).mapInArrow(run, "feature long, n long")
    totals = {r["feature"]: r["n"] for r in rows.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    return np.array([totals.get(i, 0) for i in range(len(features))], float), totals.get(-1, 0)


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, features: int = FEATURES) -> Model:
    """Learns from documents (doc_id, text) and labels (doc_id, toxic).

    ``examples`` bounds the sampled rows of each class, ``features`` the
    features. Labels that are null or neither 0 nor 1 are ignored; of rows that
    repeat a doc_id in ``labels`` the larger label counts; rows that repeat one in
    ``docs`` are an example each, and none votes on another. Without labels of
    both classes every score is the share of toxic labels, or 0.
    """
    sample, totals = sample_examples(docs, labels, examples)
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(
        F.broadcast(sample), "doc_id")  # at most 2 * examples rows of 12 bytes
    taken = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = tuple(totals.get(c, 0) / max(1, taken.get(c, 0)) for c in (0, 1))
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    selected = []
    if len(taken) == 2:
        selected = select_features(feature_counts(pairs.select("toxic", "text")), taken[1], taken[0], features)
    df, n = document_frequencies(docs, selected) if selected else (np.empty(0), 0)
    idf = np.log((1 + n) / (1 + df)) + 1
    vectorizer = Vectorizer(selected)
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("at", pa.list_(pa.int64())),
                        ("n", pa.list_(pa.int64()))])

    def row(toxic, text):
        counts = vectorizer.counts(text)
        return toxic, list(counts), list(counts.values())

    rows = pairs.mapInArrow(per_row(row, ["doc_id", "toxic", "text"], schema),
                            "doc_id long, toxic int, at array<long>, n array<long>")
    rows = staged(rows, "example_vectors")
    # at most 2 * examples rows of at most ``features`` counts; ordered so that blocks are alike
    vectors = sorted(rows.collect(), key=lambda r: (r["toxic"], sorted(r["at"]), r["doc_id"])) if selected else []
    units = [unit(dict(zip(r["at"], r["n"])), idf) for r in vectors]
    model = Model(selected, idf, Index(units, len(selected)), np.array([r["toxic"] for r in vectors], float),
                  np.array([r["doc_id"] for r in vectors], np.int64), weight, prior)
    return calibrate(model, rows) if vectors else model


def calibrate(model: Model, rows: DataFrame) -> Model:
    """Label rates of the examples by their votes from the other examples, in
    bins of equal width, made monotone by pooling neighbours that violate it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("bin", pa.int32()), ("n", pa.float64()), ("y", pa.float64()), ("x", pa.float64())])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        numbers: dict[int, list[int]] = {}
        for i, d in enumerate(m.ids.tolist()):
            numbers.setdefault(d, []).append(i)
        out = []
        for batch in batches:
            for r in batch.to_pylist():
                u = unit(dict(zip(r["at"], r["n"])), m.idf)
                v = m.vote(m.index.nearest(*u, NEIGHBOURS, skip=frozenset(numbers[r["doc_id"]])))
                w = m.class_weight[r["toxic"]]
                out.append((min(BINS - 1, int(v * BINS)), w, w * r["toxic"], w * v))
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    votes = rows.repartition(shuffle_partitions(rows.sparkSession), "doc_id").mapInArrow(
        run, "bin int, n double, y double, x double")
    bins = votes.groupBy("bin").agg(*[F.sum(c).alias(c) for c in "nyx"]).collect()  # BINS rows at most
    pools = []
    for r in sorted(bins, key=lambda r: r["bin"]):
        pools.append([r["n"], r["y"], r["x"]])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    model.edges = np.array([p[2] / p[0] for p in pools])
    model.rates = np.array([p[1] / p[0] for p in pools])
    return model


SCORE = "struct<score: double, evidence: array<struct<doc_id: bigint, toxic: int, cosine: double>>>"


def scorer(docs: DataFrame, model: Model):
    """A column function: score and evidence (the three nearest examples) of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    kind = pa.struct([("score", pa.float64()), ("evidence", pa.list_(pa.struct(
        [("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())])))])

    @F.arrow_udf(SCORE)
    def score(texts: pa.Array) -> pa.Array:
        m = shared.value
        out = []
        for text in texts:  # one text at a time is a Python object
            near = m.neighbours(text.as_py() or "")
            out.append({"score": m.calibrated(m.vote(near)), "evidence": [
                {"doc_id": int(m.ids[i]), "toxic": int(m.labels[i]), "cosine": c} for c, i in near[:3]]})
        return pa.array(out, kind)
    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, features: int = FEATURES) -> DataFrame:
    """Toxicity of documents (doc_id, text), learned from labels (doc_id, toxic).

    One row per input row: doc_id, held_out (its fold is not learned from),
    score (0 to 1), predicted (1 if the score is 0.5 or more), evidence. A
    score depends on the text alone: equal texts, repeated rows too, score
    alike. A null, empty or featureless text gets the calibrated prior.
    """
    score = scorer(docs, fit(docs, labels, examples, features))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(text_or_empty()).alias("s"))
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), F.col("s.score").alias("score"),
                       (F.col("s.score") >= 0.5).cast("int").alias("predicted"), F.col("s.evidence").alias("evidence"))
