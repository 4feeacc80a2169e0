"""Source divergence audit by three-dimensional cube partitioning.

Each language's sources are compared by their term probabilities. The work is
a cube per language: source block x source block x term block. A slice (the
terms of one term block in one source block) is copied to every cell of its
row and its column, so a cell is a task of its own that holds two slices: it
computes its partial divergences without any other data, and the partials of a
source pair are summed along the term axis. Source blocks hold about
``SOURCES`` sources and term blocks about ``TERMS`` terms, whatever the input,
so a cell is bounded; their numbers follow from the counted sources and terms.
A hot source is met only as counts: terms are counted inside the scan's tasks
before anything is shuffled.

A term that neither slice of a cell holds has the same (smoothed) probability
everywhere in a source, so such terms are settled by their number.

All arithmetic is exact: counts are longs, probabilities the quotients of
38-digit integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import gives_back, slices, staged, text_or_empty

LEAST_DOCUMENTS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
#: About so many sources and terms make a block; a cell is two source blocks by one term block.
SOURCES, TERMS = 8, 4096
#: Counts of a task leave it when so many different ones (or bytes of terms) have gathered.
HELD, HELD_BYTES = 200_000, 16 << 20

LETTERS = frozenset(range(0x41, 0x5B)) | frozenset(range(0x61, 0x7B)) | frozenset(range(0x80, 0x100))
#: Bytes of UTF-8 that belong to terms, with A-Z lower-cased; all others become a blank.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in LETTERS else 0x20 for b in range(256))

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()),
                    ("docs", pa.int64())])


def terms(text: str) -> list[bytes]:
    """The text's terms in order: runs of ASCII letters and characters from U+0080 on, A-Z lower-cased."""
    return text.encode("utf-8").translate(FOLD).split(b" ") if text else []


@gives_back
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every (lang, source, term), added up within the task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = weight = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            n.pop(b"", None)
            names = list(n)
            for lo in range(0, len(names), 65536):
                part = names[lo:lo + 65536]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()),
                    pa.array([docs[t] for t in part], pa.int64())], schema=COUNTS)
        held.clear()

    for batch in batches:
        for part in slices(batch, 8 << 20):
            for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                own = Counter(terms(text))
                n.update(own)
                docs.update(own.keys())
                size += len(n) - before
                weight += sum(map(len, own)) if len(n) > before else 0
                if size > HELD or weight > HELD_BYTES:
                    yield from flush()
                    size = weight = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of the term and documents with it."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                       text_or_empty().alias("text"))
    schema = "lang string, source string, term string, n long, docs long"
    return rows.mapInArrow(_count, schema).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms_kept: Column) -> Column:
    """The smoothed probability in billionths: 1 + floor(10^9 (count + 5) / (total + 5 terms))."""
    def wide(c: Column, digits: int) -> Column:
        return c.cast(f"decimal({digits},0)")
    above = wide(F.lit(UNIT), 10) * wide(count + SMOOTHING, 20)
    below = wide(total, 20) + wide(terms_kept, 18) * wide(F.lit(SMOOTHING), 1)
    return F.lit(1) + F.call_function("div", above, below)


def _cell(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of one cell. Rows without a term name a source of
    the cell: its probability of absent terms (``p``) and the number of terms
    of the block (``terms``)."""
    named = rows["term"].isna().to_numpy()
    heads = rows[named].drop_duplicates("source")
    at = {s: i for i, s in enumerate(heads["source"])}
    base = heads["p"].to_numpy(np.int64)
    body = rows[~named]
    codes, seen = pd.factorize(body["term"])
    p = np.repeat(base[:, None], len(seen), axis=1)
    p[body["source"].map(at).to_numpy(np.int64), codes] = body["p"].to_numpy(np.int64)
    absent = (int(heads["terms"].iloc[0]) if len(heads) else 0) - len(seen)
    side, names = heads["side"].to_numpy(), heads["source"].to_numpy(object)
    same = rows["x"].iloc[0] == rows["y"].iloc[0]
    out = []
    for i in range(len(names)):
        others = np.arange(i + 1, len(names)) if same else np.flatnonzero(side == rows["y"].iloc[0])
        if not same and side[i] != rows["x"].iloc[0]:
            continue
        part = np.abs(p[others] - p[i]).sum(axis=1) + absent * np.abs(base[others] - base[i])
        out += [(names[i], names[j], int(v)) for j, v in zip(others, part)]
    made = pd.DataFrame(out, columns=["a", "b", "part"]).astype({"part": "int64"})
    made.insert(0, "lang", rows["lang"].iloc[0])
    return made


def _pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources.

    ``groups``: lang, source, p (of an absent term), v (terms kept in the
    language), k (sources in it). ``kept``: lang, source, term, p.
    """
    def block(name: str, n: Column) -> Column:
        return F.pmod(F.xxhash64(name), n).cast("int")

    source_blocks = F.ceil(F.col("k") / F.lit(SOURCES)).cast("int")
    term_blocks = F.greatest(F.lit(1), F.ceil(F.col("v") / F.lit(TERMS))).cast("int")
    sized = groups.select("lang", "source", "p", source_blocks.alias("nb"), term_blocks.alias("nt"))
    sized = sized.withColumn("side", block("source", F.col("nb")))
    shape = sized.select("lang", "nb", "nt").distinct()
    body = kept.select("lang", "source", "term", "p").join(shape, "lang").withColumn(
        "t", block("term", F.col("nt"))).withColumn("side", block("source", F.col("nb")))
    sizes = kept.select("lang", "term").distinct().join(shape, "lang").groupBy(
        "lang", block("term", F.col("nt")).alias("t")).agg(F.count(F.lit(1)).alias("terms"))
    heads = sized.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("nt") - 1))).join(sizes, ["lang", "t"], "left")
    none = F.lit(0).cast("long")
    rows = heads.select("lang", "source", F.lit(None).cast("string").alias("term"), "p",
                        F.coalesce("terms", none).alias("terms"), "side", "nb", "t").unionByName(
        body.select("lang", "source", "term", "p", none.alias("terms"), "side", "nb", "t"))
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "lang", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "t", "side", "source",
        "term", "p", "terms")
    parts = cells.groupBy("lang", "x", "y", "t").applyInPandas(_cell, "lang string, a string, b string, part long")
    whole = staged(parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value")), "divergence_pairs")
    return whole.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        whole.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))


def audit_sources(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """How the sources of each language differ in their use of words.

    ``docs``: text, lang, source; null counts as the empty string in each, and
    repeated rows count as documents of their own. A language keeps the terms
    that occur in at least ``least_documents`` of its documents. Result: lang,
    source, part, item, value, rank. Part ``pair`` lists every other source of
    the language by falling divergence (0 where the language keeps no term),
    part ``term`` the at most ``top`` terms that the source uses more than its
    language does, by falling difference; ties go to the smaller item. A
    source without terms has pairs but no terms. An empty table gives no rows.
    """
    counts = staged(term_counts(docs), "term_counts")
    words = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    words = words.filter(F.col("docs") >= least_documents).select("lang", "term", "lang_n")
    kept = staged(counts.select("lang", "source", "term", "n").join(words, ["lang", "term"]), "kept_terms")

    none = F.lit(0).cast("long")
    seen = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    vocabulary = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = seen.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", none).alias("total"))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("k"), F.sum("total").alias("lang_total"))
    langs = langs.join(vocabulary, "lang", "left").select("lang", "k", "lang_total", F.coalesce("v", none).alias("v"))
    groups = staged(groups.join(langs, "lang").select(
        "lang", "source", "total", "lang_total", "k", "v",
        F.when(F.col("v") > 0, _share(none, F.col("total"), F.col("v"))).otherwise(none).alias("p")), "source_groups")

    shares = kept.join(groups.select("lang", "source", "total", "lang_total", "v"), ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return rows.withColumn("rank", F.row_number().over(order)).select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

    over = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return ranked(_pairs(groups, shares), "pair").unionByName(ranked(over, "term").filter(F.col("rank") <= top))
