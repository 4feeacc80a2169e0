"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a word target: its weight's share of the mix, filled like
water, so that no source is used more than ``most_epochs`` times. A source is
taken in complete epochs first. The fraction that remains is a weighted sample
without replacement: a document's key is an exponential variate divided by its
quality weight, and documents are taken by ascending key until their prefix
sum of words reaches the budget (the last one if at least half of it fits).

A document that is long beside the budget would end its source far from it. Such
documents are drawn first, in strata of sizes up to twice one another, each to
its share of the budget and again by key and prefix sum; the short ones then
fill up what the long ones leave. The quality weight is a function of the text
alone (labels of quality are few, and the mix must not depend on having them).

Prefix sums are built from buckets: keys are cut into about sqrt(rows) ranges,
words are summed per source and range, running totals over ranges give each
range its offset, and rows are summed only within their own range. No task
sees more than a range's rows or a source's ranges, also for a source that
holds a third of the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import SPACE, staged, text_or_empty

SOURCE_WEIGHTS = (5, 2, 1)
MIX_SHARE = 1.5
MOST_EPOCHS = 2
#: Documents above this part of their source's budget are drawn before the others.
LONG_SHARE = 200
#: ASCII digits and punctuation, which lower a text's quality weight.
SYMBOLS = r"[!-@\[-`{-~]"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("long")


def quality_weight(text: Column) -> Column:
    """0.5 to 1: half, plus half the share of characters that are no symbols."""
    plain = F.length(F.regexp_replace(text, SYMBOLS, "")) + 1
    return F.lit(0.5) + F.lit(0.5) * plain / (F.length(text) + 1)


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) that depends on the id alone, so reruns agree."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sources: DataFrame, weights=SOURCE_WEIGHTS, share=MIX_SHARE, most=MOST_EPOCHS) -> DataFrame:
    """Adds ``target`` to (source, source_size): one row per source, so small.

    With sources by ascending cap per weight, a source is capped if its cap
    is no higher than the level that the words and weights not yet given
    away make possible; the first that is not fixes the level for the rest (the
    levels computed after it are lower).
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1))
    s = sources.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    before = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1)
    everything = W.partitionBy()
    rest_words = (F.sum("source_size").over(everything) * F.lit(float(share))
                  - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    rest_weight = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    s = s.withColumn("level", rest_words / rest_weight)
    s = s.withColumn("capped", F.col("cap") / F.col("w") <= F.col("level"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return s.select("source", "source_size",
                    F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * level).alias("target"))


def mix(docs: DataFrame, weights=SOURCE_WEIGHTS, share=MIX_SHARE, most=MOST_EPOCHS,
        long_share: int = LONG_SHARE) -> DataFrame:
    """The mix of documents (doc_id, text, source).

    One row per input row: doc_id, size (words), source, source_size, target,
    copies (how often the mix holds the document) and taken (its words in the
    mix). A null source is a source of its own, the last one; a null or blank
    text has size 0 and is taken with the complete epochs only. Rows that
    repeat a doc_id share a key and are taken one after the other. A document
    of more words than a source's budget over ``long_share`` is long there.
    """
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(text).alias("size"),
                       (-F.log(uniform(F.col("doc_id"))) / quality_weight(text)).alias("key"))
    rows = staged(rows, "mix")
    ranges = max(1, math.isqrt(rows.count()))
    cut = F.least(F.floor((1 - F.exp(-F.col("key"))) * ranges), F.lit(ranges - 1))
    # a null source gets a key of its own for joins and windows
    src = F.struct(F.col("source").isNull().alias("z"), F.coalesce("source", F.lit("")).alias("s"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    targets = targets.withColumns({"src": src, "epochs": epochs}).withColumn(
        "budget", F.col("target") - F.col("epochs") * F.col("source_size")).drop("source")
    rows = rows.withColumns({"cut": cut, "src": src})
    # rows meet what holds for their source by source and range, so that no task gets a whole source
    budgets = rows.groupBy("src", "cut").agg(F.count(F.lit(1)).alias("n")).join(targets, "src")
    rows = rows.join(budgets.select("src", "cut", "budget"), ["src", "cut"])
    # documents longer than their source's budget allows for form strata by their number of binary digits
    stratum = F.when(F.col("size") * F.lit(float(long_share)) > F.col("budget"), F.length(F.bin("size"))).otherwise(0)
    rows = rows.withColumn("stratum", stratum).drop("budget")
    cell = ["src", "stratum", "cut"]
    totals = rows.groupBy(*cell).agg(F.sum("size").alias("words"))
    by_cut = W.partitionBy("src", "stratum").orderBy("cut").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumns({
        "offset": F.coalesce(F.sum("words").over(by_cut), F.lit(0)),
        "stratum_words": F.sum("words").over(W.partitionBy("src", "stratum"))}).join(targets, "src")
    within = W.partitionBy(*cell).orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    middle = F.col("offset") + F.col("before") + F.col("size") / 2
    stratum_budget = F.col("budget") * F.col("stratum_words") / F.col("source_size")
    long_extra = (F.col("stratum") > 0) & (F.col("size") > 0) & (middle <= stratum_budget)
    spent = rows.filter("stratum > 0").join(totals, cell).filter(long_extra).groupBy("src").agg(
        F.sum("size").alias("spent"))  # one row per source
    rows = rows.join(totals.join(spent, "src", "left"), cell)
    short_extra = (F.col("stratum") == 0) & (F.col("size") > 0) & (
        middle <= F.col("budget") - F.coalesce("spent", F.lit(0)))
    copies = (F.col("epochs") + F.when(long_extra | short_extra, 1).otherwise(0)).cast("long")
    return rows.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"))
