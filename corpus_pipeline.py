"""The corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir), judges all documents it gets by one
operator and returns what the decision leaves; all but the last return the
columns of ``documents``. A document is named by its doc_id. Extra columns of
the input are kept, whatever their names: the stages' own are made to differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import staged, text_or_empty
from starload.llm.exact_dedup import exact_dedup
from starload.llm.mixing import mix
from starload.llm.queries import table, token_digests
from starload.llm.simhash import simhash_dedup
from starload.llm.toxicity import fit, scorer

#: SQL cannot express the learned scores, the fingerprints or the token ids.
ORACLE_SQL = None


def own(docs: DataFrame, *names: str) -> list[str]:
    """Names for columns of a stage's own: longer than any that the frame has."""
    width = 1 + max(map(len, docs.columns))
    return [n.ljust(width, "_") for n in names]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; a null text scores as an
    empty one. The score is a function of the text, so no text is shuffled."""
    score = scorer(docs, fit(docs, table(spark, sf_dir, "labels")))
    found, = own(docs, "score")
    return docs.withColumn(found, score(text_or_empty())).filter(F.col(found)["score"] < 0.5).drop(found)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of equal texts: the one that the operator keeps.
    Rows that repeat a doc_id and its text are one class, so one row stays. Rows
    meet the kept ones and each other by the same keys, so texts move once."""
    id_, no_id, key, n = own(docs, "id", "no_id", "key", "n")
    keys = [id_, no_id, key]

    def keyed(df: DataFrame, sha) -> DataFrame:
        doc_id = F.col("doc_id").cast("long")
        return df.withColumns({id_: F.coalesce(doc_id, F.lit(0)), no_id: doc_id.isNull(), key: sha})
    kept = keyed(exact_dedup(docs).filter("kept"), F.col("text_sha256")).select(*keys)
    rows = keyed(docs, F.sha2(F.translate(text_or_empty(), " \t\n\u000b\f\r", ""), 256))
    one = W.partitionBy(*keys).orderBy(F.length(text_or_empty()).desc())
    met = rows.join(kept, keys, "left_semi").withColumn(n, F.row_number().over(one))
    return met.filter(F.col(n) == 1).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each near-duplicate class. Rows that
    share a doc_id stay if one of them does; rows without one stay if no
    member of their class has one."""
    id_, = own(docs, "id")
    kept = simhash_dedup(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias(id_)).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(id_)), "left_semi")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix holds it. Rows that share a doc_id
    are taken as often as the one taken most."""
    id_, copies, i = own(docs, "id", "copies", "i")
    taken = mix(docs).groupBy(F.col("doc_id").alias(id_)).agg(F.max("copies").alias(copies))
    rows = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(id_))).filter(F.col(copies) > 0)
    return rows.withColumn(i, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix, repeats too."""
    return token_digests(docs)


STAGES = [("toxicity", toxicity_stage), ("exact dedup", exact_stage), ("SimHash near-dedup", simhash_stage),
          ("source mixing", mixing_stage), ("byte-level BPE", bpe_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage_" + name.replace(" ", "_").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
