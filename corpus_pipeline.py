"""The corpus pipeline: five stages over ``documents``, each on all its predecessor kept.

Toxic documents go, one document of each group of near duplicates stays,
documents that hold benchmark items go, secrets are masked, and what is left is
encoded.  ``run`` writes each stage's result to the shared folder and reads it
again.  Rows without doc_id are judged like all others, each under a number of its
own; rows that repeat a doc_id stay or go together.  NULL and empty texts are scored
like all others, are near no other, hold no item and no secret, and have no pieces; texts
of any length are judged and encoded whole; an empty table stays empty at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import stored, table
from salesloom.llm.decontaminate import contaminated
from salesloom.llm.lattice import encode
from salesloom.llm.minhash_dedup import near_duplicates
from salesloom.llm.secrets import mask_secrets
from salesloom.llm.toxicity import score_toxicity


KEY = "_row_key"
SIMILAR_PERCENT = 80  # near duplicates share as much of their five-word shingles
SIMILAR_MATCHES = 34  # of 64 coordinates: a pair at 80% has fewer about three times in 10 million


def without(docs: DataFrame, rejected: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that ``rejected`` does not name by doc_id, with their own columns only.

    Rows without doc_id are shown to ``rejected`` under numbers no other row has:
    above all others, so that of equal documents the one with an id stays.
    """
    held = docs.agg(F.min("doc_id").cast("long").alias("least"), F.max("doc_id").cast("long").alias("most"),
                    F.count_if(F.col("doc_id").isNull()).alias("nameless")).first()
    if not held["nameless"]:
        ids = stored(rejected(docs).select("doc_id").where("doc_id is not null").distinct())
        return docs.join(ids, "doc_id", "left_anti").select(*docs.columns)
    numbered = stored(docs.withColumn(KEY, F.when(
        F.col("doc_id").isNull(), F.monotonically_increasing_id())))
    last = numbered.agg(F.max(KEY)).first()[0]
    least, most = held["least"] or 0, held["most"] or 0
    if most + 1 + last < 2 ** 63:
        number = F.lit(most + 1) + F.col(KEY)
    elif least - 1 - last >= -2 ** 63:
        number = F.lit(least - 1) - F.col(KEY)
    else:
        raise ValueError("doc_id leaves no numbers for the rows that have none")
    keyed = numbered.withColumn(KEY, F.coalesce(F.col("doc_id").cast("long"), number))
    ids = stored(rejected(keyed.withColumn("doc_id", F.col(KEY)).drop(KEY))
                 .select(F.col("doc_id").alias(KEY)).distinct())
    return keyed.join(ids, KEY, "left_anti").select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go.  Without labels nothing is rejected."""
    return without(docs, lambda d: score_toxicity(d, table(spark, sf_dir, "labels")).where("predicted = 1"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays; ties can't be."""
    return without(docs, lambda d: near_duplicates(
        d, percent=SIMILAR_PERCENT, matches=SIMILAR_MATCHES).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a text of the benchmark go.  Without a benchmark all stay."""
    return without(docs, lambda d: contaminated(d, table(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; all rows and columns stay, repeated rows are masked alike."""
    return mask_secrets(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids of every row; a NULL text has NULL ids and 0 pieces."""
    return encode(docs).select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("sentencepiece", sentencepiece),
]

# The first stage fits a model and the second finds components: no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
