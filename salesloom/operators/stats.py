"""Ranking quality of a score: AUC, lift, bands and calibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.context import Store
from salesloom.operators.prefix import prefix_sum, quantile_edges

# fixed values: names of the score bands from coldest to hottest
BAND_NAMES = ("Fria", "Morna", "Quente", "Muito quente")


def auc(
    store: Store, df: DataFrame, score: str, label: str, by: Sequence[str] = (), **how
) -> DataFrame:
    """Exact ROC AUC per ``by``: the tie-averaged rank sum.

    A positive beats every negative with a lower score and half of those with
    the same one, so running counts per distinct score are all that is needed.
    """
    runs = prefix_sum(
        store, df, score,
        {"pos": F.sum(F.when(F.col(label) == 1, 1).otherwise(0)),
         "neg": F.sum(F.when(F.col(label) == 1, 0).otherwise(1))},
        by=by, descending=False, **how,
    )
    beaten = F.col("neg_running") - F.col("neg") / 2
    sums = runs.groupBy(*by).agg(
        F.sum(F.col("pos").cast("double") * beaten).alias("_beaten"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(
        *by, (F.col("_beaten") / F.nullif(pairs, F.lit(0.0))).alias("auc"),
        "positives", "negatives",
    )


def lift_at_k(df: DataFrame, score: str, label: str, tie: str, k: int = 200) -> DataFrame:
    """Hits and precision of the ``k`` best scores against the base rate, one row."""
    base = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    top = (
        df.orderBy(F.col(score).desc_nulls_last(), F.col(tie)).limit(k)
        .agg(F.count(F.lit(1)).alias("k"), F.sum(F.col(label).cast("bigint")).alias("hits"),
             F.avg(F.col(label).cast("double")).alias("precision"))
    )
    return top.withColumn("base_rate", base).withColumn(
        "lift", F.col("precision") / F.nullif(F.col("base_rate"), F.lit(0.0))
    )


def score_bands(
    store: Store, df: DataFrame, score: str, out: str = "band",
    names: Sequence[str] = BAND_NAMES, **how,
) -> DataFrame:
    """Bands between equally spaced quantile edges, closed on the right.

    Edges that coincide leave the bands between them empty.
    """
    probs = [i / len(names) for i in range(1, len(names))]
    edges = quantile_edges(store, df, score, probs, **how).select(F.struct("*")).scalar()
    chain = F.when(F.col(score) <= edges["q0"], names[0])
    for i, name in enumerate(names[1:-1], start=1):
        chain = chain.when(F.col(score) <= edges[f"q{i}"], name)
    chain = chain.when(F.col(score).isNotNull(), names[-1])
    return df.withColumn(out, chain)


def calibration(df: DataFrame, score: str, label: str, band: str = "band") -> DataFrame:
    """Customers, buyers, purchase rate and mean score per band."""
    return df.groupBy(band).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col(label).cast("bigint")).alias("buyers"),
        F.avg(F.col(label).cast("double")).alias("purchase_rate"),
        F.avg(score).alias("mean_score"),
    ).orderBy("mean_score")
