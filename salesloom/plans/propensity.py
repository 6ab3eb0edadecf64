"""Purchase-propensity model, its rules, metrics and gates.

The training rows never leave the executors: the split is a seeded hash order,
AUC and bands come from running counts, and trees grow on sums of gradients
(``operators.boosting``).  The main model and those of the folds are fitted together.
"""

from __future__ import annotations

from collections.abc import Hashable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.context import Store
from salesloom.operators.boosting import Boosted, fit, score_by
from salesloom.operators.contracts import judge
from salesloom.operators.prefix import hash_rank
from salesloom.operators.stats import auc, calibration, lift_at_k, score_bands
from salesloom.plans.features import FEATURES

# fixed values: settings of the model and thresholds it has to pass
SEED = 42
HOLDOUT = 0.25
FOLDS = 5
ITERATIONS = 300
STEP_SIZE = 0.05
MAX_DEPTH = 6
MIN_ROWS_PER_LEAF = 20
TOP_K = 200
MIN_GAIN_OVER_RULES = 0.05
MAX_PLAUSIBLE_AUC = 0.99
MIN_LIFT = 2.5

MAX_LEAVES = 31
MAIN = "main"


def stratified_split(
    df: DataFrame, label: str = "bought", frac: float = HOLDOUT, seed: int = SEED,
    key: str = "customer_id",
) -> DataFrame:
    """Add ``holdout``: exactly ``ceil(frac * n)`` rows of every class, seeded."""
    ranked = hash_rank(df, key, seed, [label], "_r")
    cut = F.ceil(F.col("_r_size") * F.lit(float(frac)))
    return ranked.withColumn("holdout", F.col("_r") <= cut).drop("_r", "_r_size")


def stratified_folds(
    df: DataFrame, label: str = "bought", folds: int = FOLDS, seed: int = SEED,
    key: str = "customer_id",
) -> DataFrame:
    """Add ``fold`` 0 … folds-1, every class spread evenly over them."""
    ranked = hash_rank(df, key, seed, [label], "_r")
    return ranked.withColumn("fold", ((F.col("_r") - 1) % folds).cast("int")).drop(
        "_r", "_r_size"
    )


def rule_scores() -> dict[str, Column]:
    """Single-feature rules the model has to beat; NULL counts as zero."""
    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0.0))

    return {
        "recency": -zero("recency_days"), "value": zero("total_value"),
        "delay": zero("relative_delay"),
    }


def baseline_auc(store: Store, holdout: DataFrame, label: str = "bought", **how) -> DataFrame:
    """AUC of each rule, the coin's 0.5 and which rule is best."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("rule"), score.alias("rule_score"))
        for name, score in rule_scores().items()
    ])
    long = holdout.select(label, F.inline(pairs))
    rules = auc(store, long, "rule_score", label, ["rule"], **how).select("rule", "auc")
    rules = store.scratch(rules)  # three rows, read twice
    rules = rules.withColumn("is_best", F.col("auc") == rules.agg(F.max("auc")).scalar())
    coin = store.spark.range(1).select(
        F.lit("coin").alias("rule"), F.lit(0.5).alias("auc"), F.lit(False).alias("is_best")
    )
    return rules.unionByName(coin)


def fitted(
    df: DataFrame, conditions: Mapping[Hashable, Column], features: Sequence[str] = FEATURES,
    label: str = "bought", iterations: int = ITERATIONS,
) -> dict[Hashable, Boosted]:
    """A model for each condition on the rows, all in the same passes; NULL features stay missing."""
    return fit(df, features, label, conditions, iterations, STEP_SIZE, MAX_DEPTH, MIN_ROWS_PER_LEAF, MAX_LEAVES)


def train(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str = "bought", iterations: int = ITERATIONS,
) -> Boosted:
    """Gradient-boosted trees on all rows of ``df``, which should be stored."""
    return fitted(df, {MAIN: F.lit(True)}, features, label, iterations)[MAIN]


def fold_conditions(folds: int = FOLDS) -> dict[Hashable, Column]:
    """The model of a fold sees the rows of the others."""
    return {k: F.col("fold") != k for k in range(folds)}


def train_all(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str = "bought", folds: int = FOLDS,
    iterations: int = ITERATIONS,
) -> dict[Hashable, Boosted]:
    """The main model (without ``holdout``) and one for each ``fold`` of ``df``, in one go."""
    return fitted(df, {MAIN: ~F.col("holdout"), **fold_conditions(folds)}, features, label, iterations)


def score(
    model: Boosted, df: DataFrame, features: Sequence[str] = FEATURES, out: str = "score"
) -> DataFrame:
    """``df`` with the probability of a purchase."""
    keep = [c for c in df.columns if c not in features]
    return df.select(*keep, model.score([F.col(f) for f in features]).alias(out))


def oof_scores(
    store: Store, df: DataFrame, features: Sequence[str] = FEATURES, label: str = "bought",
    folds: int = FOLDS, iterations: int = ITERATIONS, seed: int = SEED, key: str = "customer_id",
    models: Mapping[Hashable, Boosted] | None = None,
) -> DataFrame:
    """Each row scored by a model that has not seen its fold.

    ``models`` by fold, if they are fitted already; ``df`` has its ``fold`` then.
    """
    if models is None:
        df = store.scratch(stratified_folds(df, label, folds, seed, key))
        models = fitted(df, fold_conditions(folds), features, label, iterations)
    keep = [c for c in df.columns if c not in features]
    by_fold = [models[k] for k in range(folds)]
    return df.select(*keep, score_by(by_fold, F.col("fold"), [F.col(f) for f in features]).alias("score"))


def permutation_importance(
    store: Store, model: Boosted, df: DataFrame, features: Sequence[str] = FEATURES,
    label: str = "bought", repeats: int = 5, seed: int = SEED, key: str = "customer_id",
    top: int | None = 10, **how,
) -> DataFrame:
    """Mean and deviation of the AUC lost when one feature is shuffled.

    A repeat pairs each row with another through two seeded hash orders; every
    feature in turn takes the partner's value.  All features and repeats are
    scored as one table and their AUCs come from one grouped pass.
    """
    rows = df.select(key, label, F.array(*[F.col(f).cast("double") for f in features]).alias("own"))
    taken = F.array(*[F.lit(i) for i in range(len(features))])
    variants = []
    for r in range(repeats):
        left = hash_rank(rows, key, seed + 2 * r, out="_place").drop("_place_size")
        right = hash_rank(rows.select(key, F.col("own").alias("other")), key, seed + 2 * r + 1,
                          out="_at").drop("_at_size", key)
        pairs = left.join(right, F.col("_place") == F.col("_at"))
        variants.append(pairs.select(
            F.lit(r).alias("repeat"), label, "own", "other",
            F.posexplode(taken).alias("feature_no", "swap"),
        ))
    mixed = reduce(DataFrame.unionByName, variants).withColumn(
        "values", F.expr(
            "transform(own, (x, i) -> CASE WHEN i = swap THEN other[i] ELSE x END)"
        )
    )
    untouched = rows.select(
        F.lit(-1).alias("repeat"), label, F.lit(-1).alias("feature_no"), F.col("own").alias("values")
    )
    table = untouched.unionByName(mixed.select("repeat", label, "feature_no", "values"))
    scored = table.select(
        "repeat", label, "feature_no",
        model.score([F.col("values")[i] for i in range(len(features))]).alias("score"))
    aucs = auc(store, scored, "score", label, ["feature_no", "repeat"], **how)
    base = aucs.where(F.col("repeat") == -1).select("auc").scalar()
    names = F.array(*[F.lit(f) for f in features])
    drops = aucs.where(F.col("repeat") >= 0).select(
        names[F.col("feature_no")].alias("feature"), (base - F.col("auc")).alias("drop")
    )
    result = drops.groupBy("feature").agg(
        F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")
    ).orderBy(F.desc("importance_mean"), "feature")
    return result if top is None else result.limit(top)


def propensity_scores(
    store: Store, model: Boosted, scoring: DataFrame, version: int,
    features: Sequence[str] = FEATURES, **how,
) -> DataFrame:
    """Score and band per customer, with the cut date and the model version."""
    scored = score(model, scoring.select("customer_id", "reference", *features), features)
    stored = store.scratch(scored)
    return score_bands(store, stored, "score", **how).withColumn(
        "version", F.lit(version).cast("bigint")
    )


def model_metrics(
    store: Store, holdout_scored: DataFrame, oof: DataFrame, rules: DataFrame, version: int,
    trained_at: Column, label: str = "bought", k: int = TOP_K, feature_top: str | None = None,
    **how,
) -> DataFrame:
    """One row per trained version."""
    quality = auc(store, holdout_scored, "score", label, **how).select(
        F.round("auc", 4).alias("auc")
    )
    gain = lift_at_k(oof, "score", label, "customer_id", k).select(
        F.round("lift", 2).alias("lift_top_k"), F.col("hits").alias("hits_top_k"),
        F.round("base_rate", 4).alias("base_rate"),
    )
    by_rule = rules.groupBy().pivot("rule", ["recency", "value", "delay"]).agg(
        F.round(F.first("auc"), 4)
    )
    gained, ruled = (df.select(F.struct("*")).scalar() for df in (gain, by_rule))
    return quality.select(
        F.lit(version).cast("bigint").alias("version"), "auc",
        *[gained[c].alias(c) for c in gain.columns],
        *[ruled[c].alias(f"baseline_{c}") for c in by_rule.columns],
        F.lit(feature_top).cast("string").alias("feature_top"), trained_at.alias("trained_at"),
    )


def model_gates(
    metrics: DataFrame, min_gain: float = MIN_GAIN_OVER_RULES, max_auc: float = MAX_PLAUSIBLE_AUC,
    min_lift: float = MIN_LIFT,
) -> DataFrame:
    """Three checks: better than every rule, not too good to be true, worth the calls."""
    best_rule = F.greatest("baseline_recency", "baseline_value", "baseline_delay")
    far = float("inf")

    def row(name: str, observed: Column, low: Column, high: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), observed.alias("observed"),
                        low.alias("low"), high.alias("high"))

    checks = F.array(
        row("auc_beats_rules", F.col("auc"), best_rule + min_gain, F.lit(far)),
        row("auc_plausible", F.col("auc"), F.lit(-far), F.lit(max_auc - 1e-12)),
        row("lift_pays", F.col("lift_top_k"), F.lit(float(min_lift)), F.lit(far)),
    )
    return judge(metrics.select(F.inline(checks)))


def calibration_by_band(
    store: Store, scored: DataFrame, label: str = "bought", **how
) -> DataFrame:
    """Purchase rate per score band; it has to rise from band to band."""
    return calibration(score_bands(store, scored, "score", **how), "score", label)


REGISTRY_COLUMNS = "name string, version bigint, path string, promoted boolean"


def save_version(
    spark, model: Boosted, root: str, name: str, registry: DataFrame | None = None,
    promote: bool = True,
) -> DataFrame:
    """Save the next version under ``root`` and return the registry with its row.

    Versions count up from what the registry holds; promoting a version takes
    the mark from the one before.
    """
    registry = registry if registry is not None else spark.createDataFrame([], REGISTRY_COLUMNS)
    mine = F.col("name") == name
    last = registry.where(mine).agg(F.max("version").alias("v")).first()["v"]
    version = (last or 0) + 1
    path = f"{root}/{name}/v{version}"
    model.save(spark, path)
    row = spark.createDataFrame([(name, version, path, promote)], REGISTRY_COLUMNS)
    if promote:
        registry = registry.withColumn("promoted", F.col("promoted") & ~mine)
    return registry.unionByName(row)


def load_promoted(registry: DataFrame, name: str) -> tuple[Boosted, int]:
    """The promoted version of a model and its number."""
    row = (
        registry.where((F.col("name") == name) & F.col("promoted"))
        .orderBy(F.desc("version")).first()
    )
    if row is None:
        raise LookupError(f"no promoted version of {name}")
    return Boosted.load(registry.sparkSession, row["path"]), row["version"]
