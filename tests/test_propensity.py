import random

import pytest
from pyspark.sql import functions as F

from salesloom.context import Store
from salesloom.operators.contracts import ChecksFailed, assert_passed
from salesloom.plans import propensity
from salesloom.plans.features import FEATURES


@pytest.fixture(scope="module")
def store(spark):
    return Store(spark, "test-propensity")


@pytest.fixture(scope="module")
def training(spark, store):
    """600 customers; recent ones buy more often, one in ten has no rhythm."""
    random.seed(5)
    rows = []
    for i in range(600):
        recency = random.uniform(0, 100)
        values = {f: random.uniform(0, 1) for f in FEATURES}
        values["recency_days"] = recency
        if i % 10 == 0:
            values.update(mean_gap_days=None, gap_stddev_days=None, relative_delay=None)
        rows.append((i, *[values[f] for f in FEATURES],
                     int(random.random() < (0.7 if recency < 25 else 0.05))))
    schema = "customer_id int, " + ", ".join(f"{f} double" for f in FEATURES) + ", bought int"
    return store.scratch(spark.createDataFrame(rows, schema).withColumn(
        "reference", F.lit("2024-06-01").cast("date")))


@pytest.fixture(scope="module")
def parts(training, store):
    marked = store.scratch(propensity.stratified_split(training))
    return marked.where(~F.col("holdout")), marked.where(F.col("holdout"))


@pytest.fixture(scope="module")
def model(parts):
    return propensity.train(parts[0], iterations=8)


def test_split_is_exact_per_class(training):
    counts = propensity.stratified_split(training).groupBy("bought").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("holdout").alias("h")).collect()
    assert all(r["h"] == -(-r["n"] // 4) for r in counts)


def test_folds_are_even_per_class(training):
    counts = propensity.stratified_folds(training).groupBy("bought", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r["bought"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_model_beats_coin_and_rules_are_ranked(store, parts, model):
    scored = propensity.score(model, parts[1])
    assert scored.where("score < 0 OR score > 1").count() == 0
    from salesloom.operators.stats import auc

    assert auc(store, scored, "score", "bought").first()["auc"] > 0.7
    rules = {r["rule"]: r for r in propensity.baseline_auc(store, parts[1]).collect()}
    assert rules["recency"]["is_best"] and rules["recency"]["auc"] > 0.7
    assert rules["coin"]["auc"] == 0.5 and not rules["coin"]["is_best"]


def test_missing_values_do_not_stop_scoring(training, model):
    lonely = training.where("mean_gap_days IS NULL")
    assert propensity.score(model, lonely).where("score IS NULL").count() == 0


def test_every_row_is_scored_out_of_fold_once(store, training):
    oof = propensity.oof_scores(store, training, folds=3, iterations=3)
    assert oof.count() == 600 and oof.select("customer_id").distinct().count() == 600


def test_importance_finds_the_signal(store, parts, model):
    drops = propensity.permutation_importance(store, model, parts[1], repeats=2).collect()
    assert drops[0]["feature"] == "recency_days" and drops[0]["importance_mean"] > 0.1
    assert len(drops) == 10


def test_metrics_gates_and_bands(spark, store, parts, model, training):
    scored = store.scratch(propensity.score(model, parts[1]))
    row = propensity.model_metrics(
        store, scored, scored, propensity.baseline_auc(store, parts[1]), 3,
        F.lit("2024-06-01").cast("timestamp"), k=20, feature_top="recency_days")
    got = row.first()
    assert got["version"] == 3 and 0.5 < got["auc"] < 1 and got["lift_top_k"] > 1
    gates = {r["check"]: r["passed"] for r in propensity.model_gates(row, min_gain=-1).collect()}
    assert gates == {"auc_beats_rules": True, "auc_plausible": True, "lift_pays": True}
    with pytest.raises(ChecksFailed, match="lift_pays"):
        assert_passed(propensity.model_gates(row, min_gain=-1, min_lift=50))
    bands = propensity.calibration_by_band(store, scored).collect()
    assert [r["band"] for r in bands] == ["Fria", "Morna", "Quente", "Muito quente"]
    assert bands[-1]["purchase_rate"] > bands[0]["purchase_rate"]
    everyone = propensity.propensity_scores(store, model, training, 3)
    assert everyone.count() == 600
    assert {r["version"] for r in everyone.select("version").distinct().collect()} == {3}


def test_versions_are_promoted(spark, tmp_path, model, training):
    registry = propensity.save_version(spark, model, str(tmp_path), "m")
    registry = propensity.save_version(spark, model, str(tmp_path), "m", registry)
    registry = propensity.save_version(spark, model, str(tmp_path), "m", registry, promote=False)
    assert {(r["version"], r["promoted"]) for r in registry.collect()} == {
        (1, False), (2, True), (3, False)}
    loaded, version = propensity.load_promoted(registry, "m")
    assert version == 2
    few = training.limit(20)
    assert sorted(map(tuple, propensity.score(loaded, few).collect())) == sorted(
        map(tuple, propensity.score(model, few).collect()))
    with pytest.raises(LookupError):
        propensity.load_promoted(registry, "other")
