"""Boosting in shared passes: exchange or not, missing values, node tables in another engine."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.context import Store
from salesloom.operators import boosting
from salesloom.operators.stats import auc, lift_at_k, score_bands

FEATURES = ["a", "b", "c", "d"]
HOW = {"iterations": 6, "step": 0.3, "depth": 4, "least_rows": 5}


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(3)
    out = []
    for i in range(900):
        a, b = random.gauss(0, 1), float(random.randint(0, 4))
        c = None if i % 7 == 0 else random.gauss(0, 1)
        chance = 1 / (1 + math.exp(1.5 - 2 * a - (b == 2) - (2 if c is None else 0)))
        out.append((i, a, b, c, None, int(random.random() < chance)))
    df = spark.createDataFrame(out, "id int, a double, b double, c double, d double, y int")
    return Store(spark, "test-boosting").scratch(df.repartition(3))


@pytest.fixture(scope="module")
def models(rows):
    conditions = {"all": F.lit(True), "odd": F.col("id") % 2 == 1, "none": F.col("id") < 0}
    return boosting.fit(rows, FEATURES, "y", conditions, max_leaves=9, **HOW)


def plain(rows):
    data = rows.orderBy("id").toPandas()
    return data[FEATURES].to_numpy(float), data["y"].to_numpy()


def test_exchanged_sums_give_the_same_trees(rows, models):
    conditions = {"all": F.lit(True), "odd": F.col("id") % 2 == 1}
    apart = boosting.fit(rows, FEATURES, "y", conditions, max_leaves=9, rows_per_block=100, **HOW)
    for name in conditions:
        assert apart[name].rows() == models[name].rows()


def brute_stump(x, y, least):
    """The best first split by trying every value of every feature."""
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))
    best = (0.0,)
    for f in range(x.shape[1]):
        missing = np.isnan(x[:, f])
        for cut in np.unique(x[~missing, f]):
            for missing_left in (False, True):
                left = (x[:, f] <= cut) | (missing & missing_left)
                if min(left.sum(), (~left).sum()) >= least:
                    gain = sum(g[s].sum() ** 2 / h[s].sum() for s in (left, ~left)) - g.sum() ** 2 / h.sum()
                    if gain > best[0] + 1e-9:
                        best = (gain, f, cut)
    return best


def test_first_split_is_the_best_of_all(rows):
    few = rows.where("id < 200")
    x, y = plain(few)
    tree = boosting.fit(few, FEATURES, "y", {"m": F.lit(True)}, 1, 1.0, 1, 5)["m"]
    _, f, cut = brute_stump(x, y, 5)
    root = next(r for r in tree.rows() if r[:2] == (0, 1))
    assert root[2] == FEATURES[f] and root[3] == pytest.approx(cut)


def test_trees_keep_their_limits(rows, models):
    x, y = plain(rows)
    for tree in models["all"].trees:
        assert (tree.feature >= 0).sum() + 1 <= 9
        ends = boosting._route(tree, boosting.Bins(models["all"].edges).of(x), boosting.Bins(
            models["all"].edges).count, 4)
        assert np.bincount(ends)[np.unique(ends)].min() >= 5
    assert models["none"].trees == [] and models["none"].predict(x).tolist() == [0.5] * len(x)
    assert np.mean((models["all"].predict(x) > 0.5) == y) > 0.75


def test_missing_values_are_learned(models):
    x = np.array([[0.0, 1.0, np.nan, np.nan], [0.0, 1.0, 0.0, np.nan]])
    missing, present = models["all"].predict(x)
    assert missing > present + 0.1


NODE_SCORES = """
WITH RECURSIVE walk AS (
    SELECT id, tree, 1 AS node FROM features, (SELECT DISTINCT tree FROM nodes)
    UNION ALL
    SELECT w.id, w.tree, 2 * w.node + CASE WHEN v.value IS NULL THEN CASE WHEN n.missing_left THEN 0 ELSE 1 END
                                           WHEN v.value <= n.cut THEN 0 ELSE 1 END
    FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature IS NOT NULL
         LEFT JOIN long v ON v.id = w.id AND v.feature = n.feature)
SELECT id, 1 / (1 + exp(-sum(value))) AS score
FROM walk JOIN nodes USING (tree, node) WHERE nodes.feature IS NULL GROUP BY id
"""


def test_node_table_in_another_engine(spark, rows, models):
    """Scores, AUC, lift and bands of the fitted model, from its node table in SQL."""
    store = Store(spark, "test-boosting")
    model = models["odd"]
    con = duckdb.connect()
    features = rows.toPandas()
    nodes = model.nodes(spark).toPandas().astype({"cut": float, "value": float})
    con.register("nodes_", nodes)
    con.execute("CREATE TABLE nodes AS SELECT tree, node, feature, cut, missing_left, value FROM nodes_")
    con.register("features_", features)
    con.execute("CREATE TABLE features AS SELECT id, y, a, b, nullif(c, 'NaN') AS c, nullif(d, 'NaN') AS d FROM features_")
    con.execute("CREATE TABLE long AS SELECT * FROM (UNPIVOT features ON a, b, c, d INTO NAME feature VALUE value)")
    con.execute(f"CREATE TABLE scored AS SELECT s.*, y FROM ({NODE_SCORES}) s JOIN features USING (id)")
    ours = store.scratch(rows.select("id", "y", model.score([F.col(f) for f in FEATURES]).alias("score")))
    theirs = dict(con.execute("SELECT id, score FROM scored").fetchall())
    mine = {r["id"]: r["score"] for r in ours.collect()}
    assert mine.keys() == theirs.keys() and all(abs(mine[i] - theirs[i]) < 1e-9 for i in mine)
    by_joins = boosting.relational_scores(rows.select("id", *FEATURES), model.nodes(spark), "id", 4)
    assert all(abs(mine[r["id"]] - r["score"]) < 1e-9 for r in by_joins.collect())
    con.execute("UPDATE scored SET score = round(score, 12)")
    rounded = store.scratch(ours.withColumn("score", F.round("score", 12)))
    their_auc, = con.execute("""
        SELECT (sum(CASE WHEN y = 1 THEN r END) - any_value(p) * (any_value(p) + 1) / 2) / any_value(p * (n - p))
        FROM (SELECT y, avg(i) OVER (PARTITION BY score) AS r, sum(y) OVER () AS p, count(*) OVER () AS n
              FROM (SELECT *, row_number() OVER (ORDER BY score) AS i FROM scored))""").fetchone()
    assert abs(auc(store, rounded, "score", "y").first()["auc"] - their_auc) < 1e-9
    their_lift, = con.execute("""
        SELECT avg(y) / (SELECT avg(y) FROM scored)
        FROM (SELECT y FROM scored ORDER BY score DESC, id LIMIT 100)""").fetchone()
    assert abs(lift_at_k(rounded, "score", "y", "id", 100).first()["lift"] - their_lift) < 1e-9
    bands = con.execute("""
        SELECT id, 1 + (score > q[1])::INT + (score > q[2])::INT + (score > q[3])::INT
        FROM scored, (SELECT quantile_cont(score, [0.25, 0.5, 0.75]) AS q FROM scored)""").fetchall()
    from salesloom.operators.stats import BAND_NAMES
    got = {r["id"]: BAND_NAMES.index(r["band"]) + 1 for r in score_bands(store, rounded, "score").collect()}
    assert got == dict(bands)


def test_models_are_kept(spark, rows, models, tmp_path):
    models["all"].save(spark, str(tmp_path / "m"))
    again = boosting.Boosted.load(spark, str(tmp_path / "m"))
    x, _ = plain(rows)
    assert sorted(again.rows(), key=str) == sorted(models["all"].rows(), key=str)
    assert again.predict(x).tolist() == models["all"].predict(x).tolist()


def test_odd_tables(spark):
    schema = "id int, a double, b double, c double, d double, y int"
    for data in ([], [(1, 1.0, None, None, None, 1)], [(1, 1.0, None, None, None, None)] * 3,
                 [(i, None, None, None, None, i % 2) for i in range(40)]):
        model = boosting.fit(spark.createDataFrame(data, schema), FEATURES, "y", {"m": F.lit(True)}, **HOW)["m"]
        assert 0 < model.predict(np.zeros((1, 4)))[0] < 1


def random_block(n, width=4, seed=7):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)), 1)
    x[rng.random((n, width)) < 0.1] = np.nan
    y = (rng.random(n) < 1 / (1 + np.exp(1 - 2 * np.nan_to_num(x[:, 0])))).astype(float)
    bins = boosting.Bins([np.unique(np.round(np.linspace(-2, 2, 30), 1)) for _ in range(width)])
    return x, y, bins


def test_seventy_thousand_rows_need_no_exchange_of_sums(spark):
    df = Store(spark, "test-boosting").scratch(spark.range(70_000).select(
        "id", (F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 13).cast("double").alias("b"),
        (F.hash("id") % 5).cast("double").alias("c"), F.lit(None).cast("double").alias("d"),
        (F.col("id") % 97 + F.hash("id") % 40 > 60).cast("int").alias("y")))
    context = spark.sparkContext
    context.setJobGroup("test-boosting", "fit")
    try:
        model = boosting.fit(df, FEATURES, "y", {"m": F.lit(True)}, **HOW)["m"]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.trees) == 6
    assert len(context.statusTracker().getJobIdsForGroup("test-boosting")) < HOW["iterations"] * HOW["depth"]


def test_sums_of_a_larger_child_are_what_adding_gives():
    x, y, bins = random_block(5000)
    held, raw = np.ascontiguousarray(bins.of(x).T), np.zeros(5000)
    alone = boosting._Alone((0, held, y, raw), bins, 5)
    gradient, weight = boosting._weights(y, raw)
    seen = []

    def splits(partial, active, level):
        found = alone.splits(partial, active, level)
        for node in active[0].tolist():
            own = boosting._cell_sums(held, alone.rows_of(partial[0], node), gradient, weight, bins)
            assert np.array_equal(alone.sums[node], own)
            seen.append(node)
        return found

    tree = boosting._grow([0], splits, 4, 5, 9, 0.3)[0]
    assert len(seen) > 10 and np.array_equal(
        alone.with_tree(tree)[3], boosting._with_tree((0, held, y, raw), tree, bins)[3])


def test_sums_are_those_of_every_row():
    x, y, bins = random_block(boosting.ROWS_PER_SUM + 3000)
    held, raw = np.ascontiguousarray(bins.of(x).T), np.linspace(-3, 3, len(y))
    chance = 1 / (1 + np.exp(-raw))
    of_row = (np.rint((chance - y) * 2 ** 20), np.rint(chance * (1 - chance) * 2 ** 20), np.ones(len(y)))
    for rows in (np.arange(len(y)), np.arange(0, len(y), 3), np.arange(50), np.empty(0, np.int64)):
        sums = boosting._cell_sums(held, rows, *boosting._weights(y, raw), bins)
        for got, values in zip(sums, of_row):
            want = np.zeros(bins.cells)
            for f in range(len(held)):
                np.add.at(want, bins.first[f] + held[f][rows].astype(int), values[rows])
            assert np.array_equal(got, want)


def test_scores_do_not_walk_the_trees(monkeypatch, rows, models):
    x, _ = plain(rows)
    for name in ("all", "none"):
        model = models[name]
        bins = boosting.Bins(model.edges)
        raw = np.full(len(x), model.base)
        for tree in model.trees:
            raw += tree.value[boosting._route(tree, bins.of(x), bins.count, 4)]
        with monkeypatch.context() as patch:
            patch.setattr(boosting, "_route", None)
            assert np.array_equal(model.predict(x), 1 / (1 + np.exp(-raw)))


def test_scores_of_trees_with_many_leaves():
    tree = boosting.Tree.of(7)
    tree.feature[1:128], tree.bin[1:128] = np.arange(127) % 3, np.arange(127) % 11
    tree.missing_left[1:128] = np.arange(127) % 2 == 0
    tree.value[128:] = np.arange(128)
    x, _, bins = random_block(400, 3)
    model = boosting.Boosted(["a", "b", "c"], 0.0, bins.edges, [tree])
    assert model.masks == [None]
    raw = tree.value[boosting._route(tree, bins.of(x), bins.count, 7)]
    assert np.array_equal(model.predict(x), 1 / (1 + np.exp(-raw)))
    tree.feature[64:128] = -1
    tree.value[64:128] = np.arange(64) / 64
    few = boosting.Boosted(["a", "b", "c"], 0.0, bins.edges, [tree])
    raw = tree.value[boosting._route(tree, bins.of(x), bins.count, 7)]
    assert few.masks != [None] and np.array_equal(few.predict(x), 1 / (1 + np.exp(-raw)))


def test_node_table_scores_are_dealt_to_all_tasks(spark, rows, models):
    """A small table in one file meets every tree, and its values are found by place."""
    one = Store(spark, "test-boosting").scratch(rows.select("id", *FEATURES).coalesce(1))
    scored = boosting.relational_scores(one, models["odd"].nodes(spark), "id", 4)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    assert f"hashpartitioning(id#" in plan and f", {parts}), REPARTITION_BY_NUM" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "map<" not in scored._jdf.queryExecution().analyzed().treeString()
    assert scored.count() == 900
