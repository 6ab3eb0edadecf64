import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.context import Store
from salesloom.operators import prefix, rank, stats
from salesloom.operators.contracts import ChecksFailed, TableCheck, assert_passed, check_table
from salesloom.operators.merge import append_history, merge_latest


@pytest.fixture(scope="module")
def store(spark):
    return Store(spark, "test-operators")


# both the one-window way and the bucketed way
WAYS = [{}, {"buckets": 7}]


@pytest.mark.parametrize("how", WAYS)
def test_prefix_sum_against_brute_force(spark, store, how):
    random.seed(1)
    rows = [(random.choice("ab"), random.randint(-20, 20), random.randint(1, 9))
            for _ in range(500)] + [("a", None, 3), ("a", 7, 1000)]
    df = spark.createDataFrame(rows, "g string, o int, v int")
    for descending in (True, False):
        got = prefix.prefix_sum(
            store, df, "o", {"v": F.sum("v")}, by=["g"], descending=descending, **how)

        def covered(x, y):  # is y at or before x in the order?
            if descending:
                return y is not None and (x is None or y >= x) or x is None
            return y is None or (x is not None and y <= x)

        expected = {
            (g, o): sum(v for h, p, v in rows if h == g and covered(o, p))
            for g, o in {(g, o) for g, o, _ in rows}
        }
        assert {(r["g"], r["o"]): r["v_running"] for r in got.collect()} == expected


@pytest.mark.parametrize("how", WAYS)
def test_abc(spark, store, how):
    def classes(*amounts):
        df = spark.createDataFrame(
            [(f"k{i}", Decimal(a)) for i, a in enumerate(amounts)], "k string, m decimal(18,4)")
        out = prefix.abc_classes(store, df, "k", F.sum("m"), **how)
        return {r["k"]: r["abc_class"] for r in out.collect()}

    assert classes(50, 30, 15, 5) == {"k0": "A", "k1": "A", "k2": "B", "k3": "C"}
    # the one that crosses a cut falls to the next class, equal ones share it
    assert classes(60, 30, 5, 5) == {"k0": "A", "k1": "B", "k2": "C", "k3": "C"}
    # a negative measure lets the running share pass 1
    assert classes(80, 30, -10)["k1"] == "C"


@pytest.mark.parametrize("how", WAYS)
def test_dense_rank(spark, store, how):
    rows = [(m, v) for m in (1, 2) for v in [5, 5, 3, 9, 1, 1, 1, 4]]
    df = spark.createDataFrame(rows, "m int, v int")
    got = prefix.dense_rank_by(store, df, ["m"], "v", "r", **how).collect()
    order = sorted({v for _, v in rows}, reverse=True)
    assert len(got) == len(rows)
    assert all(r["r"] == order.index(r["v"]) + 1 for r in got)


@pytest.mark.parametrize("how", WAYS)
def test_quantiles_interpolate(spark, store, how):
    import numpy as np

    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = prefix.quantile_edges(store, df, "v", [0.25, 0.5, 0.9], **how).first()
    assert list(got) == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])))


def test_hash_rank_is_a_permutation_per_group(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    for digits in (1, 3):
        got = prefix.hash_rank(df, "id", 7, ["g"], prefix_digits=digits).collect()
        for g in range(3):
            mine = [r for r in got if r["g"] == g]
            assert sorted(r["hash_rank"] for r in mine) == list(range(1, len(mine) + 1))
            assert {r["hash_rank_size"] for r in mine} == {len(mine)}
    again = {r["id"]: r["hash_rank"] for r in prefix.hash_rank(df, "id", 7, ["g"]).collect()}
    assert again == {r["id"]: r["hash_rank"] for r in got}
    other = {r["id"]: r["hash_rank"] for r in prefix.hash_rank(df, "id", 8, ["g"]).collect()}
    assert other != again


@pytest.mark.parametrize("how", WAYS)
def test_auc_against_pairs(spark, store, how):
    random.seed(3)
    rows = [(random.choice([0.1, 0.2, 0.5, 0.9]), random.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    got = stats.auc(store, df, "s", "y", **how).first()
    assert got["auc"] == pytest.approx(won / (len(pos) * len(neg)))
    assert (got["positives"], got["negatives"]) == (len(pos), len(neg))


def test_auc_without_positives_is_null(spark, store):
    df = spark.createDataFrame([(0.1, 0)], "s double, y int")
    assert stats.auc(store, df, "s", "y").first()["auc"] is None


def test_lift_breaks_ties_by_id(spark):
    df = spark.createDataFrame(
        [(1, 0.9, 1), (2, 0.5, 0), (3, 0.5, 1), (4, 0.1, 0)], "id int, s double, y int")
    got = stats.lift_at_k(df, "s", "y", "id", 2).first()
    assert (got["hits"], got["precision"], got["base_rate"], got["lift"]) == (1, 0.5, 0.5, 1.0)


def test_bands_with_equal_scores(spark, store):
    df = spark.createDataFrame([(i, 0.5) for i in range(8)], "id int, s double")
    got = stats.score_bands(store, df, "s").collect()
    assert {r["band"] for r in got} == {"Fria"} and len(got) == 8


def test_bands_are_closed_on_the_right(spark, store):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 6)], "id int, s double")
    got = {r["id"]: r["band"] for r in stats.score_bands(store, df, "s").collect()}
    assert got == {1: "Fria", 2: "Fria", 3: "Morna", 4: "Quente", 5: "Muito quente"}


def test_top_and_latest(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4)], "k string, t int, id int")
    assert {(r["k"], r["id"]) for r in rank.latest_per_key(df, ["k"], "t", ["id"]).collect()} == {
        ("a", 3), ("b", 4)}
    assert rank.top_per_key(df, ["k"], [F.col("id")], 2).count() == 3


def test_first_row_per_key_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, t int")
    plan = rank.survivors(df, ["k"], [F.col("t")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_gaps(spark):
    days = [dt.date(2024, 1, d) for d in (1, 4, 10)]
    df = spark.createDataFrame([("a", d) for d in days], "k string, d date")
    got = [r["gap_days"] for r in rank.gaps(df, ["k"], "d").orderBy("d").collect()]
    assert got == [None, 3.0, 6.0]


def ts(day):
    return dt.datetime(2024, 1, day)


def test_merge_latest(spark):
    schema = "id int, who string, state string, at timestamp"
    target = spark.createDataFrame([(1, "t", "old", ts(2)), (2, "t", "keep", ts(9))], schema)
    updates = spark.createDataFrame(
        [(1, "u", "mid", ts(3)), (1, "u", "new", ts(4)), (2, "u", "late", ts(5)),
         (3, "u", "ins", ts(1))], schema)
    once = merge_latest(target, updates, ["id"], "at", keep_from_target=("who",))
    got = {r["id"]: (r["who"], r["state"]) for r in once.collect()}
    assert got == {1: ("t", "new"), 2: ("t", "keep"), 3: ("u", "ins")}
    twice = merge_latest(once, updates, ["id"], "at", keep_from_target=("who",))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_history_is_idempotent(spark):
    history = spark.createDataFrame([(1, "a")], "event_id int, v string")
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "event_id int, v string")
    once = append_history(history, batch, "event_id")
    assert once.count() == 2
    assert append_history(once, batch, "event_id").count() == 2


def test_table_checks(spark):
    df = spark.range(10)
    result = check_table(df, [
        TableCheck("rows", F.count(F.lit(1)), 10, 10), TableCheck("max", F.max("id"), 0, 5)])
    assert {r["check"]: r["passed"] for r in result.collect()} == {"rows": True, "max": False}
    with pytest.raises(ChecksFailed, match="max: observed 9.0"):
        assert_passed(result)
    assert_passed(result.where("passed"))
