import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.plans import features

CUT = dt.date(2024, 6, 1)
FACT = (
    "customer_id int, order_id int, order_date date, sku int, brand string, category string, "
    "revenue decimal(18,4), margin decimal(18,4), is_return boolean"
)


def day(offset):
    return CUT + dt.timedelta(days=offset)


SALES = [
    # customer, order, day, sku, brand, category, revenue, margin
    (1, 10, day(-100), 1, "X", "c1", 100, 40),
    (1, 11, day(-40), 1, "X", "c1", 50, 20),
    (1, 12, day(-40), 2, "Y", "c2", 30, 10),
    (1, 13, day(-10), 2, "Y", "c2", -30, -10),
    (1, 14, day(0), 3, "Z", "c3", 999, 999),
    (2, 20, day(-5), 3, "Z", "c3", 10, 1),
    (3, 30, day(3), 3, "Z", "c3", 10, 1),
]


def make(spark, sales=SALES, opportunities=None, visits=None):
    fact = spark.createDataFrame(
        [(*s[:6], Decimal(s[6]), Decimal(s[7]), s[6] < 0) for s in sales], FACT
    ).withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    launches = spark.createDataFrame(
        [(1, None), (2, day(-120)), (3, day(-121)), (4, day(0))], "sku int, launch_date date")
    opportunities = opportunities if opportunities is not None else [
        (1, day(-20), day(-3), "Ganha"), (1, day(-20), day(2), "Ganha"),
        (1, day(-20), None, "Proposta"), (1, day(0), day(1), "Ganha"),
        (1, day(-9), day(-8), "Perdida"),
    ]
    visits = visits if visits is not None else [
        (1, day(-90), "Fez PEDIDO"), (1, day(-1), "nada"), (1, day(-91), "pedido"),
        (1, day(0), "pedido"),
    ]
    return Ctx(spark, {
        "fact": fact.join(launches, "sku"),
        "opportunities": spark.createDataFrame(
            opportunities, "customer_id int, opened_on date, closed_on date, stage string"),
        "visits": spark.createDataFrame(
            visits, "customer_id int, visited_on date, outcome string"),
    }, CUT)


def by_customer(df):
    return {r["customer_id"]: r.asDict() for r in df.collect()}


def test_values(spark):
    rows = by_customer(features.build_features(make(spark), CUT))
    assert set(rows) == {1, 2}
    one = rows[1]
    assert one["recency_days"] == 10 and one["order_frequency"] == 4
    assert one["total_value"] == 150 and one["total_margin"] == 60
    assert one["avg_ticket"] == 37.5 and one["margin_share"] == 0.4
    assert one["mean_gap_days"] == 45 and one["gap_stddev_days"] == 15
    assert one["relative_delay"] == pytest.approx(10 / 45)
    assert one["orders_90d"] == 3
    assert one["open_opportunities"] == 2 and one["won_opportunities"] == 1
    assert one["win_rate"] == 0.25
    assert one["visits_90d"] == 2 and one["visit_conversion"] == 0.5
    assert (one["distinct_skus"], one["distinct_brands"], one["distinct_categories"]) == (2, 2, 2)
    assert one["top_brand_share"] == 1.0 and one["bought_launch"] == 1
    assert one["reference"] == CUT


def test_single_order_has_no_rhythm(spark):
    two = by_customer(features.build_features(make(spark), CUT))[2]
    assert two["mean_gap_days"] is None and two["relative_delay"] is None
    assert two["open_opportunities"] == 0 and two["visit_conversion"] == 0
    assert two["bought_launch"] == 0


def test_delay_is_capped(spark):
    sales = [(1, 1, day(-300), 1, "X", "c", 1, 1), (1, 2, day(-299), 1, "X", "c", 1, 1)]
    assert by_customer(features.build_features(make(spark, sales), CUT))[1][
        "relative_delay"] == 10.0


def test_stage_on_record_when_asked(spark):
    one = by_customer(features.build_features(make(spark), CUT, stage_as_of=False))[1]
    assert one["won_opportunities"] == 2 and one["open_opportunities"] == 1


def test_nothing_after_the_cut_changes_a_feature(spark):
    base = by_customer(features.build_features(make(spark), CUT))
    later = SALES + [(c, 1000 + i, day(i), 4, "W", "c9", 500, 100)
                     for c in (1, 2) for i in range(0, 40, 3)]
    kept = [s for s in SALES if s[2] < CUT]
    for sales in (later, kept):
        assert by_customer(features.build_features(make(spark, sales), CUT)) == base


def test_label_window(spark):
    ctx = make(spark, SALES + [(4, 40, day(7), 1, "X", "c", 1, 1)])
    assert {r["customer_id"] for r in features.label(ctx, CUT).collect()} == {1, 3}
    training = by_customer(features.training_set(ctx, CUT))
    assert {c: r["bought"] for c, r in training.items()} == {1: 1, 2: 0}


def test_leakage_report(spark):
    ctx = make(spark)
    report = features.leakage_report(
        features.training_set(ctx, CUT), features.scoring_set(ctx, CUT)
    ).collect()
    assert [r["dataset"] for r in report] == ["training", "scoring"]
    assert report[0]["buyers"] == 1 and report[0]["base_rate_pct"] == 50.0
    assert all(r["min_recency"] >= 0 for r in report)


def test_year_boundary_is_not_pruned_away(spark):
    ctx = make(spark, [(1, 1, dt.date(2023, 12, 31), 1, "X", "c", 1, 1),
                       (1, 2, dt.date(2024, 1, 1), 1, "X", "c", 1, 1)])
    got = features.sales_between(ctx, dt.date(2023, 12, 1), dt.date(2024, 1, 2))
    assert got.count() == 2
    assert features.sales_between(ctx, None, dt.date(2024, 1, 1)).count() == 1
