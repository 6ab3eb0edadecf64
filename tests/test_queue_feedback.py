import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.functions import table_functions as fn
from salesloom.operators.contracts import ChecksFailed, assert_passed
from salesloom.plans import feedback, queue

TODAY = dt.date(2024, 6, 1)


def day(offset):
    return TODAY + dt.timedelta(days=offset)


@pytest.fixture(scope="module")
def ctx(spark):
    sales = [  # customer, sku, brand, day, revenue, is_return
        (1, "A", "X", -200, 100, False), (1, "A", "X", -190, 100, False),
        (1, "B", "X", -180, 10, False), (1, "B", "X", -5, 10, False),
        (1, "C", "Y", -300, 50, False), (1, "A", "X", -3, -100, True),
        (2, "C", "Y", -10, 50, False), (3, "D", "Y", -400, 5, False),
        (3, "E", "Y", -400, 5, False),
    ]
    fact = spark.createDataFrame(
        [(i, c, s, b, "cat", day(d), Decimal(v), r) for i, (c, s, b, d, v, r) in enumerate(sales)],
        "order_id int, customer_id int, sku string, brand string, category string, "
        "order_date date, revenue decimal(18,4), is_return boolean")
    return Ctx(spark, {
        "fact": fact,
        "customers": spark.createDataFrame(
            [(i, f"name {i}", "city", "st") for i in range(1, 6)],
            "customer_id int, name string, city string, state string"),
        "sellers": spark.createDataFrame(
            [(1, "Ana", None), (2, "Ana", None), (3, "Bob", day(-1))],
            "seller_id int, name string, left_on date"),
        "assignments": spark.createDataFrame(
            [(1, 1, 1, day(-50), True, False), (2, 1, 2, day(-10), True, False),
             (3, 2, 1, day(-50), True, False), (4, 3, 3, day(-50), False, True),
             (5, 4, 2, day(-50), True, False), (6, 5, 9, day(-50), True, False)],
            "assignment_id int, customer_id int, seller_id int, started_on date, "
            "current boolean, orphaned boolean"),
        "products": spark.createDataFrame(
            [(s, f"product {s}") for s in "ABCDE"], "sku string, name string"),
        "stock": spark.createDataFrame(
            [("A", day(-3), 0, True), ("A", day(-2), 7, False), ("B", day(-9), 0, True)],
            "sku string, snapshot_on date, balance int, stock_out boolean"),
    }, TODAY)


@pytest.fixture(scope="module")
def features(spark):
    rows = [
        (1, 5.0, 40.0, 60000.0, 200.0, 0.0, 3.5, 11.428), (2, 10.0, 30.0, 1.0, 50.0, 1.0, 2.0, 5.0),
        (3, 1.0, 5.0, 1.0, 5.0, 1.0, None, None), (4, 1.0, 5.0, 90000.0, 5.0, 0.0, 1.0, 5.0),
        (5, 1.0, 5.0, 1.0, 5.0, 0.0, None, None),
    ]
    df = spark.createDataFrame(
        rows, "customer_id int, order_frequency double, recency_days double, total_value double, "
              "avg_ticket double, bought_launch double, relative_delay double, "
              "mean_gap_days double")
    return df.withColumns({c: F.lit(0.0) for c in (
        "margin_share", "distinct_skus", "distinct_brands")})


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(
        [(1, 0.5, "b"), (2, 0.5, "b"), (3, 0.9, "b"), (4, 0.1, "b"), (5, 0.99, "b")],
        "customer_id int, score double, band string")


@pytest.fixture(scope="module")
def calls(spark, ctx, scores, features):
    df = queue.call_queue(ctx, scores, features, 3)
    return ctx.store.scratch(df)


def test_only_current_owners_and_one_row_each(ctx, scores, features):
    got = {r["customer_id"]: r["seller_id"]
           for r in queue.eligible(ctx, scores, features).collect()}
    # 3 is orphaned, 5 belongs to nobody known, 1 has two owners: the later one counts
    assert got == {1: 2, 2: 1, 4: 2}


def test_tie_at_the_cut_goes_to_the_smaller_id(ctx, scores, features):
    top = queue.top_n(queue.eligible(ctx, scores, features), 1).collect()
    assert [r["customer_id"] for r in top] == [1]


def test_sellers_of_one_name_are_numbered_apart(calls):
    assert {(r["customer_id"], r["position"]) for r in calls.collect()} == {(1, 1), (2, 1), (4, 2)}


def test_suggestion_and_brand(ctx):
    offers = {r["customer_id"]: r["suggestion"] for r in queue.suggest_product(
        ctx["fact"], TODAY).collect()}
    # B was bought five days ago; the return of A three days ago does not count
    assert offers == {1: "A", 3: "D"}
    brands = {r["customer_id"]: r["brand"] for r in queue.preferred_brand(ctx["fact"]).collect()}
    assert brands == {1: "X", 2: "Y", 3: "Y"}


def test_reasons(features):
    got = {r["customer_id"]: r["r"] for r in features.select(
        "customer_id", queue.reason().alias("r")).collect()}
    assert got[1] == ("Compra a cada 11 dias e esta ha 40 sem pedido. "
                      "Risco de perder para o concorrente.")
    assert got[2] == "Esta 2.0x mais atrasado que o ritmo dele."
    assert got[3] == "Comprou lancamento recente. Alta chance de repetir."
    assert got[4] == "Cliente grande, R$ 90,000.00 comprados. Manter proximo."
    assert got[5] == "Dentro do ritmo. Contato de manutencao."


def test_queue_checks(calls):
    assert_passed(queue.queue_checks(calls, 3))
    with pytest.raises(ChecksFailed, match="queue_length"):
        assert_passed(queue.queue_checks(calls))


def test_lookups_as_sql_and_dataframe_functions_agree(spark, ctx, calls, scores, features):
    fn.register_sql_functions(
        spark, ctx, {"queue": calls, "scores": scores, "features": features})

    def same(df, query):
        rows = sorted(map(str, df.collect()))
        assert rows and rows == sorted(map(str, spark.sql(query).collect()))

    same(fn.prioritize(calls, "Ana", 1), "SELECT * FROM prioritize('Ana', 1)")
    same(fn.customer_context(ctx, scores, features, 2), "SELECT * FROM customer_context(2)")
    same(fn.products_to_reorder(ctx, 1).drop("customer_id"),
         "SELECT * FROM products_to_reorder(1)")
    same(fn.availability(ctx, "A"), "SELECT * FROM availability('A')")
    lateral = spark.sql(
        "SELECT s.sku, a.balance FROM (SELECT DISTINCT sku FROM fn_stock) s, "
        "LATERAL availability(s.sku) a").collect()
    assert {tuple(r) for r in lateral} == {("A", 7), ("B", 0)}


def test_reorder_for_everybody(ctx):
    got = {(r["customer_id"], r["sku"]): r["times_bought"]
           for r in fn.products_to_reorder(ctx).collect()}
    assert got == {(1, "A"): 2, (1, "C"): 1, (3, "D"): 1, (3, "E"): 1}


CALLS = (
    "event_id int, customer_id string, seller string, status string, comment string, "
    "recorded_at timestamp, reference string"
)


def at(hour):
    return dt.datetime(2024, 6, 1, hour)


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame([
        (1, "1", "Ana", "vendeu", None, at(1), None),
        (2, " 2 ", "Ana", "vai_pensar", "it's fine", at(2), "2024-05-01"),
        (3, "1", "Eva", "nao_atendeu", "", at(3), None),
        (4, "x", "Ana", "vendeu", "", at(4), None),
        (5, "3", "Ana", "maybe", "y" * 501, at(5), None),
        (6, "4", None, "vendeu", "y" * 500, at(6), None),
    ], CALLS)


def test_validation(batch):
    good, bad = feedback.validate_feedback(batch, TODAY)
    rows = {r["event_id"]: r for r in good.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1]["comment"] == "" and rows[1]["reference"] == TODAY
    assert rows[2]["customer_id"] == 2 and rows[2]["reference"] == dt.date(2024, 5, 1)
    assert {r["event_id"]: r["_violations"] for r in bad.collect()} == {
        4: ["customer_numeric"], 5: ["status_known", "comment_length"], 6: ["seller_present"]}


def test_upsert_is_idempotent_and_keeps_the_seller(batch):
    good, _ = feedback.validate_feedback(batch, TODAY)
    target = feedback.latest_feedback(good.where("event_id < 3"))
    once = feedback.apply_feedback(target, good, ("event_id",))
    rows = {r["customer_id"]: r for r in once.collect()}
    assert rows[1]["status"] == "nao_atendeu" and rows[1]["seller"] == "Ana"
    assert rows[1]["recorded_by"] == "Eva"
    twice = feedback.apply_feedback(once, good, ("event_id",))
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_followup_and_kpis(spark, calls, batch):
    good, _ = feedback.validate_feedback(batch, TODAY)
    joined = {r["customer_id"]: r["feedback_status"]
              for r in feedback.queue_with_feedback(calls, good).collect()}
    assert joined == {1: "nao_atendeu", 2: "vai_pensar", 4: None}
    assert feedback.queue_with_feedback(calls, good, "Bob").count() == 0
    per_seller = feedback.followup(calls, good)
    totals = feedback.followup_totals(per_seller).first()
    assert (totals["in_queue"], totals["worked"], totals["nao_atendeu"]) == (3, 2, 1)
    metrics = spark.createDataFrame(
        [(1, 2.0, 10, 0.1, at(1)), (2, 4.25, 90, 0.1012, at(2))],
        "version int, lift_top_k double, hits_top_k int, base_rate double, trained_at timestamp")
    kpis = feedback.week_kpis(calls, good, metrics).first()
    assert (kpis["contacts"], kpis["sellers"], kpis["worked"], kpis["sold"]) == (3, 1, 3, 1)
    assert kpis["expected_revenue"] == pytest.approx(0.5 * 200 + 0.5 * 50 + 0.1 * 5)
    assert (kpis["lift_top_k"], kpis["base_rate_pct"]) == (4.25, 10.12)
    assert feedback.week_kpis(calls, good, metrics, "Eva").first()["worked"] == 1
    assert feedback.week_kpis(calls, good, metrics, "Eva", False).first()["worked"] == 3
    untrained = feedback.week_kpis(calls, good, metrics.where("false")).first()
    assert untrained["contacts"] == 3 and untrained["lift_top_k"] is None
