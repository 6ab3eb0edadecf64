"""The weekly call queue: whom to call, why, and what to offer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.functions import columns as C
from salesloom.operators.contracts import TableCheck, check_table
from salesloom.operators.rank import top_per_key
from salesloom.plans.features import before
from salesloom.plans.marts import sold

QUEUE_SIZE = 200  # fixed value: calls a week
RECENT_DAYS = 90
# fixed values: wording of the reasons (numbers go between the parts) and their thresholds
REASON_AT_RISK = (
    "Compra a cada ", " dias e esta ha ", " sem pedido. Risco de perder para o concorrente.")
REASON_DELAYED = ("Esta ", "x mais atrasado que o ritmo dele.")
REASON_LAUNCH = "Comprou lancamento recente. Alta chance de repetir."
REASON_LARGE = ("Cliente grande, R$ ", " comprados. Manter proximo.")
REASON_STEADY = "Dentro do ritmo. Contato de manutencao."
AT_RISK_DELAY = 3
LATE_DELAY = 1.5
LARGE_VALUE = 50000

QUEUE_COLUMNS = (
    "seller", "position", "customer_id", "name", "city", "state", "score", "band", "avg_ticket",
    "reason", "suggestion",
)


def current_assignment(assignments: DataFrame) -> DataFrame:
    """One current assignment per customer, the one that started last."""
    return top_per_key(
        assignments.where(F.col("current") & ~F.col("orphaned")), ["customer_id"],
        [F.col("started_on").desc_nulls_last(), F.col("assignment_id").desc()],
    )


def eligible(ctx: Ctx, scores: DataFrame, features: DataFrame) -> DataFrame:
    """Scored customers that somebody who still works here looks after."""
    owners = current_assignment(ctx["assignments"]).select("customer_id", "seller_id")
    active = ctx["sellers"].where(F.col("left_on").isNull()).select(
        "seller_id", F.col("name").alias("seller")
    )
    known = ctx["customers"].select("customer_id")
    facts = features.select(
        "customer_id", "avg_ticket", "total_value", "relative_delay", "bought_launch",
        "recency_days", "mean_gap_days",
    )
    return (
        scores.select("customer_id", "score", "band").join(facts, "customer_id")
        .join(known, "customer_id", "left_semi").join(owners, "customer_id")
        .join(active, "seller_id")
    )


def top_n(candidates: DataFrame, n: int = QUEUE_SIZE) -> DataFrame:
    """The ``n`` best scores overall, then numbered within their seller.

    The cut is an ordered limit (every task keeps n rows); the numbering window
    then sees n rows.  Sellers are told apart by id, names repeat.
    """
    best = candidates.orderBy(F.col("score").desc_nulls_last(), "customer_id").limit(n)
    w = Window.partitionBy("seller_id").orderBy(F.col("score").desc_nulls_last(), "customer_id")
    return best.withColumn("position", F.row_number().over(w))


def preferred_brand(fact: DataFrame) -> DataFrame:
    """The brand each customer spent most on, returns left out."""
    spent = sold(fact).groupBy("customer_id", "brand").agg(F.sum("revenue").alias("brand_revenue"))
    return top_per_key(
        spent, ["customer_id"], [F.col("brand_revenue").desc(), F.col("brand").asc_nulls_last()]
    )


def suggest_product(fact: DataFrame, as_of: dt.date, days: int = RECENT_DAYS) -> DataFrame:
    """Per customer the SKU of the preferred brand bought most, but not lately.

    Whether a SKU was bought lately is its last sale date, so one aggregate
    replaces the anti join of the sales with themselves.
    """
    sales = before(sold(fact), "order_date", as_of)
    by_sku = sales.groupBy("customer_id", "brand", "sku").agg(
        F.count(F.lit(1)).alias("times_bought"), F.max("order_date").alias("last_bought"),
        F.sum("revenue").alias("spent"),
    )
    # the brand's revenue is the sum over its SKUs: one scan, and rows per SKU from here on
    spent = F.sum("spent").over(Window.partitionBy("customer_id", "brand"))
    best = Window.partitionBy("customer_id").orderBy(
        F.col("brand_spent").desc(), F.col("brand").asc_nulls_last())
    liked = by_sku.withColumn("brand_spent", spent).withColumn("liked", F.rank().over(best)).where(
        (F.col("liked") == 1) & F.col("brand").isNotNull())
    rested = liked.where(F.col("last_bought") < F.date_sub(F.lit(as_of), days))
    return top_per_key(
        rested, ["customer_id"], [F.col("times_bought").desc(), F.col("sku").asc()],
    ).select("customer_id", F.col("sku").alias("suggestion"), "times_bought")


def _sentence(parts: tuple[str, ...], *numbers: Column) -> Column:
    """Fixed parts with formatted numbers between them."""
    pieces = [F.lit(parts[0])]
    for number, part in zip(numbers, parts[1:]):
        pieces += [number, F.lit(part)]
    return F.concat(*pieces)


def reason() -> Column:
    """One sentence per customer; the first case that holds, the rarest first."""
    delay = F.col("relative_delay")
    whole = "%.0f"
    cases = [
        (delay > AT_RISK_DELAY, _sentence(
            REASON_AT_RISK, F.format_string(whole, F.round("mean_gap_days", 0)),
            F.format_string(whole, "recency_days"))),
        (delay > LATE_DELAY, _sentence(REASON_DELAYED, F.format_string("%.1f", delay))),
        (F.col("bought_launch") == 1, F.lit(REASON_LAUNCH)),
        (F.col("total_value") > LARGE_VALUE, _sentence(
            REASON_LARGE, F.format_number("total_value", 2))),
    ]
    return F.coalesce(*[F.when(holds, text) for holds, text in cases], F.lit(REASON_STEADY))


def call_queue(
    ctx: Ctx, scores: DataFrame, features: DataFrame, n: int = QUEUE_SIZE
) -> DataFrame:
    """The queue with reason and suggestion.

    The queue is cut first; names and the sales suggestions are made from are
    then looked up for its customers only.  The queue is stored, so the optimizer
    knows its size and chooses the joins.
    """
    queue = ctx.store.scratch(top_n(eligible(ctx, scores, features), n))
    called = queue.select("customer_id")
    who = ctx["customers"].join(called, "customer_id", "left_semi").select(
        "customer_id", "name", C.default("city", C.MISSING_CITY).alias("city"),
        C.default("state", C.MISSING_STATE).alias("state"),
    )
    offers = suggest_product(
        ctx["fact"].join(called, "customer_id", "left_semi"), ctx.as_of
    ).select("customer_id", "suggestion")
    return queue.join(who, "customer_id").join(offers, "customer_id", "left").select(
        "seller", "position", "customer_id", "name", "city", "state",
        F.round("score", 4).alias("score"), "band", F.round("avg_ticket", 2).alias("avg_ticket"),
        reason().alias("reason"), "suggestion",
    )


def queue_checks(queue: DataFrame, n: int = QUEUE_SIZE) -> DataFrame:
    """Exactly ``n`` rows, every reason filled, every score a probability."""
    blank = F.col("reason").isNull() | (F.trim("reason") == "")
    return check_table(queue, [
        TableCheck("queue_length", F.count(F.lit(1)), n, n),
        TableCheck("queue_reason_filled", F.count_if(blank), 0, 0),
        TableCheck("queue_score_range", F.count_if(~F.col("score").between(0, 1)), 0, 0),
    ])
