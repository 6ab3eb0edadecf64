"""Aggregates behind the commercial dashboard and the curated answers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.functions import columns as C
from salesloom.plans.feedback import SOLD
from salesloom.plans.marts import sold
from salesloom.plans.metrics import brand_ranking, customers_at_risk, stockout_by_brand

FILTERS = ("year", "segment", "city", "seller_id")


def dashboard_base(ctx: Ctx, filters: Mapping[str, object] | None = None) -> DataFrame:
    """Sales without returns under the optional dashboard filters.

    Amounts stay exact decimals until a result is handed out.
    """
    unknown = set(filters or {}) - set(FILTERS)
    if unknown:
        raise ValueError(f"no such filter: {sorted(unknown)}")
    sales = C.optional_filter(sold(ctx["fact"]), filters or {})
    return sales.withColumn("month_date", C.month_start("year", "month"))


def counters(base: DataFrame) -> DataFrame:
    """Revenue, margin, orders and revenue per order, one row."""
    return base.agg(
        F.sum("revenue").alias("_revenue"), F.sum("margin").alias("_margin"),
        F.countDistinct("order_id").alias("orders"),
    ).select(
        C.money("_revenue").alias("revenue"), C.money("_margin").alias("margin"), "orders",
        C.safe_ratio("_revenue", "orders", 1, 2).alias("avg_ticket"),
    )


def by_month(base: DataFrame) -> DataFrame:
    return base.groupBy("month_date").agg(C.money(F.sum("revenue")).alias("revenue")).orderBy(
        "month_date"
    )


def by_channel(base: DataFrame) -> DataFrame:
    return base.groupBy("channel").agg(C.money(F.sum("revenue")).alias("revenue")).orderBy(
        F.desc("revenue"), "channel"
    )


def margin_by_category(base: DataFrame) -> DataFrame:
    return base.groupBy("category").agg(
        F.sum("revenue").alias("_revenue"), F.sum("margin").alias("_margin")
    ).select(
        "category", C.safe_ratio("_margin", "_revenue", 100, 1).alias("margin_pct")
    ).orderBy(F.desc("margin_pct"), "category")


def top_brands(base: DataFrame, n: int = 10) -> DataFrame:
    return base.groupBy("brand").agg(C.money(F.sum("revenue")).alias("revenue")).orderBy(
        F.desc("revenue"), "brand"
    ).limit(n)


def top_customers(base: DataFrame, n: int = 20) -> DataFrame:
    """The customers with most revenue; two customers of one name stay apart."""
    return base.groupBy("customer_id", "customer_name").agg(
        C.money(F.sum("revenue")).alias("revenue")
    ).orderBy(F.desc("revenue"), "customer_id").limit(n)


def curated_answers(
    ctx: Ctx, queue: DataFrame, feedback: DataFrame, metrics: DataFrame
) -> dict[str, Callable[[], DataFrame]]:
    """Named questions with a fixed query each; built when asked."""
    def call_list() -> DataFrame:
        return queue.orderBy(F.desc("score"), "customer_id").limit(20).select(
            "seller", "position", "name", F.round("score", 2).alias("rating"), "reason",
            "suggestion",
        )

    def at_risk(n: int) -> DataFrame:
        return customers_at_risk(ctx).limit(n).select(
            "name", "city", "state", "days_quiet", "avg_ticket"
        )

    return {
        "who_to_call": call_list,
        "queue_value": lambda: queue.agg(
            F.round(F.sum(F.col("score") * F.col("avg_ticket")), 2).alias("expected_revenue")
        ),
        "brand_share": lambda: brand_ranking(ctx).select("brand", "revenue", "share_pct"),
        "not_buying": lambda: at_risk(20),
        "stockouts": lambda: stockout_by_brand(ctx),
        "calls_and_sales": lambda: feedback.agg(
            F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status") == SOLD).alias("sold")
        ),
        "model_quality": lambda: metrics.orderBy(F.desc("trained_at"), F.desc("version")).limit(1)
        .select("lift_top_k", "hits_top_k",
                F.round(F.col("base_rate") * 100, 2).alias("base_rate_pct")),
        "risk_of_loss": lambda: at_risk(10).drop("state"),
    }
