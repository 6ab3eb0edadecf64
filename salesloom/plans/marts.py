"""Seller, product and receivables marts.

Distinct orders are counted by grouping to order grain first: the large shuffle
is then keyed by order, no month or seller is hot, and several counts do not
multiply the rows as several COUNT(DISTINCT …) in one aggregate would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.functions import columns as C
from salesloom.operators.prefix import abc_classes, dense_rank_by


def order_grain(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per (by, order) with its customer and sums."""
    return fact.groupBy(*by, "order_id", "customer_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"),
        F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"),
    )


def sold(fact: DataFrame) -> DataFrame:
    """Sales without returns."""
    return fact.where(~F.col("is_return"))


def order_summary(fact: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct orders and customers, lines, quantity, revenue and margin per ``by``."""
    return order_grain(fact, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("customer_id").alias("customers"),
        F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"),
        F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"),
    )


def seller_month(ctx: Ctx) -> DataFrame:
    """Seller performance per month against the monthly target, returns left out."""
    per_month = order_summary(sold(ctx["fact"]), ["seller_id", "year", "month"])
    sellers = ctx["sellers"].select(
        "seller_id", F.col("name").alias("seller_name"), "region", "state",
        F.col("left_on").isNull().alias("seller_active"), "monthly_target",
    )
    has_target = F.col("monthly_target") > 0
    return per_month.join(sellers, "seller_id", "left").select(
        "seller_id", "seller_name", "region", "state", "seller_active", "year", "month",
        "orders", "customers", F.col("quantity").alias("items"), "revenue", "margin",
        C.safe_ratio("margin", "revenue", 100, 1).alias("margin_pct"),
        F.coalesce(C.safe_ratio("revenue", "orders", 1, 2), F.lit(0.0)).alias("avg_ticket"),
        "monthly_target",
        F.when(has_target, C.safe_ratio("revenue", "monthly_target", 100, 1))
        .alias("target_pct"),
    )


PRODUCT_MONTH_KEY = ("sku", "brand", "category", "year", "month")


def product_month_base(ctx: Ctx) -> DataFrame:
    """Sums per SKU and month, returns included; read several times, so stored."""
    return ctx.store.table("product_month_base", lambda: ctx["fact"].groupBy(
        *PRODUCT_MONTH_KEY
    ).agg(
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"),
        F.sum("margin").alias("margin"),
    ))


def product_abc(ctx: Ctx, cuts: Sequence[float] = (0.80, 0.95), **how) -> DataFrame:
    """ABC class per SKU by revenue over the whole history."""
    return abc_classes(
        ctx.store, product_month_base(ctx), "sku", F.sum("revenue"), cuts, **how
    )


def product_month(ctx: Ctx, **how) -> DataFrame:
    """Product performance per month with ABC class and rank in the month."""
    base = product_month_base(ctx)
    ranked = dense_rank_by(ctx.store, base, ["year", "month"], "revenue", "month_rank", **how)
    classes = product_abc(ctx, **how).select("sku", "abc_class")
    names = ctx["products"].select("sku", F.col("name").alias("product_name"))
    return ranked.join(classes, "sku", "left").join(names, "sku", "left").select(
        "sku", "product_name", "brand", "category", "year", "month", "quantity", "revenue",
        "margin", C.safe_ratio("margin", "revenue", 100, 1).alias("margin_pct"),
        "abc_class", "month_rank",
    )


def receivables(ctx: Ctx) -> DataFrame:
    """Receivable, received and open amounts per due month and payment method.

    ``open_amount`` is gross minus net, so it contains the fees of paid rows;
    ``fee_open`` says how much of it that is.
    """
    paid = F.col("status") == C.PAID_STATUS
    delay = F.datediff("paid_on", "due_on")
    sums = (
        ctx["payments"]
        .groupBy(F.year("due_on").alias("year"), F.month("due_on").alias("month"), "method")
        .agg(
            F.sum("amount").alias("receivable"),
            F.sum(F.when(paid, F.col("net_amount")).otherwise(F.lit(0))).alias("received"),
            F.sum(F.when(paid, F.col("net_amount") * F.col("fee_pct")).otherwise(F.lit(0)))
            .alias("fee_hundredfold"),
            F.sum(F.when(paid, F.col("amount") - F.col("net_amount")).otherwise(F.lit(0)))
            .alias("fee_open"),
            F.avg(F.when(paid, delay)).alias("mean_delay_days"),
        )
    )
    return sums.select(
        "year", "month", "method", "receivable", "received",
        (F.col("receivable") - F.col("received")).alias("open_amount"), "fee_open",
        F.when(F.col("receivable") > 0, C.safe_ratio("received", "receivable", 100, 1))
        .otherwise(F.lit(0.0)).alias("paid_pct"),
        (F.col("fee_hundredfold").cast("double") / 100).alias("fee_cost"),
        F.round("mean_delay_days", 1).alias("mean_delay_days"),
    )
