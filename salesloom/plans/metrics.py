"""Six business metric views.  Each answers one question, ordered as it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.functions import columns as C
from salesloom.plans.marts import order_summary, sold

# fixed values: texts shown by the views
PEAK_LABEL = "Mes pico do setor"
PHASE_EARLY = "120 dias apos lancamento"
PHASE_LATE = "Apos 120 dias"
PHASE_BEFORE = "Antes do lancamento"


def monthly_revenue(ctx: Ctx) -> DataFrame:
    """Revenue, margin, orders per month; labels the month with the most revenue.

    ``avg_item_value`` averages over lines, ``avg_ticket`` over orders.
    """
    months = order_summary(sold(ctx["fact"]), ["year", "month"]).select(
        "year", "month", C.year_month("year", "month").alias("year_month"), "orders", "customers",
        F.round("revenue", 2).alias("revenue"), F.round("margin", 2).alias("margin"),
        C.safe_ratio("revenue", "lines", 1, 2).alias("avg_item_value"),
        C.safe_ratio("revenue", "orders", 1, 2).alias("avg_ticket"),
    )
    # a window over everything sees one row per month of the calendar, and the
    # sales are read once
    best = F.max("revenue").over(Window.partitionBy())
    return months.select(
        *months.columns, C.safe_ratio("margin", "revenue", 100, 1).alias("margin_pct"),
        F.when(F.col("revenue") == best, PEAK_LABEL).otherwise("").alias("peak_label"),
    ).orderBy(F.desc("year"), F.desc("month"))


def brand_ranking(ctx: Ctx) -> DataFrame:
    """Revenue, margin and share of the total per brand.

    The total is a window sum over the rows of the brands: the sales are read once.
    """
    total = F.col("_total")
    return order_summary(sold(ctx["fact"]), ["brand"]).withColumn(
        "_total", F.sum("revenue").over(Window.partitionBy())
    ).withColumns({
        "revenue": F.round("revenue", 2), "margin": F.round("margin", 2),
    }).select(
        "brand", "orders", "customers", "revenue", "margin",
        C.safe_ratio("margin", "revenue", 100, 1).alias("margin_pct"),
        C.safe_ratio("revenue", total, 100, 2).alias("share_pct"),
    ).orderBy(F.desc("revenue"), "brand")


def category_margin(ctx: Ctx) -> DataFrame:
    """Orders, SKUs, revenue and margin per category.

    Orders and SKUs are both fine grained; two narrow passes cost less than the
    expanded rows of two distinct counts in one aggregate.
    """
    sales = sold(ctx["fact"])
    orders = order_summary(sales, ["category"])
    skus = sales.select("category", "sku").distinct().groupBy(
        F.col("category").alias("_category")
    ).agg(F.count(F.lit(1)).alias("skus"))
    return orders.join(skus, F.col("category").eqNullSafe(F.col("_category"))).withColumns({
        "revenue": F.round("revenue", 2), "margin": F.round("margin", 2),
    }).select(
        "category", "orders", "skus", "revenue", "margin",
        C.safe_ratio("margin", "revenue", 100, 1).alias("margin_pct"),
    ).orderBy(F.desc("margin"), "category")


def customers_at_risk(ctx: Ctx, days: int = 90) -> DataFrame:
    """Customers without a purchase for more than ``days`` and what they used to buy.

    Attributes are joined after the filter, to the customers that pass it.
    """
    today = F.lit(ctx.as_of)
    buying = sold(ctx["fact"]).groupBy("customer_id").agg(
        F.max("order_date").alias("last_purchase"), F.min("order_date").alias("_first"),
        F.countDistinct("order_id").alias("orders"), F.sum("revenue").alias("_revenue"),
    )
    quiet = buying.withColumn("days_quiet", F.datediff(today, "last_purchase")).where(
        F.col("days_quiet") > days
    )
    who = ctx["customers"].select(
        "customer_id", "name", C.default("city", C.MISSING_CITY).alias("city"),
        C.default("state", C.MISSING_STATE).alias("state"),
        C.default("segment", C.MISSING_SEGMENT).alias("segment"),
    )
    days_known = F.datediff(today, "_first")
    return quiet.join(who, "customer_id").select(
        "customer_id", "name", "city", "state", "segment", "last_purchase", "days_quiet", "orders",
        F.round("_revenue", 2).alias("revenue"),
        C.safe_ratio("_revenue", "orders", 1, 2).alias("avg_ticket"),
        C.safe_ratio("_revenue", days_known, 30, 2).alias("est_monthly_avg"),
    ).orderBy(F.desc("days_quiet"), "customer_id")


def launch_effect(ctx: Ctx, days: int = 120) -> DataFrame:
    """Sales per SKU and day since its launch, with the phase of the launch.

    The fact carries the launch date; product names join the aggregate.
    """
    names = ctx["products"].select("sku", F.col("name").alias("product_name"))
    since = F.datediff("order_date", "launch_date")
    phase = (
        F.when(F.col("days_since_launch") < 0, PHASE_BEFORE)
        .when(F.col("days_since_launch") <= days, PHASE_EARLY).otherwise(PHASE_LATE)
    )
    return (
        sold(ctx["fact"]).where(F.col("launch_date").isNotNull())
        .groupBy("sku", "brand", "category", "launch_date", since.alias("days_since_launch"))
        .agg(F.countDistinct("order_id").alias("orders"),
             F.round(F.sum("revenue"), 2).alias("revenue"),
             F.round(F.sum("margin"), 2).alias("margin"))
        .withColumn("phase", phase).join(names, "sku")
        .orderBy("sku", "days_since_launch")
    )


def stockout_by_brand(ctx: Ctx) -> DataFrame:
    """Share of SKUs without stock per brand on the newest snapshot day.

    The newest day is compared as a date; as text, 31/01/2024 would beat
    2024-02-01.
    """
    stock = ctx["stock"]
    latest = stock.where(F.col("snapshot_on") == stock.agg(F.max("snapshot_on")).scalar())
    brands = ctx["products"].select("sku", "brand")
    return (
        latest.select("sku", "stock_out").join(brands, "sku", "left")
        .groupBy(C.default("brand", C.MISSING_BRAND).alias("brand"))
        .agg(F.count(F.lit(1)).alias("sku_count"), F.count_if("stock_out").alias("stocked_out"))
        .withColumn("stockout_pct", C.safe_ratio("stocked_out", "sku_count", 100, 1))
        .orderBy(F.desc("stockout_pct"), "brand")
    )
