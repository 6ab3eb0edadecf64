"""Conformed dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.functions import columns as C

FACT_PARTITIONS = ("year", "month")
PEAK_MONTHS = (4, 6, 10)  # fixed value: months of the sector's peak


def dim_customer(ctx: Ctx, exclude_cancelled: bool = False) -> DataFrame:
    """Customers with order history; missing attributes get their defaults.

    All orders count, cancelled ones with a value of zero, unless
    ``exclude_cancelled``.  Orders are aggregated before the join, so a hot
    customer reaches it as one row.
    """
    orders = ctx["orders"]
    if exclude_cancelled:
        orders = orders.where(~F.col("cancelled"))
    stats = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"), F.sum("net_value").alias("net_revenue"),
    )
    return ctx["customers"].join(stats, "customer_id", "left").select(
        "customer_id", "name", "tax_id",
        C.default("segment", C.MISSING_SEGMENT).alias("segment"),
        C.default("city", C.MISSING_CITY).alias("city"),
        C.default("state", C.MISSING_STATE).alias("state"),
        C.default("district", C.MISSING_DISTRICT).alias("district"),
        "registered_on", "first_order", "last_order",
        C.default("order_count", 0).cast("bigint").alias("order_count"),
        C.default("net_revenue", 0).cast("decimal(28,2)").alias("net_revenue"),
        F.datediff(F.lit(ctx.as_of), F.col("last_order")).alias("days_since_order"),
        F.col("active").alias("customer_active"),
    )


def dim_product(ctx: Ctx) -> DataFrame:
    """Catalogue with a flag for SKUs that were sold while discontinued.

    A line is discontinued when its product is inactive, so it is enough to know
    which SKUs were sold; the lines are reduced to distinct SKUs on the map side.
    """
    sold = ctx["items"].select("sku").distinct().withColumn("_sold", F.lit(True))
    return ctx["products"].join(sold, "sku", "left").select(
        "sku", "name", "brand", "category", "scent_note", "unit", "unit_cost", "list_price",
        "launch_date", (~F.col("active") & C.default("_sold", False)).alias("discontinued"),
        F.col("active").alias("catalogue_active"),
    )


def dim_seller(ctx: Ctx) -> DataFrame:
    return ctx["sellers"].select(
        "seller_id", "name", "region", "state", "hired_on", "left_on",
        F.col("left_on").isNull().alias("active"), "monthly_target",
    )


def dim_calendar(
    ctx: Ctx, extra_days: int = 60, peak_months: Sequence[int] = PEAK_MONTHS
) -> DataFrame:
    """Days from the first order month to ``extra_days`` after the last one began."""
    bounds = ctx["orders"].agg(
        F.trunc(F.min("order_date"), "month").alias("_from"),
        F.date_add(F.trunc(F.max("order_date"), "month"), extra_days).alias("_to"),
    )
    days = bounds.select(F.explode(F.sequence("_from", "_to")).alias("day"))
    return days.select(
        "day", F.year("day").alias("year"), F.month("day").alias("month"),
        F.date_format("day", "MMMM").alias("month_name"),
        C.year_month(F.year("day"), F.month("day")).alias("year_month"),
        F.quarter("day").alias("quarter"), F.dayofweek("day").alias("weekday"),
        F.date_format("day", "EEEE").alias("weekday_name"),
        F.month("day").isin(*peak_months).alias("sector_peak"),
    )


def sales_fact(ctx: Ctx, remap_customers: bool = False) -> DataFrame:
    """One row per order line of orders that were not cancelled.

    Returns stay in with a negative quantity, hence negative revenue and cost.
    Lines of customers that lost the deduplication drop out unless
    ``remap_customers`` moves them to the surviving id.  The launch date of the
    product comes along, so that no reader joins the lines to the catalogue again.

    Customers join the orders before the lines do: that way the lines, by far
    the largest input, are shuffled once by order and once by SKU only.  No
    side is hinted; Catalyst broadcasts what it measures to be small and AQE
    splits partitions of hot orders, customers or SKUs.
    """
    orders = ctx["orders"].where(~F.col("cancelled")).drop("net_value", "total_value", "status")
    if remap_customers:
        remap = ctx["customer_map"].select(F.col("id").alias("customer_id"), "canonical_id")
        orders = orders.join(remap, "customer_id").withColumn(
            "customer_id", F.col("canonical_id")
        ).drop("canonical_id")
    buyers = ctx["customers"].select(
        "customer_id", F.col("name").alias("customer_name"), "segment", "city", "state"
    )
    headers = orders.join(buyers, "customer_id")
    products = ctx["products"].select(
        "sku", "category", "brand", "scent_note", "launch_date", "unit_cost"
    )
    lines = ctx["items"]
    if "seller_id" in lines.columns:  # sources that record the seller per line
        headers = headers.drop("seller_id")
    cost = (F.col("quantity") * F.abs("unit_cost")).cast("decimal(18,2)")
    return lines.join(headers, "order_id").join(products, "sku").select(
        "order_date", "year", "month", "channel", "order_id", "seller_id", "customer_id",
        "customer_name",
        C.default("segment", C.MISSING_SEGMENT).alias("segment"),
        C.default("city", C.MISSING_CITY).alias("city"),
        C.default("state", C.MISSING_STATE).alias("state"),
        "sku", "category", "brand", "scent_note", "launch_date", "quantity", "unit_price",
        "revenue",
        cost.alias("cost"), (F.col("revenue") - cost).cast("decimal(18,4)").alias("margin"),
        "is_return",
    )


def control_totals(fact: DataFrame) -> DataFrame:
    """Row count, net and gross revenue, returns and margin of the fact, one row."""
    sold = ~F.col("is_return")
    sums = fact.agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("revenue").alias("net"),
        F.sum(F.when(sold, F.col("revenue"))).alias("gross"),
        F.sum(F.when(F.col("is_return"), F.col("revenue"))).alias("returned"),
        F.sum("margin").alias("m"),
    )
    return sums.select(
        "row_count", C.money("net").alias("net_revenue"), C.money("gross").alias("gross_sold"),
        C.money("returned").alias("returns"), C.money("m").alias("margin"),
        C.safe_ratio("m", "net", 100, 1).alias("margin_pct"),
    )
