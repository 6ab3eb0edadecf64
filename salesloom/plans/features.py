"""Point-in-time customer features: nothing dated on or after the cut gets in.

The sales are read once, into states of (customer, day) and (customer, day, SKU) that
are stored; a set of features for any cut date is taken from them, and a new day adds
rows and changes none.  From there groups are bounded (days of the calendar, brands
and categories of the catalogue) before anything is keyed by customer alone, so a
customer with a third of all sales is a few thousand rows by then.  The customer
tables come out hash partitioned by customer and join without another exchange.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.functions import columns as C
from salesloom.operators.rank import gaps

FEATURES = (
    "recency_days", "order_frequency", "total_value", "avg_ticket", "total_margin", "margin_share",
    "mean_gap_days", "gap_stddev_days", "relative_delay", "orders_90d",
    "open_opportunities", "won_opportunities", "win_rate", "visits_90d", "visit_conversion",
    "distinct_skus", "distinct_categories", "distinct_brands", "top_brand_share", "bought_launch",
)


def before(df: DataFrame, date: str, cut: dt.date) -> DataFrame:
    return df.where(F.col(date) < F.lit(cut))


def _period_of(year: Column, month: Column) -> Column:
    return year * 12 + month


def sales_between(ctx: Ctx, start: dt.date | None, end: dt.date) -> DataFrame:
    """Sales in [start, end); also bounds year and month so partitions are pruned."""
    fact = ctx["fact"].where(F.col("order_date") < F.lit(end))
    fact = fact.where(
        (F.col("year") < end.year) | ((F.col("year") == end.year) & (F.col("month") <= end.month))
    )
    if start is not None:
        fact = fact.where(F.col("order_date") >= F.lit(start)).where(
            (F.col("year") > start.year)
            | ((F.col("year") == start.year) & (F.col("month") >= start.month))
        )
    return fact


def day_lines(sales: DataFrame) -> DataFrame:
    """Sums of sales by (customer, day, order) and by (customer, day, SKU), told apart by ``kind``.

    One pass: a line goes to both groups before the map-side sums.
    """
    def of(kind: str, *held: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), *[
            (F.col(c) if c in held else F.lit(None).cast(sales.schema[c].dataType)).alias(c)
            for c in ("order_id", "sku", "brand", "category", "launch_date")])

    both = sales.select("customer_id", "order_date", "revenue", "margin", F.inline(F.array(
        of("order", "order_id"), of("sku", "sku", "brand", "category", "launch_date"))))
    return both.groupBy(
        "kind", "customer_id", "order_date", "order_id", "sku", "brand", "category", "launch_date"
    ).agg(F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"))


def day_base(ctx: Ctx, kind: str) -> DataFrame:
    return ctx.store.table(
        "day_base", lambda: day_lines(ctx["fact"]), partition_by=["kind"]).where(F.col("kind") == kind)


def customer_days(ctx: Ctx) -> DataFrame:
    """customer_id, order_date, orders, revenue, margin and year: the state of every customer and day."""
    return ctx.store.table("customer_days", lambda: day_base(ctx, "order").groupBy(
        "order_date", "customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"),
        F.year(F.first("order_date")).alias("year")), partition_by=["year"])


def buying_rhythm(ctx: Ctx, as_of: dt.date, window_days: int = 90) -> DataFrame:
    """Recency, frequency, value and the gaps between order days per customer."""
    by_day = before(customer_days(ctx).where(F.col("year") <= as_of.year), "order_date", as_of)
    recent = F.col("order_date") >= F.date_sub(F.lit(as_of), window_days)
    per_customer = gaps(by_day, ["customer_id"], "order_date").groupBy("customer_id").agg(
        F.datediff(F.lit(as_of), F.max("order_date")).cast("double").alias("recency_days"),
        F.sum("orders").cast("double").alias("order_frequency"),
        F.sum("revenue").cast("double").alias("total_value"),
        F.sum("margin").cast("double").alias("total_margin"),
        F.avg("gap_days").alias("mean_gap_days"),
        F.stddev_pop("gap_days").alias("gap_stddev_days"),
        F.sum(F.when(recent, F.col("orders")).otherwise(0)).alias("orders_90d"),
    )
    return per_customer.select(
        "*",
        C.safe_ratio("total_value", "order_frequency").alias("avg_ticket"),
        C.safe_ratio("total_margin", "total_value").alias("margin_share"),
    )


def purchase_mix(ctx: Ctx, as_of: dt.date, launch_days: int = 120) -> DataFrame:
    """Distinct SKUs, brands, categories, top-brand revenue and launch purchases."""
    new = (F.col("launch_date") >= F.date_sub(F.lit(as_of), launch_days)) & (
        F.col("launch_date") < F.lit(as_of)
    )
    days = before(day_base(ctx, "sku"), "order_date", as_of)
    by_sku = days.groupBy("customer_id", "sku", "brand", "category").agg(
        F.sum("revenue").alias("revenue"), F.max(new.cast("int")).alias("launch"))
    by_brand = by_sku.groupBy("customer_id", "brand").agg(
        F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("skus"),
        F.max("launch").alias("launch"),
    )
    categories = days.select("customer_id", "category").distinct().groupBy("customer_id").agg(
        F.count("category").alias("distinct_categories"))
    return by_brand.groupBy("customer_id").agg(
        F.sum("skus").alias("distinct_skus"),
        F.count("brand").alias("distinct_brands"),
        F.max("revenue").cast("double").alias("top_brand_revenue"),
        F.coalesce(F.max("launch"), F.lit(0)).alias("bought_launch"),
    ).join(categories, "customer_id")


def crm_activity(ctx: Ctx, as_of: dt.date, stage_as_of: bool = True) -> DataFrame:
    """Open and won opportunities per customer.

    The stage on record may be later than the cut; with ``stage_as_of`` an
    opportunity counts as decided only if it closed before the cut.
    """
    decided = F.col("stage").isin(C.STAGE_WON, C.STAGE_LOST)
    won = F.col("stage") == C.STAGE_WON
    if stage_as_of:
        known = F.coalesce(F.col("closed_on") < F.lit(as_of), F.lit(False))
        decided, won = decided & known, won & known
    return before(ctx["opportunities"], "opened_on", as_of).groupBy("customer_id").agg(
        F.count_if(~decided).alias("open_opportunities"),
        F.count_if(won).alias("won_opportunities"), F.count(F.lit(1)).alias("_opportunities"),
    ).withColumn("win_rate", C.safe_ratio("won_opportunities", "_opportunities"))


def visit_activity(ctx: Ctx, as_of: dt.date, window_days: int = 90) -> DataFrame:
    """Visits of the window and the share of them that spoke of an order."""
    recent = before(ctx["visits"], "visited_on", as_of).where(
        F.col("visited_on") >= F.date_sub(F.lit(as_of), window_days)
    )
    return recent.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("visits_90d"),
        F.count_if(F.lower("outcome").contains(C.ORDER_WORD)).alias("_ordered"),
    ).withColumn("visit_conversion", C.safe_ratio("_ordered", "visits_90d"))


def build_features(
    ctx: Ctx, as_of: dt.date, window_days: int = 90, launch_days: int = 120, cap: float = 10.0,
    stage_as_of: bool = True,
) -> DataFrame:
    """One row per customer with a sale before ``as_of``: 20 numeric features."""
    joined = (
        buying_rhythm(ctx, as_of, window_days)
        .join(purchase_mix(ctx, as_of, launch_days), "customer_id", "left")
        .join(crm_activity(ctx, as_of, stage_as_of), "customer_id", "left")
        .join(visit_activity(ctx, as_of, window_days), "customer_id", "left")
    )
    # least() skips NULLs, so the cap must not see a missing or zero gap
    delay = F.when(
        F.col("mean_gap_days") > 0,
        F.least(F.col("recency_days") / F.col("mean_gap_days"), F.lit(float(cap))),
    )
    derived = {
        "relative_delay": delay,
        "top_brand_share": C.safe_ratio("top_brand_revenue", "total_value"),
        **{c: C.default(c, 0) for c in (
            "open_opportunities", "won_opportunities", "win_rate", "visits_90d",
            "visit_conversion")},
    }
    return joined.select(
        "customer_id",
        *[derived.get(name, F.col(name)).cast("double").alias(name) for name in FEATURES],
        F.lit(as_of).alias("reference"),
    )


def label(ctx: Ctx, as_of: dt.date, horizon: int = 7) -> DataFrame:
    """Customers with a sale in [as_of, as_of + horizon)."""
    end = as_of + dt.timedelta(days=horizon)
    days = before(customer_days(ctx), "order_date", end).where(
        (F.col("order_date") >= F.lit(as_of)) & F.col("year").between(as_of.year, end.year))
    return days.select("customer_id").distinct().withColumn(
        "bought", F.lit(1)
    )


def training_set(ctx: Ctx, as_of: dt.date | None = None, horizon: int = 7, **how) -> DataFrame:
    """Features at the training cut with ``bought`` 0/1 for the days after it."""
    cut = as_of or ctx.train_as_of
    return build_features(ctx, cut, **how).join(
        label(ctx, cut, horizon), "customer_id", "left"
    ).withColumn("bought", C.default("bought", 0))


def scoring_set(ctx: Ctx, as_of: dt.date | None = None, **how) -> DataFrame:
    """The same features at the date of the run, without a label."""
    return build_features(ctx, as_of or ctx.as_of, **how)


def leakage_report(training: DataFrame, scoring: DataFrame) -> DataFrame:
    """Rows, cut, base rate and smallest recency per set; a negative recency is a leak."""
    def row(df: DataFrame, name: str, bought: Column) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("customers"), F.min("reference").alias("cut"),
            F.sum(bought).cast("bigint").alias("buyers"),
            F.round(100 * F.avg(bought.cast("double")), 2).alias("base_rate_pct"),
            F.min("recency_days").alias("min_recency"),
        ).select(F.lit(name).alias("dataset"), "*")

    return row(training, "training", F.col("bought")).unionByName(
        row(scoring, "scoring", F.lit(None).cast("int"))
    )
