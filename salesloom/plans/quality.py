"""Data-quality checks over the finished tables.

Every check is a row (check, observed, low, high, passed); checks that look at
one table share a scan, and only ``assert_passed`` brings the few rows home.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.functions.columns import TAX_ID_WIDTH
from salesloom.operators.contracts import TableCheck, check_table, judge
from salesloom.plans.marts import product_month

# fixed values: accepted rows of the fact and tolerance of money comparisons
FACT_ROWS = (140_000, 250_000)
TOLERANCE = 0.01


def _row(name: str, observed: DataFrame, low: float, high: float) -> DataFrame:
    """``observed`` has one row and one column."""
    column = observed.columns[0]
    return judge(observed.select(
        F.lit(name).alias("check"), F.col(column).cast("double").alias("observed"),
        F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"),
    ))


def _difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """|left - right| of two one-row tables."""
    return left.select(F.abs(F.col(left.columns[0]) - right.scalar()).alias("difference"))


def _sum(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.round(F.coalesce(F.sum(c), F.lit(0)), 2).alias("total"))


def reconcile(ctx: Ctx) -> DataFrame:
    """Fact revenue against net value of the orders whose customer survived."""
    valid = ctx["orders"].where(~F.col("cancelled")).join(
        ctx["customers"].select("customer_id"), "customer_id", "left_semi"
    )
    return _row(
        "revenue_reconciles", _difference(_sum(ctx["fact"], "revenue"), _sum(valid, "net_value")),
        0, TOLERANCE,
    )


def unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows beyond the distinct values of ``key``; NULL keys count as repeats."""
    repeats = df.agg((F.count(F.lit(1)) - F.countDistinct(key)).alias("repeats"))
    return _row(name, repeats, 0, 0)


def complete(ctx: Ctx) -> DataFrame:
    return check_table(ctx["orders"], [
        TableCheck("order_date_complete", F.count_if(F.col("order_date").isNull()), 0, 0)
    ])


def fact_checks(ctx: Ctx, rows: tuple[float, float] = FACT_ROWS) -> DataFrame:
    """Sign of revenue against the return flag, and the size of the fact; one scan."""
    stray = (F.col("revenue") < 0) & ~F.col("is_return")
    return check_table(ctx["fact"], [
        TableCheck("negative_only_on_returns", F.count_if(stray), 0, 0),
        TableCheck("fact_volume", F.count(F.lit(1)), *rows),
    ])


def orphans(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct keys of ``child`` that ``parent`` lacks.

    Keys are made distinct before the join, so a hot key is one row.
    """
    missing = child.select(key).distinct().join(parent.select(key), key, "left_anti")
    return _row(name, missing.agg(F.count(F.lit(1)).alias("orphans")), 0, 0)


def mart_conforms(ctx: Ctx, mart: DataFrame | None = None) -> DataFrame:
    """The saved product mart adds up to the fact."""
    if mart is None:
        mart = ctx.store.table("mart_product_month", lambda: product_month(ctx))
    return _row(
        "mart_conforms",
        _difference(_sum(ctx["fact"], "revenue"), _sum(mart, "revenue")),
        0, TOLERANCE,
    )


def tax_ids(ctx: Ctx) -> DataFrame:
    wrong = F.length("tax_id") != TAX_ID_WIDTH
    return check_table(ctx["customers"], [TableCheck("tax_id_length", F.count_if(wrong), 0, 0)])


def all_checks(
    ctx: Ctx, fact_rows: tuple[float, float] = FACT_ROWS, mart: DataFrame | None = None,
) -> DataFrame:
    """The nine checks as one result.

    The fact is read twice: for one row of sums that four checks share, and for its keys,
    one pair an order, in which both orphan checks look.
    """
    fact = ctx["fact"]
    if mart is None:
        mart = ctx.store.table("mart_product_month", lambda: product_month(ctx))
    stray = (F.col("revenue") < 0) & ~F.col("is_return")
    sums = ctx.store.scratch(fact.agg(
        F.round(F.coalesce(F.sum("revenue"), F.lit(0)), 2).alias("revenue"),
        F.count_if(stray).alias("stray"), F.count(F.lit(1)).alias("volume")))
    keys = ctx.store.scratch(fact.select("order_id", "customer_id").distinct())
    valid_orders = ctx["orders"].where(~F.col("cancelled")).join(
        ctx["customers"].select("customer_id"), "customer_id", "left_semi")
    valid = ctx["customers"].where(F.col("tax_id_valid"))
    revenue = sums.select("revenue")
    return reduce(DataFrame.unionByName, [
        _row("revenue_reconciles", _difference(revenue, _sum(valid_orders, "net_value")), 0, TOLERANCE),
        unique(valid, "tax_id", "tax_id_unique"), complete(ctx),
        check_table(sums, [TableCheck("negative_only_on_returns", F.max("stray"), 0, 0),
                           TableCheck("fact_volume", F.max("volume"), *fact_rows)]),
        orphans(keys, ctx["orders"], "order_id", "order_orphans"),
        orphans(keys, ctx["customers"], "customer_id", "customer_orphans"),
        _row("mart_conforms", _difference(revenue, _sum(mart, "revenue")), 0, TOLERANCE), tax_ids(ctx),
    ])


def stage_counts(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Row count of a stage and how often each flag holds, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count_if(c).alias(n) for n, c in flags.items()]
    )
