"""Parameterised lookups, as DataFrame functions and as SQL table functions.

A parameter left at None stands for "all": the function then answers for every
seller, customer or SKU at once and its work is spread over their keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import Ctx
from salesloom.functions.columns import optional_filter
from salesloom.plans.features import before
from salesloom.plans.marts import sold
from salesloom.plans.queue import QUEUE_COLUMNS, RECENT_DAYS


def prioritize(queue: DataFrame, seller: str | None = None, n: int = 10) -> DataFrame:
    """The first ``n`` rows of a seller's queue."""
    return (
        optional_filter(queue, {"seller": seller}).where(F.col("position") <= n)
        .select(*QUEUE_COLUMNS).orderBy("seller", "position")
    )


def customer_context(
    ctx: Ctx, scores: DataFrame, features: DataFrame, customer_id: object = None
) -> DataFrame:
    """What to know before a call: value, rhythm, mix, band and score."""
    who = ctx["customers"].select("customer_id", "name", "city", "state")
    profile = features.select(
        "customer_id", "recency_days", "order_frequency", "total_value", "avg_ticket",
        "margin_share", "distinct_skus", "distinct_brands",
    )
    wanted = {"customer_id": customer_id}
    return (
        optional_filter(scores.select("customer_id", "band", "score"), wanted)
        .join(optional_filter(profile, wanted), "customer_id")
        .join(optional_filter(who, wanted), "customer_id")
    )


def products_to_reorder(
    ctx: Ctx, customer_id: object = None, days: int = RECENT_DAYS
) -> DataFrame:
    """Products a customer used to buy and has not bought in the last ``days``."""
    sales = before(
        optional_filter(sold(ctx["fact"]), {"customer_id": customer_id}), "order_date", ctx.as_of
    )
    names = ctx["products"].select("sku", F.col("name").alias("product_name"))
    bought = sales.groupBy("customer_id", "sku", "brand", "category").agg(
        F.count(F.lit(1)).alias("times_bought"), F.max("order_date").alias("last_bought"),
    ).where(F.col("last_bought") < F.date_sub(F.lit(ctx.as_of), days))
    return bought.join(names, "sku").select(
        "customer_id", "sku", "product_name", "brand", "category", "times_bought", "last_bought"
    ).orderBy("customer_id", F.desc("times_bought"), "sku")


def availability(ctx: Ctx, sku: object = None) -> DataFrame:
    """Balance and stock-out of a SKU on its own newest snapshot day.

    The newest row is an aggregate over a struct, combined before the shuffle.
    """
    newest = optional_filter(ctx["stock"], {"sku": sku}).groupBy("sku").agg(
        F.max(F.struct("snapshot_on", "balance")).alias("_last")
    )
    return newest.select(
        "sku", F.col("_last.snapshot_on").alias("snapshot_on"),
        F.col("_last.balance").alias("balance"),
        (F.col("_last.balance") == 0).alias("stock_out"),
    )


def register_sql_functions(spark: SparkSession, ctx: Ctx, views: dict[str, DataFrame]) -> None:
    """Publish the four lookups as temporary SQL table functions.

    ``views`` holds ``queue``, ``scores`` and ``features``; the other inputs
    come from ``ctx``.  Parameter types follow the ids of the tables.
    """
    fact, customers, stock = sold(ctx["fact"]), ctx["customers"], ctx["stock"]
    for name, df in {
        **views, "sales": before(fact, "order_date", ctx.as_of), "customers": customers,
        "products": ctx["products"], "stock": stock,
    }.items():
        df.createOrReplaceTempView(f"fn_{name}")
    customer_type = customers.schema["customer_id"].dataType.simpleString()
    sku_type = stock.schema["sku"].dataType.simpleString()
    cut = f"DATE '{ctx.as_of.isoformat()}'"

    def table_type(df: DataFrame) -> str:
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)

    def create(name: str, parameters: str, result: DataFrame, body: str) -> None:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
            f"RETURNS TABLE ({table_type(result)}) RETURN {body}"
        )

    create(
        "prioritize", "p_seller STRING, p_n INT", views["queue"].select(*QUEUE_COLUMNS),
        f"SELECT {', '.join(QUEUE_COLUMNS)} FROM fn_queue "
        "WHERE seller = p_seller AND position <= p_n ORDER BY position",
    )
    context = customer_context(ctx, views["scores"], views["features"])
    fields = {"customer_id": "s.customer_id", "band": "s.band", "score": "s.score",
              "name": "c.name", "city": "c.city", "state": "c.state"}
    picked = ", ".join(fields.get(c, f"f.{c}") for c in context.columns)
    create(
        "customer_context", f"p_customer {customer_type}", context,
        f"SELECT {picked} FROM fn_scores s JOIN fn_features f ON f.customer_id = s.customer_id "
        "JOIN fn_customers c ON c.customer_id = s.customer_id WHERE s.customer_id = p_customer",
    )
    reorder = products_to_reorder(ctx).drop("customer_id")
    create(
        "products_to_reorder", f"p_customer {customer_type}", reorder,
        "SELECT b.sku, p.name, b.brand, b.category, b.times_bought, b.last_bought FROM ("
        "SELECT sku, brand, category, count(*) AS times_bought, max(order_date) AS last_bought "
        "FROM fn_sales WHERE customer_id = p_customer GROUP BY sku, brand, category) b "
        "JOIN fn_products p ON p.sku = b.sku "
        f"WHERE b.last_bought < date_sub({cut}, {RECENT_DAYS}) "
        "ORDER BY b.times_bought DESC, b.sku",
    )
    create(
        "availability", f"p_sku {sku_type}", availability(ctx),
        "SELECT sku, snapshot_on, balance, stock_out FROM ("
        "SELECT sku, snapshot_on, balance, stock_out, "
        "max(snapshot_on) OVER (PARTITION BY sku) AS newest FROM fn_stock) "
        "WHERE sku = p_sku AND snapshot_on = newest",
    )
