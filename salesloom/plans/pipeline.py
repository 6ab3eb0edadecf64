"""The whole batch from delivered files to the call queue, step by step."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import Ctx, Store, size_shuffles
from salesloom.operators.contracts import assert_passed, enforce
from salesloom.plans import catalog, conform, features, feedback, marts, metrics, propensity
from salesloom.plans import quality, queue, silver, views
from salesloom.sources import arrival, ingest
from salesloom.sources import quarantine as dead_letters
from salesloom.sources.manifest import COLUMNS, EXTRACTS
from salesloom.sources.tables import ensure_table, replace_table, require_tables, write_table

TABLE_COMMENTS = {
    "dim_customer": "One row per customer with its order history",
    "dim_product": "Catalogue with a flag for SKUs sold while discontinued",
    "dim_seller": "Sellers, their region and monthly target",
    "dim_calendar": "Days with their calendar attributes",
    "sales_fact": "One row per order line of orders that were not cancelled",
    "mart_seller_month": "Seller performance per month against the target, no returns",
    "mart_product_month": "SKU performance per month with ABC class, returns included",
    "mart_receivables": "Receivable, received and open amounts per due month and method",
    "monthly_revenue": "Revenue, margin and orders per month, no returns",
    "brand_ranking": "Revenue and share per brand, no returns",
    "category_margin": "Margin per category, no returns",
    "customers_at_risk": "Customers without a purchase for more than 90 days",
    "launch_effect": "Sales of launched SKUs per day since their launch",
    "stockout_by_brand": "Share of SKUs without stock on the newest snapshot",
}

FACT_COMMENTS = {
    "order_date": "Date of the order", "year": "Year of the order", "month": "Month of the order",
    "channel": "Sales channel", "order_id": "Order", "seller_id": "Seller of the order",
    "customer_id": "Surviving customer", "customer_name": "Standardised customer name",
    "segment": "Customer segment", "city": "Customer city", "state": "Customer state",
    "sku": "Product", "category": "Product category", "brand": "Product brand",
    "scent_note": "Main scent note", "launch_date": "Day the product was launched",
    "quantity": "Units, negative on a return",
    "unit_price": "Price paid per unit", "revenue": "Quantity times price, negative on a return",
    "cost": "Quantity times unit cost, negative on a return", "margin": "Revenue less cost",
    "is_return": "True when the line is a return",
}

VIEWS = {
    "monthly_revenue": metrics.monthly_revenue, "brand_ranking": metrics.brand_ranking,
    "category_margin": metrics.category_margin, "customers_at_risk": metrics.customers_at_risk,
    "launch_effect": metrics.launch_effect, "stockout_by_brand": metrics.stockout_by_brand,
}

FEEDBACK_COMMENTS = {
    "customer_id": "Customer that was called", "seller": "Seller that called",
    "status": "Outcome of the call", "comment": "Free text of the seller",
    "recorded_at": "When the outcome was recorded", "recorded_by": "Who recorded it",
    "reference": "Date of the queue the call belongs to",
}


def bronze(spark: SparkSession, root: str, db: str, checked_at: dt.datetime) -> None:
    """Check the delivery, keep it as text tables, compare the counts."""
    control = arrival.probe(spark, root, checked_at)
    write_table(control, f"{db}.raw_files")
    control = spark.table(f"{db}.raw_files")
    arrival.check_arrival(control)
    for name, df in ingest.ingest_all(spark, root).items():
        write_table(df, f"{db}.raw_{name}")
        catalog.apply_comments(spark, f"{db}.raw_{name}", f"Text of the extract {name}")
    saved = {n: spark.table(f"{db}.raw_{n}") for n in _extract_names()}
    ingest.assert_reconciled(ingest.reconcile_ingest(control, ingest.row_counts(saved)))


def _extract_names() -> list[str]:
    return [*silver.CLEANERS, "carteira"]


CONTRACTS = {
    "customers": silver.CUSTOMER_CHECKS, "orders": silver.ORDER_CHECKS,
    "items": silver.ITEM_CHECKS,
}


def typed(spark: SparkSession, db: str) -> None:
    """Clean every extract, hold the row contracts, save."""
    for raw, (name, clean) in silver.CLEANERS.items():
        source = spark.table(f"{db}.raw_{raw}")
        df = enforce(clean(source), CONTRACTS.get(name, ()))
        write_table(silver.stamp(df, source), f"{db}.{name}")
    source = spark.table(f"{db}.raw_carteira")
    write_table(
        silver.stamp(silver.clean_assignments(source, spark.table(f"{db}.sellers")), source),
        f"{db}.assignments",
    )


def letters(spark: SparkSession, root: str, db: str, store: Store) -> None:
    """Save what typing could not use of every extract, with its reason."""
    found = []
    for system, names in EXTRACTS.items():
        for name in names:
            typed_by, required = silver.typed_columns()[name], dead_letters.REQUIRED[name]
            lines = dead_letters.read_lines(spark, store, f"{root}/{system}/{name}.csv", COLUMNS[name])
            found.append(dead_letters.split(lines, typed_by, required)[1].withColumn("extract", F.lit(name)))
    write_table(reduce(DataFrame.unionByName, found), f"{db}.dead_letters")
    catalog.apply_comments(spark, f"{db}.dead_letters", "Values and lines that typing could not use, with the reason")


def saved_context(spark: SparkSession, db: str, as_of: dt.date, train_as_of: dt.date) -> Ctx:
    """A context over the saved tables of a database."""
    def saved(name):
        return lambda c: spark.table(f"{db}.{name}").drop("_processed_at", "_source_rows")

    names = [name for name, _ in silver.CLEANERS.values()]
    tables = {n: saved(n) for n in [*names, "assignments"]}
    tables["fact"] = saved("sales_fact")
    # a scope for each run: intermediates of an earlier delivery are never read again
    return Ctx(spark, tables, as_of, train_as_of, Store(spark, f"{db}-{as_of}-{uuid.uuid4().hex}"))


def gold(ctx: Ctx, db: str) -> None:
    """Dimensions, fact, marts and metric results with their comments."""
    for name, build in {
        "dim_customer": conform.dim_customer, "dim_product": conform.dim_product,
        "dim_seller": conform.dim_seller, "dim_calendar": conform.dim_calendar,
    }.items():
        write_table(build(ctx), f"{db}.{name}")
    write_table(
        conform.sales_fact(ctx), f"{db}.sales_fact", partition_by=conform.FACT_PARTITIONS,
        comments=FACT_COMMENTS,
    )
    for name, build in {
        "mart_seller_month": marts.seller_month, "mart_product_month": marts.product_month,
        "mart_receivables": marts.receivables,
    }.items():
        write_table(build(ctx), f"{db}.{name}")
    for name in VIEWS:
        views.publish(ctx.spark, db, name, ctx.as_of, TABLE_COMMENTS[name])
    for name, text in TABLE_COMMENTS.items():
        if name not in VIEWS:
            catalog.apply_comments(ctx.spark, f"{db}.{name}", text)


def model(ctx: Ctx, db: str, root: str, iterations: int, k: int = propensity.TOP_K) -> DataFrame:
    """Train, evaluate, save a version, score everybody; returns the metrics row."""
    spark = ctx.spark
    write_table(features.training_set(ctx), f"{db}.features_training")
    write_table(features.scoring_set(ctx), f"{db}.features_customer")
    training = ctx.store.scratch(
        propensity.stratified_folds(propensity.stratified_split(spark.table(f"{db}.features_training")))
    )
    models = propensity.train_all(training, iterations=iterations)
    fitted = models[propensity.MAIN]
    holdout = training.where(F.col("holdout"))
    scored = ctx.store.scratch(propensity.score(fitted, holdout))
    oof = ctx.store.scratch(propensity.oof_scores(ctx.store, training, models=models))
    ranked = propensity.permutation_importance(ctx.store, fitted, holdout, top=1).first()
    registry_name = f"{db}.model_registry"
    known = spark.table(registry_name) if spark.catalog.tableExists(registry_name) else None
    registry = propensity.save_version(spark, fitted, root, "purchase_propensity", known)
    replace_table(registry, registry_name)
    current, version = propensity.load_promoted(spark.table(registry_name), "purchase_propensity")
    result = propensity.model_metrics(
        ctx.store, scored, oof, propensity.baseline_auc(ctx.store, holdout), version,
        F.current_timestamp(), k=k, feature_top=ranked["feature"],
    )
    write_table(result, f"{db}.model_metrics", mode="append")
    write_table(propensity.calibration_by_band(ctx.store, scored), f"{db}.calibration")
    write_table(
        propensity.propensity_scores(
            ctx.store, current, spark.table(f"{db}.features_customer"), version
        ),
        f"{db}.propensity",
    )
    return spark.table(f"{db}.model_metrics").where(F.col("version") == version)


def run(
    spark: SparkSession, root: str, db: str, model_root: str, as_of: dt.date, train_as_of: dt.date,
    fact_rows: tuple[float, float] = quality.FACT_ROWS, queue_size: int = queue.QUEUE_SIZE,
    iterations: int = propensity.ITERATIONS, gates: bool = True,
) -> Ctx:
    """Every step in order; the first check that fails stops the run."""
    size_shuffles(spark, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    ensure_table(spark, f"{db}.call_feedback", feedback.FEEDBACK_SCHEMA, FEEDBACK_COMMENTS)
    bronze(spark, root, db, dt.datetime.combine(as_of, dt.time()))
    typed(spark, db)
    ctx = saved_context(spark, db, as_of, train_as_of)
    try:
        letters(spark, root, db, ctx.store)
        after_cleaning(ctx, db, model_root, fact_rows, queue_size, iterations, gates)
    finally:
        ctx.store.clear()
    return ctx


def after_cleaning(
    ctx: Ctx, db: str, model_root: str, fact_rows: tuple[float, float], queue_size: int,
    iterations: int, gates: bool,
) -> None:
    """From the cleaned tables to the checked queue."""
    spark = ctx.spark
    gold(ctx, db)
    assert_passed(quality.all_checks(ctx, fact_rows, spark.table(f"{db}.mart_product_month")))
    coverage = catalog.comment_coverage(
        catalog.metadata(spark, db).where(F.col("table_name").isin(*TABLE_COMMENTS))
    )
    catalog.audit(coverage, ["sales_fact", *VIEWS])
    quality_of_model = model(ctx, db, model_root, iterations, queue_size)
    if gates:
        assert_passed(propensity.model_gates(quality_of_model))
    calls = queue.call_queue(
        ctx, spark.table(f"{db}.propensity"), spark.table(f"{db}.features_customer"), queue_size
    )
    write_table(calls, f"{db}.call_queue")
    assert_passed(queue.queue_checks(spark.table(f"{db}.call_queue"), queue_size))
    require_tables(spark, [f"{db}.{n}" for n in (
        "call_queue", "call_feedback", "monthly_revenue", "brand_ranking")])
