
from __future__ import annotations

import datetime as dt
import importlib
import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from salesloom.context import SESSION_CONF, Ctx, shared_root, size_shuffles  # noqa: E402
from salesloom.functions import columns as C  # noqa: E402
from salesloom.functions import table_functions as fn  # noqa: E402
from salesloom.operators.boosting import relational_scores  # noqa: E402
from salesloom.operators.contracts import Check, enforce, violation_counts  # noqa: E402
from salesloom.operators.stats import BAND_NAMES, auc, calibration, lift_at_k, score_bands  # noqa: E402
from salesloom.plans import conform, dashboard, features, feedback  # noqa: E402
from salesloom.plans import marts, metrics, propensity, quality, queue, silver  # noqa: E402
from salesloom.sources import arrival, ingest, testdata  # noqa: E402
from salesloom.sources import quarantine as dead_letters  # noqa: E402
from salesloom.sources.manifest import COLUMNS, EXTRACTS  # noqa: E402

_contexts: dict[tuple[str, str], Ctx] = {}


def context(spark: SparkSession, sf_dir: str) -> Ctx:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _contexts:
        for name, value in SESSION_CONF.items():
            if name.startswith("spark.sql.adaptive"):
                spark.conf.set(name, value)
        size_shuffles(spark, f"{sf_dir}/lineitem.parquet")
        _contexts[key] = testdata.context(spark, sf_dir)
    return _contexts[key]


def flat(df: DataFrame) -> DataFrame:
    """Plain types for comparison: dates as text, decimals as double, ints as bigint."""
    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema])


# A score anybody can recompute, in place of the model's, so that what is built
# on scores can be compared value by value.
def rule_score() -> Column:
    return 1.0 / (1.0 + F.col("recency_days") / 30.0)


def rule_scores(ctx: Ctx) -> DataFrame:
    """Written once, as the batch writes the model's scores and bands."""
    def build() -> DataFrame:
        scored = ctx["features.score"].select("customer_id", rule_score().alias("score"), "recency_days")
        return score_bands(ctx.store, scored, "score")

    return ctx.store.table("rule_scores", build)


def the_queue(ctx: Ctx) -> DataFrame:
    return ctx.store.table(
        "call_queue",
        lambda: queue.call_queue(ctx, rule_scores(ctx), ctx["features.score"]),
    )


def accepted_feedback(ctx: Ctx) -> DataFrame:
    return feedback.validate_feedback(ctx["raw.feedback"], ctx.as_of)[0]


def metrics_row(ctx: Ctx) -> DataFrame:
    """The metrics table, with the rule score in place of a model's."""
    def build() -> DataFrame:
        holdout = split(ctx).where("holdout")
        return propensity.model_metrics(
            ctx.store, holdout.withColumn("score", rule_score()), rule_on_training(ctx),
            propensity.baseline_auc(ctx.store, holdout), 1, F.lit(dt.datetime(2001, 8, 2)),
            feature_top="recency_days",
        )

    return ctx.store.table("model_metrics", build)


def rule_on_training(ctx: Ctx) -> DataFrame:
    return ctx["features.train"].select("customer_id", "bought", rule_score().alias("score"))


def split(ctx: Ctx) -> DataFrame:
    return ctx.store.table(
        "split", lambda: propensity.stratified_split(ctx["features.train"]))


def folded(ctx: Ctx) -> DataFrame:
    return ctx.store.table("folded", lambda: propensity.stratified_folds(split(ctx)))


def trained_models(ctx: Ctx):
    """The main model and those of the folds, fitted together and once."""
    if not hasattr(ctx, "_models"):
        ctx._models = propensity.train_all(folded(ctx), iterations=propensity.ITERATIONS)
    return ctx._models


def node_scores(ctx: Ctx, name, rows: DataFrame) -> DataFrame:
    """customer_id and the score that a model's node table gives, by joins alone."""
    return relational_scores(
        rows.select("customer_id", *features.FEATURES), trained_models(ctx)[name].nodes(ctx.spark),
        "customer_id", propensity.MAX_DEPTH, "node_score")


def same(a: str, b: str) -> Column:
    return F.coalesce(F.abs(F.col(a) - F.col(b)) < 1e-9, F.lit(False))


# --- queries ------------------------------------------------------------------

def q_clean_dates(ctx: Ctx) -> DataFrame:
    raw = ctx["raw.customers"]
    return raw.select("cliente_id", C.parse_date("data_cadastro").alias("parsed")).groupBy(
        F.year("parsed").alias("year"), F.month("parsed").alias("month")
    ).agg(F.count(F.lit(1)).alias("customers"), F.min("parsed").alias("first_day"))


def q_clean_tax_id(ctx: Ctx) -> DataFrame:
    return silver.standardise_customers(ctx["raw.customers"]).select(
        "customer_id", "tax_id", "tax_id_valid", "name"
    )


def q_clean_flags(ctx: Ctx) -> DataFrame:
    return silver.standardise_customers(ctx["raw.customers"]).groupBy("active", "segment").agg(
        F.count(F.lit(1)).alias("customers"), F.count("registered_on").alias("dated")
    )


def q_stage_map(ctx: Ctx) -> DataFrame:
    return ctx["raw.opportunities"].withColumn(
        "mapped", C.map_values("stage", C.STAGE_NAMES)
    ).groupBy("stage", "mapped").agg(
        F.count(F.lit(1)).alias("opportunities"), F.sum("estimated_value").alias("value")
    )


def q_discontinued(ctx: Ctx) -> DataFrame:
    return silver.flag_discontinued(ctx["items"], ctx["products"]).groupBy(
        "discontinued", "is_return"
    ).agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity_abs").alias("units"))


def q_conversion_losses(ctx: Ctx) -> DataFrame:
    """Of every typed column of the ten extracts: values in the text and values lost by typing."""
    return reduce(DataFrame.unionByName, [
        silver.conversion_losses(raw_extract(ctx, name), typed).withColumn("extract", F.lit(name))
        for name, typed in silver.typed_columns().items()
    ])


def q_contracts(ctx: Ctx) -> DataFrame:
    """Broken row contracts of customers, orders and items."""
    customers = [*silver.CUSTOMER_CHECKS, Check("tax_id_valid", "tax_id_valid")]
    return reduce(DataFrame.unionByName, [
        violation_counts(silver.standardise_customers(ctx["raw.customers"]), customers),
        violation_counts(silver.clean_orders(raw_extract(ctx, "pedidos")), silver.ORDER_CHECKS),
        violation_counts(silver.clean_items(raw_extract(ctx, "itens_pedido")), silver.ITEM_CHECKS),
    ])


def q_assignment(ctx: Ctx) -> DataFrame:
    return ctx["assignments"].select(
        "assignment_id", "customer_id", "seller_id", "current", "orphaned", "seller_known"
    )


def q_product_abc(ctx: Ctx) -> DataFrame:
    return marts.product_abc(ctx).select(
        "sku", "total", F.round("running_share", 6).alias("running_share"), "abc_class"
    )


def q_mart_product(ctx: Ctx) -> DataFrame:
    return marts.product_month(ctx)


# a deviation is summed in another order by every engine
DIGITS = {"gap_stddev_days": 6}


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[
        F.round(f.name, DIGITS.get(f.name, digits)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema
    ])


def q_feat(*names: str) -> Callable[[Ctx], DataFrame]:
    return lambda ctx: rounded(ctx["features.train"].select("customer_id", *names))


def q_split(ctx: Ctx) -> DataFrame:
    return propensity.stratified_split(ctx["features.train"]).select(
        "customer_id", "bought", "holdout")


def q_folds(ctx: Ctx) -> DataFrame:
    return propensity.stratified_folds(ctx["features.train"]).select(
        "customer_id", "bought", "fold"
    )


def q_baseline_auc(ctx: Ctx) -> DataFrame:
    return rounded(
        propensity.baseline_auc(ctx.store, split(ctx).where("holdout")), 9
    )


def q_auc(ctx: Ctx) -> DataFrame:
    return rounded(auc(ctx.store, rule_on_training(ctx), "score", "bought"), 9)


def q_lift(ctx: Ctx) -> DataFrame:
    return rounded(lift_at_k(rule_on_training(ctx), "score", "bought", "customer_id"), 9)


def q_bands(ctx: Ctx) -> DataFrame:
    return rounded(rule_scores(ctx).select("customer_id", "score", "band"), 9)


def q_calibration(ctx: Ctx) -> DataFrame:
    return rounded(calibration(
        score_bands(ctx.store, rule_on_training(ctx), "score"), "score", "bought"), 9)


def q_gates(ctx: Ctx) -> DataFrame:
    return propensity.model_gates(metrics_row(ctx)).select("check", "observed", "passed")


# What trees score no static SQL can know; these queries compare the library's scores with
# those that joins with the node table give, and what is built on them with plain recomputations.
def q_propensity(ctx: Ctx) -> DataFrame:
    """Everybody scored by the fitted model: is the score the node table's, the band that of the quartiles?"""
    scored = ctx.store.scratch(propensity.propensity_scores(
        ctx.store, trained_models(ctx)[propensity.MAIN], ctx["features.score"], version=1))
    quartiles = scored.agg(F.percentile("score", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
                           F.countDistinct("score").alias("different")).select(F.struct("*")).scalar()
    place = sum(((F.col("score") > quartiles["q"][k]).cast("int") for k in range(3)), F.lit(0))
    return scored.join(node_scores(ctx, propensity.MAIN, ctx["features.score"]), "customer_id", "left").select(
        "customer_id", "version", (F.col("score").between(0, 1) & same("score", "node_score")).alias("is_of_nodes"),
        (F.col("band") == F.array(*[F.lit(n) for n in BAND_NAMES])[place]).alias("is_band_of_quartiles"),
        (quartiles["different"] > 1).alias("tells_apart"),
    )


def q_oof(ctx: Ctx) -> DataFrame:
    """Everybody scored by the model that has not seen their fold, and by that model's node table."""
    models = trained_models(ctx)
    scored = propensity.oof_scores(ctx.store, folded(ctx), models=models)
    plain = reduce(DataFrame.unionByName, [
        node_scores(ctx, k, folded(ctx).where(F.col("fold") == k)) for k in range(propensity.FOLDS)])
    return scored.join(plain, "customer_id", "left").select(
        "customer_id", "bought", "fold", same("score", "node_score").alias("is_of_nodes"))


def q_fitted_metrics(ctx: Ctx) -> DataFrame:
    """Metrics and gates of the fitted model, each against a plain recomputation on node scores."""
    models = trained_models(ctx)
    holdout = ctx.store.scratch(propensity.score(
        models[propensity.MAIN], folded(ctx).where("holdout")))
    oof = ctx.store.scratch(propensity.oof_scores(ctx.store, folded(ctx), models=models))
    row = ctx.store.scratch(propensity.model_metrics(
        ctx.store, holdout, oof, propensity.baseline_auc(ctx.store, folded(ctx).where("holdout")), 1,
        F.lit(dt.datetime(2001, 8, 2))))
    plain = node_scores(ctx, propensity.MAIN, folded(ctx).where("holdout")).join(
        folded(ctx).select("customer_id", "bought"), "customer_id").select(
        "bought", F.round("node_score", 12).alias("s"))
    ranks = plain.groupBy("s").agg(
        F.sum("bought").alias("pos"), F.count(F.lit(1)).alias("n")).withColumn(
        "below", F.coalesce(F.sum("n").over(Window.orderBy("s").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))  # distinct scores of the holdout
    sums = ranks.agg(F.sum(F.col("pos") * (F.col("below") + (F.col("n") + 1) / 2)).alias("r"),
                     F.sum("pos").alias("p"), F.sum("n").alias("n"))
    p, n = F.col("p"), F.col("n")
    auc_again = sums.select(F.round((F.col("r") - p * (p + 1) / 2) / (p * (n - p)), 4)).scalar()
    hits = oof.orderBy(F.desc("score"), "customer_id").limit(propensity.TOP_K).agg(
        F.sum("bought").alias("h"), F.count(F.lit(1)).alias("k"))
    lift_again = F.round(hits.select(F.col("h") / F.col("k")).scalar() / oof.agg(F.avg("bought")).scalar(), 2)
    best = F.greatest("baseline_recency", "baseline_value", "baseline_delay")
    gates = propensity.model_gates(row).groupBy().pivot("check", ["auc_beats_rules", "auc_plausible", "lift_pays"]).agg(
        F.first("passed"))
    judged = gates.select(F.struct("*")).scalar()
    checks = F.array(*[F.struct(F.lit(name).alias("metric"), F.coalesce(held, F.lit(False)).alias("agrees")) for name, held in (
        ("auc", F.abs(F.col("auc") - auc_again) < 2e-4), ("lift_top_k", F.abs(F.col("lift_top_k") - lift_again) < 0.011),
        ("auc_beats_rules", judged["auc_beats_rules"] == (F.col("auc") >= best + propensity.MIN_GAIN_OVER_RULES)),
        ("auc_plausible", judged["auc_plausible"] == (F.col("auc") < propensity.MAX_PLAUSIBLE_AUC)),
        ("lift_pays", judged["lift_pays"] == (F.col("lift_top_k") >= propensity.MIN_LIFT)))])
    return row.select(F.inline(checks))


def q_importance(ctx: Ctx) -> DataFrame:
    """The ten features whose shuffling costs most: their places, and whether they fall."""
    top = propensity.permutation_importance(
        ctx.store, trained_models(ctx)[propensity.MAIN], split(ctx).where("holdout")
    )
    order = Window.orderBy(F.desc("importance_mean"), "feature")  # ten rows
    return top.select(
        F.row_number().over(order).alias("place"),
        F.col("feature").isin(*features.FEATURES).alias("is_feature"),
        F.coalesce(F.lag("importance_mean").over(order) >= F.col("importance_mean"), F.lit(True))
        .alias("in_order"),
    )


def q_queue(ctx: Ctx) -> DataFrame:
    return queue.top_n(
        queue.eligible(ctx, rule_scores(ctx), ctx["features.score"])
    ).select("customer_id", "seller_id", "position", F.round("score", 6).alias("score"), "band")


def q_preferred(ctx: Ctx) -> DataFrame:
    return queue.preferred_brand(ctx["fact"])


def q_suggest(ctx: Ctx) -> DataFrame:
    return queue.suggest_product(ctx["fact"], ctx.as_of)


def q_reason(ctx: Ctx) -> DataFrame:
    return ctx["features.score"].select("customer_id", queue.reason().alias("reason"))


def q_queue_checks(ctx: Ctx) -> DataFrame:
    return queue.queue_checks(the_queue(ctx))


def q_prioritize(ctx: Ctx) -> DataFrame:
    return rounded(fn.prioritize(the_queue(ctx), n=5))


def q_customer_context(ctx: Ctx) -> DataFrame:
    return rounded(fn.customer_context(ctx, rule_scores(ctx), ctx["features.score"]))


def q_reorder(ctx: Ctx) -> DataFrame:
    return fn.products_to_reorder(ctx)


def q_availability(ctx: Ctx) -> DataFrame:
    return fn.availability(ctx)


def q_feedback_validate(ctx: Ctx) -> DataFrame:
    good, bad = feedback.validate_feedback(ctx["raw.feedback"], ctx.as_of)
    broken = bad.select("status", F.concat_ws(",", "_violations").alias("broken"))
    return good.select("status", F.lit("").alias("broken")).unionByName(broken).groupBy(
        "status", "broken"
    ).agg(F.count(F.lit(1)).alias("calls"))


def stamp_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


def q_feedback_merge(ctx: Ctx) -> DataFrame:
    """Two batches through the job that keeps them, and both once more."""
    log = feedback.FeedbackLog(ctx.spark, f"{ctx.store._root()}/feedback/{uuid.uuid4().hex}")
    calls = ctx["raw.feedback"]
    for remainder in (0, 1, 0, 1):
        log.record(calls.where(F.col("event_id") % 2 == remainder), ctx.as_of)
    return stamp_text(
        log.latest().select("customer_id", "seller", "status", "comment", "recorded_at", "recorded_by"),
        "recorded_at",
    )


def q_queue_feedback(ctx: Ctx) -> DataFrame:
    joined = feedback.queue_with_feedback(the_queue(ctx), accepted_feedback(ctx))
    return stamp_text(joined, "feedback_at")


def q_week_kpis(ctx: Ctx) -> DataFrame:
    return feedback.week_kpis(the_queue(ctx), accepted_feedback(ctx), metrics_row(ctx))


def q_followup(ctx: Ctx) -> DataFrame:
    return feedback.followup(the_queue(ctx), accepted_feedback(ctx))


def q_followup_totals(ctx: Ctx) -> DataFrame:
    return feedback.followup_totals(q_followup(ctx))


def q_dash(build: Callable[..., DataFrame], **filters: object) -> Callable[[Ctx], DataFrame]:
    return lambda ctx: build(dashboard.dashboard_base(ctx, filters))


def q_answer(name: str) -> Callable[[Ctx], DataFrame]:
    return lambda ctx: dashboard.curated_answers(
        ctx, the_queue(ctx), accepted_feedback(ctx), metrics_row(ctx))[name]()


def q_unique(ctx: Ctx) -> DataFrame:
    valid = ctx["customers"].where("tax_id_valid")
    return quality.unique(valid, "tax_id", "tax_id_unique")


def q_orphans(ctx: Ctx) -> DataFrame:
    return quality.orphans(
        ctx["fact"], ctx["orders"], "order_id", "order_orphans"
    ).unionByName(quality.orphans(
        ctx["items"], ctx["orders"].where(~F.col("cancelled")), "order_id",
        "lines_of_cancelled_orders",
    )).unionByName(
        quality.orphans(ctx["fact"], ctx["customers"], "customer_id", "customer_orphans")
    )


def q_stage_counts(ctx: Ctx) -> DataFrame:
    return quality.stage_counts(ctx["items"], {
        "returns": F.col("is_return"), "priced": F.col("unit_price").isNotNull(),
    })


def q_survivor_fact(ctx: Ctx) -> DataFrame:
    """The fact with the orders of merged customers moved to the survivor."""
    return conform.control_totals(conform.sales_fact(ctx, remap_customers=True))


def delivered(ctx: Ctx) -> str:
    """The source tables as ten text extracts below the shared folder, with dirt in some columns."""
    root = f"{shared_root(ctx.spark)}/salesloom/{ctx.store.app}/{ctx.store.scope}/delivery"
    if not hasattr(ctx, "_delivered"):
        made = testdata.extracts(ctx)
        raw = ctx["raw.customers"]
        made["clientes"] = raw.select(*[F.col(c).cast("string") for c in raw.columns])
        made["pedidos"] = ctx["orders"].select(
            F.col("order_id").alias("pedido_id"), F.col("customer_id").alias("cliente_id"),
            F.date_format("order_date", "dd/MM/yyyy").alias("data_pedido"),
            F.col("channel").alias("canal"),
            F.when(F.col("cancelled"), "Cancelado").otherwise("Faturado").alias("status"),
            F.col("total_value").alias("valor_total"), F.lit(None).cast("string")
            .alias("vendedor_id"),
        )
        for name, column, key, size, at, text in (
            ("itens_pedido", "preco_praticado", "pedido_id", 100, 7, "n/a"),
            ("pagamentos", "forma_pagamento", "pedido_id", 50, 3, None),
            ("pagamentos", "taxa_pct", "pedido_id", 60, 4, "7%"),
            ("estoque", "saldo", "sku", 20, 1, "?"),
            ("produtos", "preco_tabela", "sku", 40, 3, "12,50"),
            ("produtos", "nota_olfativa", "sku", 25, 2, None),
            ("vendedores", "uf", "vendedor_id", 9, 2, None),
            ("oportunidades", "valor_estimado", "oportunidade_id", 30, 5, "R$ 10"),
        ):
            dirty = F.col(key).cast("bigint") % size == at
            made[name] = made[name].withColumn(
                column, F.when(dirty, F.lit(text)).otherwise(F.col(column)))
        testdata.write_extracts(made, root)
        setattr(ctx, "_delivered", True)
    return root


def raw_extract(ctx: Ctx, name: str) -> DataFrame:
    system = next(s for s, names in EXTRACTS.items() if name in names)
    return ingest.ingest_csv(ctx.spark, delivered(ctx), system, name)


def q_ingest_reconcile(ctx: Ctx) -> DataFrame:
    """Rows of the ten extracts as the control table has them and as they are ingested."""
    root = delivered(ctx)
    control = arrival.probe(ctx.spark, root, dt.datetime(2001, 8, 2))
    return ingest.reconcile_ingest(control, ingest.row_counts(ingest.ingest_all(ctx.spark, root)))


def q_csv_products(ctx: Ctx) -> DataFrame:
    return silver.clean_products(raw_extract(ctx, "produtos")).withColumn(
        "sku", F.col("sku").cast("bigint"))


def q_csv_items(ctx: Ctx) -> DataFrame:
    """Lines, units and values of order lines that went through text; dirty prices are NULL."""
    kept = enforce(silver.clean_items(raw_extract(ctx, "itens_pedido")), silver.ITEM_CHECKS)
    return kept.groupBy("is_return").agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("quantity"), F.sum("quantity_abs").alias("quantity_abs"),
        F.sum("gross_value").alias("gross_value"), F.sum("discount_pct").alias("discount_pct"),
        F.count("unit_price").alias("priced"), F.count("revenue").alias("valued"),
    )


def q_csv_payments(ctx: Ctx) -> DataFrame:
    return silver.clean_payments(raw_extract(ctx, "pagamentos")).groupBy("method", "status").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("installments").alias("installments"),
        F.sum("amount").alias("amount"), F.sum("net_amount").alias("net_amount"),
        F.sum("fee_pct").alias("fee_pct"), F.count("fee_pct").alias("with_fee"),
        F.min("due_on").alias("first_due"), F.max("paid_on").alias("last_paid"),
    )


def q_csv_stock(ctx: Ctx) -> DataFrame:
    return silver.clean_stock(raw_extract(ctx, "estoque")).withColumn(
        "sku", F.col("sku").cast("bigint"))


def q_csv_sellers(ctx: Ctx) -> DataFrame:
    return silver.clean_sellers(raw_extract(ctx, "vendedores")).withColumn(
        "seller_id", F.col("seller_id").cast("bigint"))


def q_csv_assignments(ctx: Ctx) -> DataFrame:
    rows = silver.clean_assignments(
        raw_extract(ctx, "carteira"), silver.clean_sellers(raw_extract(ctx, "vendedores")))
    return rows.withColumns({
        c: F.col(c).cast("bigint") for c in ("assignment_id", "customer_id", "seller_id")})


def q_csv_opportunities(ctx: Ctx) -> DataFrame:
    return silver.clean_opportunities(raw_extract(ctx, "oportunidades")).groupBy("stage").agg(
        F.count(F.lit(1)).alias("opportunities"), F.countDistinct("customer_id").alias("customers"),
        F.sum("estimated_value").alias("value"), F.count("estimated_value").alias("valued"),
        F.min("opened_on").alias("first_opened"), F.max("closed_on").alias("last_closed"),
        F.sum("probability_pct").alias("probability_pct"), F.sum("cycle_days").alias("cycle_days"),
    )


def q_csv_visits(ctx: Ctx) -> DataFrame:
    return silver.clean_visits(raw_extract(ctx, "visitas")).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("visits"), F.countDistinct("customer_id").alias("customers"),
        F.min("visited_on").alias("first_visit"), F.max("visited_on").alias("last_visit"),
        F.sum("duration_minutes").alias("minutes"),
    )


def q_csv_orders(ctx: Ctx) -> DataFrame:
    """Net value per channel and year of orders that went through text."""
    raw = ingest.ingest_csv(ctx.spark, delivered(ctx), "erp", "pedidos")
    kept = enforce(silver.clean_orders(raw), silver.ORDER_CHECKS)
    return kept.groupBy("channel", "year").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if("cancelled").alias("cancelled"),
        F.sum("net_value").alias("net_value"),
    )


def q_csv_customers(ctx: Ctx) -> DataFrame:
    """Surviving customers of an extract that went through text."""
    raw = ingest.ingest_csv(ctx.spark, delivered(ctx), "crm", "clientes")
    return silver.clean_customers(raw).select(
        F.col("customer_id").cast("bigint").alias("customer_id"), "tax_id", "name",
        "registered_on", "active", "segment", "city", "state",
    )


def q_quarantine(ctx: Ctx) -> DataFrame:
    """Letters by extract, column and reason of the dirty delivery, and rows in, kept and quarantined.

    Visits come with part files of an older layout beside, whose lines lack fields.
    """
    def of(name: str) -> DataFrame:
        system = next(s for s, names in EXTRACTS.items() if name in names)
        path = f"{delivered(ctx)}/{system}/{name}.csv"
        if name == "visitas":
            more = f"{ctx.store._root()}/late-{uuid.uuid4().hex}"
            ctx["visits"].where(F.col("visit_id") % 40 == 1).select(
                F.col("visit_id").alias("visita_id"), F.col("customer_id").alias("cliente_id")
            ).write.option("header", "true").csv(more)
            path = [path, more]
        lines = dead_letters.read_lines(ctx.spark, ctx.store, path, COLUMNS[name])
        return dead_letters.balance(
            lines, silver.typed_columns()[name], dead_letters.REQUIRED[name]).withColumn("extract", F.lit(name))

    return reduce(DataFrame.unionByName, [of(name) for names in EXTRACTS.values() for name in names])


def q_broken_delivery(ctx: Ctx) -> DataFrame:
    """A delivery with each thing that can be wrong, judged file by file; bytes are compared."""
    root = f"{ctx.store._root()}/broken-{uuid.uuid4().hex}"
    supplier = ctx["src.supplier"]

    def put(system: str, name: str, keep: Column, header: str = "true", **options: str) -> None:
        """A part file of lines of equal length."""
        supplier.where(keep).coalesce(1).select(
            F.format_string("%06d", F.col("s_suppkey").cast("bigint")).alias("id"), F.lit("x").alias("name")
        ).write.mode("append").options(header=header, **options).csv(f"{root}/{system}/{name}.csv")

    every, none, third = F.lit(True), F.lit(False), F.col("s_suppkey") % 3 == 0
    put("erp", "produtos", every)
    for half in (0, 1):
        put("erp", "pedidos", F.col("s_suppkey") % 2 == half)
    put("erp", "itens_pedido", none)  # a header alone
    put("erp", "pagamentos", none, header="false")  # not even that
    put("crm", "clientes", every, compression="gzip")
    for name in ("vendedores", "carteira", "oportunidades"):
        put("crm", name, third)
    # neither erp/estoque nor crm/visitas
    return arrival.judge(arrival.probe(ctx.spark, root, dt.datetime(2001, 8, 2))).select(
        "system", "file", F.when(F.col("file") == "clientes.csv", None).otherwise(F.col("bytes")).alias("bytes"),
        "rows", "verdict")


def q_arrival_summary(ctx: Ctx) -> DataFrame:
    """Files, rows and whether anything is missing among the delivered extracts."""
    control = arrival.probe(ctx.spark, delivered(ctx), dt.datetime(2001, 8, 2))
    return arrival.arrival_summary(arrival.check_arrival(control)).drop("megabytes")


QUERIES: dict[str, Callable[[Ctx], DataFrame]] = {
    # conformed tables
    "sales_fact": lambda c: c["fact"],
    "sales_fact_totals": lambda c: conform.control_totals(c["fact"]),
    "dim_customer": conform.dim_customer,
    "dim_product": conform.dim_product,
    "dim_seller": conform.dim_seller,
    "dim_calendar": conform.dim_calendar,
    # cleaning, contracts, deduplication
    "clean_dates": q_clean_dates,
    "clean_tax_id": q_clean_tax_id,
    "clean_flags": q_clean_flags,
    "stage_map": q_stage_map,
    "dedup_customers": lambda c: silver.clean_customers(c["raw.customers"], ids_unique=True),
    "dedup_id_map": lambda c: c["customer_map"],
    "remapped_fact_totals": q_survivor_fact,
    "discontinued_flag": q_discontinued,
    "assignment_state": q_assignment,
    "conversion_losses": q_conversion_losses,
    "contracts_enforce": q_contracts,
    "stage_counts": q_stage_counts,
    # marts
    "mart_seller_month": marts.seller_month,
    "mart_product_month": q_mart_product,
    "abc_classes": q_product_abc,
    "mart_receivables": lambda c: rounded(marts.receivables(c), 6),
    # metric views
    "monthly_revenue": metrics.monthly_revenue,
    "brand_ranking": metrics.brand_ranking,
    "category_margin": metrics.category_margin,
    "customers_at_risk": metrics.customers_at_risk,
    "launch_effect": metrics.launch_effect,
    "stockout_by_brand": metrics.stockout_by_brand,
    # data quality
    "dq_reconcile": quality.reconcile,
    "dq_unique": q_unique,
    "dq_complete": quality.complete,
    "dq_fact": quality.fact_checks,
    "dq_orphans": q_orphans,
    "dq_mart_conform": quality.mart_conforms,
    "dq_tax_ids": quality.tax_ids,
    "dq_all": quality.all_checks,
    # features
    "feat_rfm": q_feat("recency_days", "order_frequency", "total_value", "avg_ticket",
                       "total_margin", "margin_share"),
    "feat_rhythm": q_feat("mean_gap_days", "gap_stddev_days", "relative_delay", "orders_90d"),
    "feat_crm": q_feat("open_opportunities", "won_opportunities", "win_rate", "visits_90d",
                       "visit_conversion"),
    "feat_mix": q_feat("distinct_skus", "distinct_categories", "distinct_brands",
                       "top_brand_share", "bought_launch"),
    "features_asof": lambda c: rounded(c["features.score"].drop("reference")),
    "training_label": lambda c: c["features.train"].select("customer_id", "bought"),
    "leakage_report": lambda c: features.leakage_report(c["features.train"], c["features.score"]),
    # propensity
    "stratified_split": q_split,
    "stratified_folds": q_folds,
    "baseline_auc": q_baseline_auc,
    "rule_auc": q_auc,
    "lift_at_k": q_lift,
    "score_bands": q_bands,
    "calibration": q_calibration,
    "model_metrics": lambda c: metrics_row(c).drop("trained_at"),
    "model_gates": q_gates,
    "propensity_scores": q_propensity,
    "oof_scores": q_oof,
    "fitted_metrics": q_fitted_metrics,
    "perm_importance": q_importance,
    # queue and table functions
    "queue_topn": q_queue,
    "preferred_brand": q_preferred,
    "suggest_sku": q_suggest,
    "reason_text": q_reason,
    "queue_checks": q_queue_checks,
    "fn_prioritize": q_prioritize,
    "fn_customer_context": q_customer_context,
    "fn_suggest_products": q_reorder,
    "fn_availability": q_availability,
    # feedback
    "feedback_validate": q_feedback_validate,
    "feedback_merge": q_feedback_merge,
    "queue_with_feedback": q_queue_feedback,
    "week_kpis": q_week_kpis,
    "seller_list": lambda c: feedback.seller_list(the_queue(c)),
    "followup_by_seller": q_followup,
    "followup_totals": q_followup_totals,
    # dashboard
    "dash_base": dashboard.dashboard_base,
    "dash_counters": q_dash(dashboard.counters),
    "dash_counters_filtered": q_dash(
        dashboard.counters, year=2000, segment=["HOUSEHOLD", "MACHINERY"], city=None),
    "dash_month": q_dash(dashboard.by_month),
    "dash_channel": q_dash(dashboard.by_channel),
    "dash_category": q_dash(dashboard.margin_by_category),
    "dash_top_brands": q_dash(dashboard.top_brands),
    "dash_top_customers": q_dash(dashboard.top_customers),
    # curated answers
    **{f"answer_{n}": q_answer(n) for n in (
        "who_to_call", "queue_value", "brand_share", "not_buying", "stockouts",
        "calls_and_sales", "model_quality", "risk_of_loss")},
    # files
    "ingest_reconcile": q_ingest_reconcile,
    "csv_orders": q_csv_orders,
    "csv_customers": q_csv_customers,
    "csv_products": q_csv_products,
    "csv_items": q_csv_items,
    "csv_payments": q_csv_payments,
    "csv_stock": q_csv_stock,
    "csv_sellers": q_csv_sellers,
    "csv_assignments": q_csv_assignments,
    "csv_opportunities": q_csv_opportunities,
    "csv_visits": q_csv_visits,
    "arrival_summary": q_arrival_summary,
    "quarantine": q_quarantine,
    "broken_delivery": q_broken_delivery,
}


def entry(spark: SparkSession) -> DataFrame:
    """Control totals of the sales fact."""
    return flat(QUERIES["sales_fact_totals"](context(spark, "/root/testdata/sf0.001")))


def training_data():
    """Queries of the training-data operators, where that subpackage is installed."""
    try:
        return importlib.import_module("salesloom.llm.queries")
    except ImportError as error:  # also where something that it needs is not there
        print(f"without the training-data operators: {error}", file=sys.stderr)
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[Ctx], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: flat(build(context(spark, sf_dir)))

    extra = training_data()
    return {name: bound(build) for name, build in QUERIES.items()} | (
        dict(extra.QUERIES) if extra else {})


def oracle_sql() -> dict[str, str]:
    extra = training_data()
    return {name: text for name, text in oracle.QUERIES.items() if name in QUERIES} | (
        dict(extra.ORACLE_SQL) if extra else {})
