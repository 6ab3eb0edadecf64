"""What the plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry
from salesloom import context
from salesloom.plans import conform, features, marts, quality

SF = "/root/testdata/sf0.001"

BANNED = ("CartesianProduct", "Expand", "BroadcastNestedLoopJoin", "EvalPython", "InPandas",
          "MapInArrow")
CHECKED = (
    "sales_fact_totals", "remapped_fact_totals", "dim_customer", "dim_product", "dedup_customers",
    "dedup_id_map", "mart_seller_month", "mart_product_month", "mart_receivables",
    "monthly_revenue", "brand_ranking", "category_margin", "customers_at_risk", "launch_effect",
    "stockout_by_brand", "dq_reconcile", "dq_orphans", "stratified_split", "queue_topn",
    "suggest_sku", "fn_suggest_products", "fn_availability", "feedback_merge",
    "queue_with_feedback", "week_kpis", "dash_counters", "score_bands", "assignment_state",
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ctx(spark):
    return entry.context(spark, SF)


@pytest.mark.parametrize("name", CHECKED)
def test_no_cross_join_row_multiplication_or_python(ctx, name):
    text = plan(entry.QUERIES[name](ctx))
    assert [word for word in BANNED if word in text] == []


def test_features_have_no_python_and_read_narrow_columns(ctx):
    text = plan(features.training_set(ctx))
    assert [word for word in BANNED if word in text] == []
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert scans and all("customer_name" not in s and "unit_price" not in s for s in scans)


def test_both_feature_sets_read_the_fact_once(ctx):
    once = plan(features.day_lines(ctx["fact"]))
    assert len(re.findall("FileScan parquet", once)) == 1 and "Expand" not in once
    for build in (features.training_set, features.scoring_set):
        files = build(ctx).inputFiles()
        assert not any("/sales_fact/" in f for f in files)
        assert all(any(f"/{name}/" in f for f in files) for name in ("day_base", "customer_days"))


def test_date_cuts_prune_partitions_and_reach_the_files(ctx, capsys):
    features.label(ctx, ctx.train_as_of).explain("formatted")
    text = capsys.readouterr().out
    assert re.search(r"PartitionFilters: \[[^\n]*year", text)
    assert re.search(r"PushedFilters: \[[^\n]*order_date", text)
    assert re.search(r"ReadSchema: struct<order_date:date,customer_id:bigint>", text)


def test_lines_are_shuffled_once_by_order_and_once_by_sku(spark, ctx):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(conform.sales_fact(ctx))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    assert sorted(keys) == sorted(
        ["order_id", "order_id", "sku", "sku", "customer_id", "customer_id"])


def test_shuffles_are_sized_by_the_input(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    path = f"{SF}/lineitem.parquet"
    assert context.size_shuffles(spark, path) == int(
        spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        wanted = context.size_shuffles(spark, path, partition_bytes=10_000)
        assert wanted > 8 and spark.conf.get(name) == str(wanted)
    finally:
        spark.conf.unset(name)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(Conf)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        context.shared_root(Cluster())


def test_all_checks_read_the_fact_twice(ctx):
    reads = []

    class Watched:
        def __getattr__(self, name):
            return getattr(ctx, name)

        def __getitem__(self, name):
            reads.append(name)
            return ctx[name]

    mart = ctx.store.scratch(marts.product_month(ctx))
    result = quality.all_checks(Watched(), mart=mart)
    assert reads.count("fact") == 1  # one frame, of which two are written
    assert not any("/sales_fact/" in f for f in result.inputFiles())
    assert result.count() == 9
