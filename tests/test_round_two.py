"""Runs that follow each other, a session without a shared folder, a spoilt mart, the call list's order."""

import datetime as dt
import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from salesloom import context
from salesloom.context import Ctx, Store
from salesloom.plans import feedback, marts, pipeline, quality

SF = "/root/testdata/sf0.001"


def test_each_run_has_a_scope_of_its_own(spark):
    day = dt.date(2024, 6, 30)
    spark.sql("CREATE DATABASE IF NOT EXISTS scopes")
    one, two = (pipeline.saved_context(spark, "scopes", day, day) for _ in range(2))
    assert one.store.scope != two.store.scope


def test_a_second_run_sees_the_changed_facts(spark):
    base = entry.context(spark, SF)
    fact = base["fact"]
    totals = []
    for sales in (fact, fact.where("year < 1998")):
        ctx = base.with_tables(fact=sales)
        totals.append((marts.product_month(ctx).agg(F.sum("revenue")).first()[0],
                       sales.agg(F.sum("revenue")).first()[0]))
    assert totals[0][0] == totals[0][1] and totals[1][0] == totals[1][1] != totals[0][0]


def test_cleared_scopes_leave_no_files(spark):
    store = Store(spark, "to_clear")
    store.table("t", lambda: spark.range(3))
    store.scratch(spark.range(3))
    root = store._root().removeprefix("file:")
    assert os.path.isdir(root)
    store.clear()
    assert not os.path.exists(root)
    assert store.table("t", lambda: spark.range(5)).count() == 5
    store.clear()


def test_a_local_session_without_a_folder_gets_one(monkeypatch):
    class Unset:
        def get(self, key, default=None):
            return default

    class Local:
        conf = Unset()

        class sparkContext:
            master = "local[2]"
            applicationId = "local-without-folder"
            getConf = staticmethod(Unset)

    root = context.shared_root(Local())
    assert os.path.isdir(root) and context.shared_root(Local()) == root


def test_a_doubled_mart_row_fails_the_check(spark):
    ctx = entry.context(spark, SF)
    mart = ctx.store.scratch(marts.product_month(ctx))
    assert quality.mart_conforms(ctx, mart).first()["passed"]
    assert not quality.mart_conforms(ctx, mart.union(mart.limit(1))).first()["passed"]


def test_the_call_list_follows_the_unrounded_score(spark):
    queue = spark.createDataFrame(
        [("A", 1, 0.5012, 10.0), ("A", 2, 0.5049, 10.0), ("B", 3, 0.7, 10.0)],
        "seller string, customer_id int, score double, avg_ticket double")
    none = spark.createDataFrame([], "customer_id int, status string, comment string, "
                                     "recorded_at timestamp, recorded_by string, event_id int")
    rows = feedback.queue_with_feedback(queue, none).collect()
    assert [(r["customer_id"], r["rank"], r["score"]) for r in rows] == [
        (3, 1, 0.7), (2, 2, 0.5), (1, 3, 0.5)]
    assert [r["customer_id"] for r in feedback.queue_with_feedback(queue, none, "A").collect()] == [2, 1]
    assert isinstance(entry.context(spark, SF), Ctx)
