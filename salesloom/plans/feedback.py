"""What came of the calls: validation, history, latest state and its KPIs."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.context import Store
from salesloom.functions.columns import optional_filter, safe_ratio
from salesloom.operators.contracts import Check, quarantine
from salesloom.operators.merge import append_history, merge_latest
from salesloom.operators.rank import latest_per_key, survivors
from salesloom.sources.snapshots import Snapshots
from salesloom.sources.tables import point_table

# fixed values: outcomes a caller may record and the longest comment
STATUSES = ("vendeu", "vai_pensar", "sem_interesse", "nao_atendeu")
SOLD = "vendeu"
MAX_COMMENT = 500

FEEDBACK_SCHEMA = (
    "customer_id bigint, seller string, status string, comment string, "
    "recorded_at timestamp, recorded_by string, reference date"
)

FEEDBACK_CHECKS = (
    Check("customer_numeric", "try_cast(trim(customer_id) AS bigint) IS NOT NULL"),
    Check("seller_present", "seller IS NOT NULL"),
    Check("status_known", "status IS NOT NULL AND status IN ({})".format(
        ", ".join(f"'{s}'" for s in STATUSES))),
    Check("comment_length", f"length(comment) <= {MAX_COMMENT}"),
)


def validate_feedback(batch: DataFrame, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """(accepted rows with typed columns, rejected rows with ``_violations``).

    A missing comment becomes empty text, a missing reference the date of the run.
    """
    good, bad = quarantine(batch, FEEDBACK_CHECKS)
    accepted = (
        good.withColumn("customer_id", F.trim("customer_id").cast("bigint"))
        .withColumn("comment", F.coalesce("comment", F.lit("")))
        .withColumn("recorded_by", F.col("seller"))
        .withColumn("reference", F.coalesce(F.expr("try_cast(reference AS date)"), F.lit(as_of)))
    )
    return accepted, bad


def apply_feedback(target: DataFrame, updates: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """Upsert by customer; the seller of an existing row is not touched."""
    return merge_latest(
        target, updates, ["customer_id"], "recorded_at", tie, keep_from_target=("seller",)
    )


def add_to_history(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Keep every call; replaying a batch adds nothing (rows carry ``event_id``)."""
    return append_history(history, batch, "event_id")


def latest_feedback(feedback: DataFrame) -> DataFrame:
    tie = ["event_id"] if "event_id" in feedback.columns else []
    return latest_per_key(feedback, ["customer_id"], "recorded_at", tie)


class FeedbackLog:
    """What came of the calls, as a job keeps it below a shared folder.

    ``history`` has every event once, by date of the queue; ``latest`` is a versioned table
    of the newest outcome of each customer, derived from the events as they come.
    """

    def __init__(self, spark: SparkSession, root: str, table: str | None = None):
        self.spark, self.table = spark, table
        self.history_path = f"{root.rstrip('/')}/history"
        self.versions = Snapshots(spark, f"{root.rstrip('/')}/latest")
        self.store = Store(spark, f"feedback-{uuid.uuid4().hex}")

    def history(self, like: DataFrame | None = None) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.history_path)
        if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.read.parquet(self.history_path)
        if like is None:
            raise LookupError(f"no events below {self.history_path}")
        return like.limit(0)

    def latest(self) -> DataFrame:
        return self.versions.read()

    def record(self, batch: DataFrame, as_of: dt.date) -> DataFrame:
        """Take a batch in; returns the rejected rows with ``_violations``.

        Events have an ``event_id``, or get one from what they say.  Only events the history
        lacks count, so a batch may come twice; the history is asked for the dates of
        the batch alone.  The new version comes before the events are filed: a job that dies
        between them changes nothing when it runs again.
        """
        accepted, rejected = validate_feedback(identified(batch), as_of)
        accepted = self.store.scratch(accepted)
        dates = accepted.select("reference").distinct()
        known = self.history(accepted).join(F.broadcast(dates), "reference", "left_semi")
        fresh = self.store.scratch(survivors(
            accepted.join(known.select("event_id"), "event_id", "left_anti"),
            ["event_id"], [F.col(c) for c in accepted.columns]))
        version = self.versions.current()
        before = self.versions.read() if version else fresh.limit(0)
        self.versions.write(apply_feedback(before, fresh, ("event_id",)), after=version or 0)
        fresh.hint("rebalance", "reference").write.mode("append").partitionBy("reference").parquet(self.history_path)
        if self.table:
            point_table(self.spark, self.table, self.versions)
        self.versions.vacuum()
        return rejected


def identified(batch: DataFrame) -> DataFrame:
    """``batch`` with an ``event_id`` that the same event always has."""
    if "event_id" in batch.columns:
        return batch
    said = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(batch.columns)]))
    return batch.withColumn("event_id", F.sha2(said, 256))


def queue_with_feedback(
    queue: DataFrame, feedback: DataFrame, seller: str | None = None
) -> DataFrame:
    """The queue with the newest outcome of each customer, best score first.

    ``rank`` numbers the rows by the score before it is rounded for display; the
    queue is a list for people, of a length they can call.
    """
    last = latest_feedback(feedback).select(
        "customer_id", F.col("status").alias("feedback_status"),
        F.col("comment").alias("feedback_comment"), F.col("recorded_at").alias("feedback_at"),
        F.col("recorded_by").alias("feedback_by"),
    )
    return (
        optional_filter(queue, {"seller": seller}).join(last, "customer_id", "left")
        .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "customer_id")))
        .withColumn("score", F.round("score", 2))
        .withColumn("avg_ticket", F.round("avg_ticket", 2))
        .orderBy("rank")
    )


def seller_list(queue: DataFrame) -> DataFrame:
    """Calls and mean score per seller; the queue's scores have four decimals."""
    mean = F.avg(F.col("score").cast("decimal(9,4)"))
    return queue.groupBy("seller").agg(
        F.count(F.lit(1)).alias("contacts"), F.round(mean, 3).cast("double").alias("mean_score")
    ).orderBy(F.desc("contacts"), "seller")


def followup(queue: DataFrame, feedback: DataFrame) -> DataFrame:
    """Per seller: calls in the queue, worked, and each outcome."""
    last = latest_feedback(feedback).select("customer_id", "status")
    return (
        queue.select("seller", "customer_id").join(last, "customer_id", "left")
        .groupBy("seller").agg(
            F.count(F.lit(1)).alias("in_queue"), F.count("status").alias("worked"),
            *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        ).orderBy(F.desc("worked"), "seller")
    )


def followup_totals(per_seller: DataFrame) -> DataFrame:
    return per_seller.agg(
        *[F.sum(c).alias(c) for c in ("in_queue", "worked", *STATUSES)]
    )


def week_kpis(
    queue: DataFrame, feedback: DataFrame, metrics: DataFrame, seller: str | None = None,
    filter_feedback: bool = True,
) -> DataFrame:
    """One row: contacts, expected revenue, model quality, calls worked and sold.

    The latest metrics row and the feedback counts are read once each.  With
    ``filter_feedback`` the calls worked follow the seller filter as well.
    """
    calls = optional_filter(queue, {"seller": seller}).agg(
        F.count(F.lit(1)).alias("contacts"), F.countDistinct("seller").alias("sellers"),
        F.round(F.sum(F.col("score") * F.col("avg_ticket")), 2).alias("expected_revenue"),
    )
    quality = metrics.orderBy(F.desc("trained_at"), F.desc("version")).limit(1).select(
        "lift_top_k", "hits_top_k", F.round(F.col("base_rate") * 100, 2).alias("base_rate_pct")
    )
    made = optional_filter(feedback, {"seller": seller if filter_feedback else None}).agg(
        F.max("reference").alias("queue_reference"), F.count(F.lit(1)).alias("worked"),
        F.count_if(F.col("status") == SOLD).alias("sold"),
    )
    # one row each, put side by side; an untrained model leaves its columns empty
    trained, recorded = (df.select(F.struct("*")).scalar() for df in (quality, made))
    return calls.select(
        "*", *[trained[c].alias(c) for c in quality.columns],
        *[recorded[c].alias(c) for c in made.columns],
    ).withColumn(
        "expected_conversion_pct", safe_ratio("hits_top_k", "contacts", 100, 1)
    )
