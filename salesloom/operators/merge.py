"""Upsert on plain parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.operators.rank import latest_per_key, survivors


def merge_latest(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], ts: str,
    tie: Sequence[str] = (), keep_from_target: Sequence[str] = (),
) -> DataFrame:
    """Update matching keys, insert the others, one row per key.

    The newest row of a key wins, the target only against older updates, so the
    same batch merged twice gives the same table.  ``keep_from_target`` lists
    columns an update of an existing key leaves alone.  ``target`` has one row per
    key and the updates are reduced to that before the join, so no key is hot.
    """
    new = latest_per_key(updates, keys, ts, tie)
    columns = target.columns
    joined = target.withColumn("__in", F.lit(1)).alias("t").join(
        new.withColumn("__in", F.lit(1)).alias("u"),
        [F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys], "full_outer",
    )
    has_target = F.col("t.__in").isNotNull()
    has_update = F.col("u.__in").isNotNull()
    wins = has_update & (
        ~has_target | F.coalesce(F.col(f"u.{ts}") >= F.col(f"t.{ts}"), F.col(f"t.{ts}").isNull())
    )

    def pick(c: str) -> Column:
        if c in keep_from_target:
            return F.when(has_target, F.col(f"t.{c}")).otherwise(F.col(f"u.{c}")).alias(c)
        return F.when(wins, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    return joined.select(*[pick(c) for c in columns])


def append_history(history: DataFrame, batch: DataFrame, event_key: str) -> DataFrame:
    """All events ever seen, each once, so that a replayed batch changes nothing."""
    fresh = batch.join(history.select(event_key), event_key, "left_anti")
    return history.unionByName(survivors(fresh, [event_key], [F.col(c) for c in batch.columns]))
