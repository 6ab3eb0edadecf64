"""Running totals, ranks and quantiles over a whole table without one big task.

A window without a partition key sorts everything in one task.  Here the rows
are first grouped to one row per distinct value (ties then share a total, as
RANGE frames do) and dealt by ranges of the value.  Each range is summed on its own,
and the totals of the ranges before it are added as an offset.  Ranges are those of
one range shuffle, so there are as many as the session's shuffles have partitions,
and AQE merges what is small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.context import Store


def prefix_sum(
    store: Store,
    df: DataFrame,
    order: str,
    values: Mapping[str, Column],
    by: Sequence[str] = (),
    descending: bool = True,
    buckets: int | None = None,
    totals: bool = False,
) -> DataFrame:
    """One row per (by, order value) with ``<name>`` and ``<name>_running``.

    ``values`` maps a name to the aggregate to accumulate, e.g.
    ``{"revenue": F.sum("revenue")}``; with ``totals`` there is ``<name>_total`` of
    the group as well.  ``buckets`` sets the number of ranges.  NULL comes first in
    ascending order and last in descending.
    """
    direction = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()
    grouped = df.groupBy(*by, order).agg(*[v.alias(name) for name, v in values.items()])
    keys = [*[F.col(c) for c in by], direction]
    ranged = grouped.repartitionByRange(*([buckets] if buckets else []), *keys)
    # a range keeps its number by being written: every reader sees the same cuts
    held = store.scratch(ranged.withColumn("_range", F.spark_partition_id()))
    group = Window.partitionBy(*by)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (by, range)
    offsets = held.groupBy(*by, "_range").agg(*[F.sum(n).alias(f"_{n}") for n in values]).select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_range").alias("_at"),
        *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in values],
        *[F.sum(f"_{n}").over(group).alias(f"{n}_total") for n in values if totals],
    )
    within = Window.partitionBy(*by, "_range").orderBy(direction)
    match = F.col("_range") == F.col("_at")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return (
        held.select("*", *[F.sum(n).over(within).alias(f"_{n}_within") for n in values])
        .join(offsets, match)
        .select(
            *by, order, *values,
            *[(F.col(f"_{n}_within") + F.col(f"_{n}_before")).alias(f"{n}_running")
              for n in values],
            *[f"{n}_total" for n in values if totals],
        )
    )


def abc_classes(
    store: Store, df: DataFrame, key: str, measure: Column,
    cuts: Sequence[float] = (0.80, 0.95), labels: Sequence[str] = ("A", "B", "C"), **how,
) -> DataFrame:
    """Pareto class per key by its share of the running total.

    ``measure`` is an aggregate.  The key that crosses a cut belongs to the next
    class, equal measures share a class, and with negative measures the running
    share may pass 1 before it comes back.
    """
    # stored, as both readers must see the same sums
    totals = store.scratch(df.groupBy(key).agg(measure.alias("total")))
    running = prefix_sum(store, totals, "total", {"part": F.sum("total")}, totals=True, **how)
    share = F.col("part_running").cast("double") / F.nullif(F.col("part_total").cast("double"), F.lit(0.0))
    chain = F.when(share <= cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        chain = chain.when(share <= cut, label)
    classes = running.select(
        F.col("total").alias("_total"), share.alias("running_share"),
        chain.otherwise(labels[-1]).alias("abc_class"),
    )
    return totals.join(classes, F.col("total").eqNullSafe(F.col("_total")), "left").select(
        key, "total", "running_share", "abc_class"
    )


def dense_rank_by(
    store: Store, df: DataFrame, by: Sequence[str], order: str, out: str = "rank", **how,
) -> DataFrame:
    """``dense_rank`` per ``by`` in descending ``order`` that survives huge groups.

    ``df`` is read more than once and should be a stored table.
    """
    ranks = prefix_sum(store, df, order, {"one": F.lit(1)}, by=by, **how).select(
        *[F.col(c).alias(f"_{c}") for c in by], F.col(order).alias("_order"),
        F.col("one_running").cast("int").alias(out),
    )
    match = F.col(order).eqNullSafe(F.col("_order"))
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(ranks, match, "left").drop(*[f"_{c}" for c in by], "_order")


def quantile_edges(
    store: Store, df: DataFrame, col: str, probs: Sequence[float], **how
) -> DataFrame:
    """Exact quantiles with linear interpolation as one row ``q0, q1, …``.

    Order statistics are read off the running counts; nothing holds all the
    distinct values in one task as ``percentile`` would.
    """
    runs = prefix_sum(
        store, df.where(F.col(col).isNotNull()), col, {"n": F.count(F.lit(1))},
        descending=False, totals=True, **how,
    )

    def position(p: float) -> Column:
        return (F.col("n_total") - 1) * F.lit(float(p))

    def value_at(index: Column) -> Column:
        return F.min(F.when(F.col("n_running") > index, F.col(col).cast("double")))

    picked = runs.agg(
        F.max("n_total").alias("n_total"),
        *[value_at(F.floor(position(p))).alias(f"_lo{i}") for i, p in enumerate(probs)],
        *[value_at(F.ceil(position(p))).alias(f"_hi{i}") for i, p in enumerate(probs)],
    )
    return picked.select(*[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}"))
         * (position(p) - F.floor(position(p)))).alias(f"q{i}")
        for i, p in enumerate(probs)
    ])


def hash_rank(
    df: DataFrame, key: str, seed: int, by: Sequence[str] = (), out: str = "hash_rank",
    prefix_digits: int = 3,
) -> DataFrame:
    """A seeded random order per ``by``, numbered from 1, plus the group size.

    Rows are ordered by ``md5(key|seed)``.  The leading digits of a hash are
    uniform, so they cut every group into equal buckets that are numbered apart
    and shifted by the counts of the buckets before them.  ``prefix_digits`` = 3
    makes 4096 buckets a group, right for some 400 million rows; each digit more
    serves sixteen times as many.  The order does not depend on it.
    """
    hashed = df.withColumn(
        "_h", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    ).withColumn("_b", F.substring("_h", 1, prefix_digits))
    w_all = Window.partitionBy(*by)
    w_before = w_all.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        hashed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_b").alias("_at"),
            F.coalesce(F.sum("_n").over(w_before), F.lit(0)).alias("_before"),
            F.sum("_n").over(w_all).alias("_size"),
        )
    )
    match = F.col("_b") == F.col("_at")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    local = F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h", key))
    return (
        hashed.withColumn("_local", local).join(sizes, match)
        .select(*df.columns, (F.col("_local") + F.col("_before")).alias(out),
                F.col("_size").alias(f"{out}_size"))
    )
