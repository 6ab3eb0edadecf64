"""Survivorship, latest row, top rows and gaps per key.

All "first row per key" operators filter ``row_number() = 1``; Catalyst turns
that into a window group limit that keeps one row per key on the map side, so a
key holding a third of the input is cut down before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
    rank_col: str | None = None,
) -> DataFrame:
    """The first ``n`` rows per key; ``order`` must end in a unique tie-break."""
    name = rank_col or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= n)
    return kept if rank_col else kept.drop(name)


def survivors(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return top_per_key(df, keys, order, 1)


def survivor_map(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], id_col: str
) -> DataFrame:
    """Every id with the id that survived in its place.

    The survivors are joined back on the key instead of taking a first value
    over the whole group: AQE can split a hot key in a join, not in a window.
    """
    canonical = survivors(df.select(*keys, id_col, *_order_inputs(df, keys, id_col)), keys, order)
    canonical = canonical.select(*keys, F.col(id_col).alias("canonical_id"))
    return (
        df.select(id_col, *keys).join(canonical, list(keys))
        .select(F.col(id_col).alias("id"), "canonical_id")
    )


def _order_inputs(df: DataFrame, keys: Sequence[str], id_col: str) -> list[str]:
    return [c for c in df.columns if c not in {*keys, id_col}]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key."""
    return top_per_key(df, keys, [F.col(ts).desc_nulls_last(), *[F.col(t).desc() for t in tie]])


def gaps(df: DataFrame, keys: Sequence[str], date: str, out: str = "gap_days") -> DataFrame:
    """Days since the previous distinct date of the key, NULL on the first one.

    ``df`` must hold one row per key and date; a key then has at most as many
    rows as the calendar has days, whatever the number of orders behind them.
    """
    w = Window.partitionBy(*keys).orderBy(date)
    return df.withColumn(out, F.datediff(F.col(date), F.lag(date).over(w)).cast("double"))
