"""Row contracts and table checks.

Row contracts are predicates every row has to satisfy before a write; as with a
SQL CHECK, a NULL result passes.  Table checks are aggregates with an allowed
interval; all checks on one table share one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A named row predicate in SQL."""

    name: str
    predicate: str

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(True))


def enforce(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Pass rows through and abort the job on the first that breaks a contract."""
    for check in checks:
        df = df.where(
            F.when(check.holds(), F.lit(True)).otherwise(
                F.raise_error(F.lit(f"contract {check.name} broken: {check.predicate}"))
                .cast("boolean")
            )
        )
    return df


def violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add ``_violations``, the names of the broken contracts of each row."""
    return df.withColumn(
        "_violations",
        F.array_compact(F.array(*[F.when(~c.holds(), F.lit(c.name)) for c in checks])),
    )


def quarantine(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that do not with ``_violations``)."""
    marked = violations(df, checks)
    return (
        marked.where(F.size("_violations") == 0).drop("_violations"),
        marked.where(F.size("_violations") > 0),
    )


def violation_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows seen and rows broken per contract, in one pass over ``df``."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~c.holds()).alias(f"_{i}") for i, c in enumerate(checks)],
    )
    pairs = F.array(*[
        F.struct(F.lit(c.name).alias("contract"), F.col(f"_{i}").alias("broken"))
        for i, c in enumerate(checks)
    ])
    return counted.select(F.col("_rows").alias("row_count"), F.inline(pairs))


@dataclass(frozen=True)
class TableCheck:
    """An aggregate of one table with the closed interval it has to fall in."""

    name: str
    observed: Column
    low: float
    high: float


def check_table(df: DataFrame, checks: Sequence[TableCheck]) -> DataFrame:
    """One row per check: check, observed, low, high, passed."""
    measured = df.agg(*[c.observed.cast("double").alias(f"_{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(
            F.lit(c.name).alias("check"), F.col(f"_{i}").alias("observed"),
            F.lit(float(c.low)).alias("low"), F.lit(float(c.high)).alias("high"),
        )
        for i, c in enumerate(checks)
    ])
    return judge(measured.select(F.inline(rows)))


def judge(rows: DataFrame) -> DataFrame:
    """Add ``passed``; an aggregate that is NULL does not pass."""
    return rows.withColumn(
        "passed", F.coalesce(F.col("observed").between(F.col("low"), F.col("high")), F.lit(False))
    )


class ChecksFailed(AssertionError):
    pass


def assert_passed(result: DataFrame) -> DataFrame:
    """Raise with every failed check; the result holds one row per check."""
    failed = result.where(~F.col("passed")).collect()
    if failed:
        raise ChecksFailed("; ".join(
            f"{r['check']}: observed {r['observed']}, allowed [{r['low']}, {r['high']}]"
            for r in failed
        ))
    return result
