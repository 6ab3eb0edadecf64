"""What the operators share: tables, stored intermediates, word rules."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import Store
from salesloom.context import ship as ship_package

WHITE = r"[\x20\x09-\x0D]"
TOKENIZERS = "/opt/tokenizers"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 1000  # texts are long: so many of them go to a Python task at a time, at most
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package's code to the executors, once an application.

    The session's Arrow batches are cut to ``BATCH_ROWS``, if they are larger, which
    bounds what a task holds on both sides.
    """
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    ship_package(spark)


def stored(df: DataFrame) -> DataFrame:
    """Write an intermediate that is read more than once to the shared folder.

    The written files cut the lineage, so a lost executor costs a rescan, and
    give the planner true sizes.
    """
    return Store(df.sparkSession, "llm").scratch(df)


def column(df: DataFrame, name: str, kind: str) -> Column:
    """A column of the input, or NULL where the table has none of that name."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
