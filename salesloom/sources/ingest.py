"""CSV extracts to text tables, with lineage and a reconciliation of the counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.sources.manifest import EXTRACTS

CORRUPT = "_corrupt_record"


class IngestError(RuntimeError):
    pass


def read_text_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Every column as text; nothing is inferred, empty fields are NULL.

    Quotes are doubled inside quotes; a record ends with its line, so files are
    split between tasks.  ``columns`` fixes the header order and skips the look
    at the file that finds it.
    """
    reader = (
        spark.read.option("header", "true").option("inferSchema", "false")
        .option("multiLine", "false").option("escape", '"')
    )
    if columns is not None:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns)).option(
            "enforceSchema", "false"
        )
    return reader.csv(path)


def ingest_csv(
    spark: SparkSession, root: str, system: str, table: str, ingested_at: dt.datetime | None = None
) -> DataFrame:
    """The extract as text plus when it was read and where it came from."""
    df = read_text_csv(spark, f"{root}/{system}/{table}.csv")
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return (
        df.withColumn("_ingested_at", stamp)
        .withColumn("_source_path", F.lit(f"{system}/{table}.csv"))
    )


def malformed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Lines that do not have as many fields as the header, kept for inspection."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    lines = (
        spark.read.option("header", "true").option("escape", '"').option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path)
    )
    return lines.where(F.col(CORRUPT).isNotNull())


def ingest_all(
    spark: SparkSession, root: str, extracts: Mapping[str, Sequence[str]] = EXTRACTS,
    ingested_at: dt.datetime | None = None,
) -> dict[str, DataFrame]:
    """Every extract of the manifest by table name."""
    return {
        table: ingest_csv(spark, root, system, table, ingested_at)
        for system, tables in extracts.items() for table in tables
    }


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(file, table_rows) of each table, counted in one job."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("table_rows")).select(
            F.lit(f"{name}.csv").alias("file"), "table_rows")
        for name, df in tables.items()
    ])


def reconcile_ingest(control: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows in the table against rows in the file; a missing side is a mismatch."""
    return control.select("file", F.col("rows").alias("file_rows")).join(
        counts, "file", "full_outer"
    ).withColumn("matches", F.coalesce(F.col("file_rows") == F.col("table_rows"), F.lit(False)))


def assert_reconciled(result: DataFrame) -> DataFrame:
    wrong = result.where(~F.col("matches")).collect()  # at most one row per file
    if wrong:
        raise IngestError("counts differ: " + "; ".join(
            f"{r['file']} file {r['file_rows']} table {r['table_rows']}" for r in sorted(wrong)
        ))
    return result
