"""Has everything arrived?  One listing and one counting pass for all files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.sources.manifest import EXTRACTS

MISSING = -1


class ArrivalError(RuntimeError):
    pass


# <system>/<name>.csv, a file or a folder of part files, plain or compressed
_EXTRACT = r"/([^/]+)/([^/]+\.csv)(\.gz|\.bz2)?(/[^/]+)?$"
_FILES = "*.{csv,csv.gz,csv.bz2}"


def _named(path) -> list:
    """System and extract a path belongs to."""
    return [F.regexp_extract(path, _EXTRACT, i).alias(n) for i, n in ((1, "system"), (2, "file"))]


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """(system, file, bytes) of the extracts below ``root``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _FILES).load(root)
    )
    return files.groupBy(*_named(F.col("path"))).agg(F.sum("length").alias("bytes"))


def present(spark: SparkSession, root: str, extracts: Mapping[str, Sequence[str]] = EXTRACTS) -> DataFrame:
    """(system, file, there) of the expected files; a listing leaves out empty ones, so each is asked for."""
    def there(name: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return any(fs.exists(path.suffix(end)) for end in ("", ".gz", ".bz2"))

    return spark.createDataFrame(
        [(system, f"{name}.csv", there(f"{system}/{name}.csv")) for system, names in extracts.items() for name in names],
        "system string, file string, there boolean")


def file_rows(spark: SparkSession, root: str) -> DataFrame:
    """(system, file, rows) of the extracts below ``root``, headers not counted.

    One scan over all files; large files are split between tasks.
    """
    lines = (
        spark.read.schema("first string").option("header", "true")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", _FILES).csv(root)
    )
    per_file = lines.groupBy(F.col("_metadata.file_path").alias("_path")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_file.groupBy(*_named(F.col("_path"))).agg(F.sum("n").alias("rows"))


def probe(
    spark: SparkSession, root: str, checked_at: dt.datetime,
    extracts: Mapping[str, Sequence[str]] = EXTRACTS,
) -> DataFrame:
    """Control table: every expected file with bytes and rows.

    A file that is not there has -1 bytes and -1 rows, one without data rows 0.
    """
    key = ["system", "file"]
    found = present(spark, root, extracts).join(file_sizes(spark, root), key, "left").join(
        file_rows(spark, root), key, "left"
    )
    absent = F.when(F.col("there"), 0).otherwise(MISSING)
    size = F.coalesce("bytes", absent).cast("bigint")
    rows = F.coalesce("rows", F.when(F.col("bytes").isNull(), absent).otherwise(0))
    return found.select(
        *key, size.alias("bytes"), rows.cast("bigint").alias("rows"),
        F.lit(checked_at.isoformat(timespec="seconds")).alias("checked_at"),
    )


def judge(control: DataFrame) -> DataFrame:
    """Add ``verdict``: missing, empty, header only or ok; nothing is raised."""
    return control.withColumn("verdict", F.when(F.col("bytes") == MISSING, "missing").when(
        F.col("bytes") == 0, "empty").when(F.col("rows") <= 0, "header only").otherwise("ok"))


# fixed values: how the complaint names a verdict
COMPLAINTS = {"missing": "missing or empty", "empty": "missing or empty", "header only": "no data rows"}


def check_arrival(control: DataFrame) -> DataFrame:
    """Raise with every file that is missing, empty or has only a header."""
    late = judge(control).where("verdict <> 'ok'").collect()
    if late:  # at most as many rows as the manifest has files
        raise ArrivalError("; ".join(
            f"{r['system']}/{r['file']}: {COMPLAINTS[r['verdict']]}" for r in sorted(late)))
    return control


def arrival_summary(control: DataFrame) -> DataFrame:
    """Files, data rows and megabytes, one row."""
    return control.agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("data_rows"),
        F.round(F.sum("bytes") / 1024 / 1024, 1).alias("megabytes"),
    )
