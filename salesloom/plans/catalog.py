"""Comments on tables and columns, and the audit that they are there."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: status of a table in the coverage report
WITHOUT_COMMENT = "SEM COMMENT"
WITH_COMMENT = "OK"

COVERAGE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("is_view", T.BooleanType(), False),
    T.StructField("table_comment", T.StringType(), True),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("column_comment", T.StringType(), True),
])


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments that ``saveAsTable`` carries into the catalog."""
    return df.select(*[
        F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": comments[c]})
        if c in comments else F.col(c)
        for c in df.columns
    ])


def apply_comments(
    spark: SparkSession, table: str, comment: str | None, columns: Mapping[str, str] | None = None
) -> None:
    """Comment an existing table and its columns."""
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(comment)}")
    for name, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{name}` COMMENT {_quoted(text)}")


def create_view(
    spark: SparkSession, name: str, query: str, comment: str, columns: Mapping[str, str]
) -> None:
    """A persistent view over saved tables; ``columns`` in output order with comments."""
    listed = ", ".join(f"`{c}` COMMENT {_quoted(t)}" for c, t in columns.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} ({listed}) COMMENT {_quoted(comment)} AS {query}")


def metadata(spark: SparkSession, database: str) -> DataFrame:
    """One row per column of the database with its and its table's comment.

    Metadata only: its size is the number of columns of the catalog.
    """
    rows = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        full = f"{database}.{table.name}"
        rows += [
            (table.name, table.tableType == "VIEW", table.description, c.name, c.description)
            for c in spark.catalog.listColumns(full)
        ]
    return spark.createDataFrame(rows, COVERAGE_SCHEMA)


def _blank(c: str):
    return F.coalesce(F.trim(F.col(c)) == "", F.lit(True))


def comment_coverage(meta: DataFrame) -> DataFrame:
    """Per table: whether it has a comment, columns with and without one."""
    return meta.groupBy("table_name").agg(
        F.when(F.max(_blank("table_comment")), WITHOUT_COMMENT).otherwise(WITH_COMMENT)
        .alias("table_status"),
        F.count(F.lit(1)).alias("column_count"),
        F.count_if(~_blank("column_comment")).alias("commented"),
        F.count_if(_blank("column_comment")).alias("uncommented"),
    ).orderBy(F.desc("uncommented"), "table_name")


class AuditFailed(AssertionError):
    pass


def audit(coverage: DataFrame, fully_commented: Sequence[str] = ()) -> DataFrame:
    """Raise if a table has no comment or a listed table a column without one."""
    broken = coverage.where(
        (F.col("table_status") != WITH_COMMENT)
        | (F.col("table_name").isin(*fully_commented) & (F.col("uncommented") > 0))
        if fully_commented else F.col("table_status") != WITH_COMMENT
    ).collect()
    if broken:
        raise AuditFailed("; ".join(
            f"{r['table_name']}: table {r['table_status']}, {r['uncommented']} columns without"
            for r in broken
        ))
    return coverage
