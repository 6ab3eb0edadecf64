"""Saved tables: full refresh, partitioned sinks, tables a run must not wipe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from salesloom.context import Store
from salesloom.plans.catalog import with_comments
from salesloom.sources.snapshots import Snapshots


class MissingTables(LookupError):
    pass


def write_table(
    df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
    comments: Mapping[str, str] | None = None,
) -> None:
    """Save ``df`` as a parquet table; an overwrite may change its schema.

    Partitioned writes are rebalanced by AQE, so that partition values get
    files of even size however the rows are spread over them.
    """
    if comments:
        df = with_comments(df, comments)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").mode(mode)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def point_table(spark: SparkSession, name: str, snapshots: Snapshots) -> None:
    """Make a table of the catalog show the current version of ``snapshots``.

    One change of its location; readers by name see the version before or this one.
    Columns added since are added, others have to stay as they are.
    """
    folder = snapshots.folder()
    schema = spark.read.parquet(folder).schema
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{folder}'")
        return
    known = {f.name: f.dataType for f in spark.table(name).schema}
    if any(f.name in known and known[f.name] != f.dataType for f in schema) or set(known) - set(schema.names):
        raise ValueError(f"{name} can't show columns that changed: {known} / {schema.simpleString()}")
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def replace_table(df: DataFrame, name: str, store: Store | None = None, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table with a result that may be computed from it, without a gap.

    The rows become a version in a folder of the table's own beside the database; only
    then does the table show them, so a write that fails leaves the old rows.  A
    partitioned table, whose partitions the catalog keeps one by one, is written
    anew from ``store`` instead.
    """
    spark = df.sparkSession
    if partition_by:
        write_table((store or Store(spark, "replace")).scratch(df), name, partition_by=partition_by)
        return
    database, _, short = name.rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    snapshots = Snapshots(spark, f"{place}/_versions/{short}")
    snapshots.write(df)
    point_table(spark, name, snapshots)


def write_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, sort_by: Sequence[str] = ()
) -> None:
    """Save hash-bucketed by ``key``; joins of such tables on it need no shuffle."""
    writer = df.write.format("parquet").mode("overwrite").bucketBy(buckets, key)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.saveAsTable(name)


def ensure_table(
    spark: SparkSession, name: str, schema: str, comments: Mapping[str, str] | None = None
) -> DataFrame:
    """Create an empty table unless it is there; what is in it stays."""
    columns = []
    for field in schema.split(","):
        column = field.split()[0]
        text = (comments or {}).get(column)
        quoted = " COMMENT '" + text.replace("'", "\\'") + "'" if text else ""
        columns.append(field.strip() + quoted)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet")
    return spark.table(name)


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Raise with every table or view that is not in the catalog."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise MissingTables(f"run the earlier steps first, missing: {', '.join(missing)}")


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
