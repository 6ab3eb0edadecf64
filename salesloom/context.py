"""Where the tables of a run come from and where shared results are written.

``Ctx`` maps canonical table names to DataFrames and carries the dates a run is
pinned to; nothing in the package reads the wall clock.  ``Store`` writes a
result once to the shared folder of the cluster and hands out the parquet, so
that plans with several readers of one result scan files (column pruned,
partition pruned, no lineage to replay when an executor is lost).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings a session should carry; all of them leave sizing to AQE.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app_name: str = "salesloom", **conf: str) -> SparkSession:
    """A session with the package's settings; ``conf`` adds to or overrides them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SHUFFLE_BYTES = 256 * 1024 * 1024  # aim of a shuffle partition
SHUFFLE_GROWTH = 2  # shuffled rows take about twice the space of compressed parquet


def size_shuffles(spark: SparkSession, *paths: str, partition_bytes: int = SHUFFLE_BYTES) -> int:
    """Raise the initial number of shuffle partitions to what the input needs.

    AQE merges partitions that turn out small but cannot cut ordinary ones, so
    the starting number has to suit the largest shuffle, about the size of the
    largest input.  ``partition_bytes`` is the aim for one partition; whoever wants
    fewer of them raises it.  Returns the number in effect; it is never lowered.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    total = files.agg(F.sum("length")).first()[0] or 0  # a listing, contents are not read
    wanted = math.ceil(total * SHUFFLE_GROWTH / partition_bytes)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return max(wanted, current)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's code to the executors, once an application.

    Functions that run there import it, and executors need not have it installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(
        os.path.realpath(tempfile.mkdtemp(prefix="salesloom-code-")), "salesloom-code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


_own_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent and the whole session is one machine, each
    application gets one temporary folder of its own.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _own_roots:
        _own_roots[app] = tempfile.mkdtemp(prefix="salesloom-")
    return _own_roots[app]


class Store:
    """Results written once per application and scope, then read back as parquet."""

    _written: dict[tuple[str, str], str] = {}

    def __init__(self, spark: SparkSession, scope: str = "default"):
        self.spark = spark
        self.scope = scope.strip("/").replace("/", "_")
        self.app = spark.sparkContext.applicationId

    def _root(self) -> str:
        return f"{shared_root(self.spark)}/salesloom/{self.app}/{self.scope}"

    def table(
        self, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write ``build()`` under ``name`` unless this application already did."""
        key = (self.app, f"{self.scope}/{name}")
        if key not in self._written:
            path = f"{self._root()}/{name}"
            write_parquet(build(), path, partition_by)
            self._written[key] = path
        return self.spark.read.parquet(self._written[key])

    def scratch(self, df: DataFrame) -> DataFrame:
        """Write an intermediate that the caller reads more than once."""
        path = f"{self._root()}/scratch/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


    def clear(self) -> None:
        """Delete what this scope has written; frames that read it end with it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._root())
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        mine = f"{self.scope}/"
        for key in [k for k in self._written if k[0] == self.app and k[1].startswith(mine)]:
            del self._written[key]


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite ``path``; partition columns get AQE-sized files.

    The rebalance hint lets AQE merge thin partition values and split fat ones,
    so one month holding a third of the rows is written by many tasks.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(
            *partition_by
        ).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


class Ctx:
    """Canonical tables by name, built on first use, plus the dates of the run.

    ``as_of``  "today" of views, queue and table functions.
    ``train_as_of``  cut date of the training set.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, DataFrame | Callable[[Ctx], DataFrame]],
        as_of: dt.date,
        train_as_of: dt.date | None = None,
        store: Store | None = None,
    ):
        self.spark = spark
        self.as_of = as_of
        self.train_as_of = train_as_of or as_of
        self.store = store or Store(spark, uuid.uuid4().hex)
        self._builders = dict(tables)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            source = self._builders[name]
            self._built[name] = source if isinstance(source, DataFrame) else source(self)
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        return name in self._builders

    def with_tables(self, **tables: DataFrame | Callable[[Ctx], DataFrame]) -> Ctx:
        """The same run with some tables replaced or added (in a store of its own)."""
        return Ctx(
            self.spark, {**self._builders, **tables}, self.as_of, self.train_as_of,
            Store(self.spark, uuid.uuid4().hex),
        )
