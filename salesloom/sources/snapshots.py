"""Versioned tables in a shared folder: a version is written aside, then made the current one.

``<root>/data`` holds a folder for each attempt to write a version, ``<root>/commits`` a
file for each version that names its folder.  A commit file is created exclusively, so
of two writers of the same version one fails; a reader sees the version before or
after it and never a part, and a write that fails leaves the current one as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from salesloom.context import write_parquet


class Conflict(RuntimeError):
    """Another writer was first."""


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> dict[int, str]:
        """Folder of every version, oldest first."""
        path, fs = self._path("commits")
        if not fs.exists(path):
            return {}
        found = {}
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            # an empty file is a commit that was not finished: its number is not used again
            if name.isdigit() and status.getLen():
                stream = fs.open(status.getPath())
                try:
                    found[int(name)] = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                finally:
                    stream.close()
        return dict(sorted(found.items()))

    def current(self) -> int | None:
        return max(self.versions(), default=None)

    def folder(self, version: int | None = None) -> str:
        known = self.versions()
        if not known:
            raise LookupError(f"no version below {self.root}")
        return f"{self.root}/data/{known[max(known) if version is None else version]}"

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.folder(version))

    def write(self, df: DataFrame, partition_by: Sequence[str] = (), after: int | None = None) -> int:
        """Write ``df`` as the next version and make it current.

        ``df`` may read the current version.  ``after`` names the version that ``df`` was
        made of; if it is no longer the current one, nothing is written and it raises.
        """
        if after is not None and after != (self.current() or 0):
            raise Conflict(f"{self.root} is at {self.current()}, not {after}")
        number = self._last_number() + 1 if after is None else after + 1
        attempt = f"{number:08d}-{uuid.uuid4().hex}"
        write_parquet(df, f"{self.root}/data/{attempt}", partition_by)
        path, fs = self._path("commits", f"{number:08d}")
        try:
            stream = fs.create(path, False)
        except Exception as error:
            raise Conflict(f"version {number} of {self.root} was written by another") from error
        try:
            stream.write(bytearray(attempt.encode()))
        finally:
            stream.close()
        return number

    def _last_number(self) -> int:
        path, fs = self._path("commits")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return max((int(n) for n in names if n.isdigit()), default=0)

    def vacuum(self, keep: int = 2) -> None:
        """Forget all versions but the last ``keep``, and delete folders that none names."""
        known = self.versions()
        kept = dict(list(known.items())[-keep:])
        for number in known.keys() - kept.keys():
            path, fs = self._path("commits", f"{number:08d}")
            fs.delete(path, False)
        path, fs = self._path("data")
        for status in fs.listStatus(path) if fs.exists(path) else []:
            if status.getPath().getName() not in kept.values():
                fs.delete(status.getPath(), True)
