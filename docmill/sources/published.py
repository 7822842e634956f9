"""Tables that are published together, version by version (SNK-01, SNK-04, SNK-08).

A version's tables are written to a folder of their own, which nobody reads until a small pointer file with
the version's number is put in place; that is the last step, and one rename. A run that fails before leaves
the version before it untouched, and a pointer that exists already means that another run was faster.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

WIDTH = 12


class Conflict(RuntimeError):
    """Another run has published since this one began."""


class Published:
    """Versions below a folder that driver and executors share: ``data/<version>-<run>/<table>`` and ``pointers/<version>``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(root).toUri() if "://" in root else self._fs.getUri(), conf)

    def versions(self) -> list[int]:
        """Numbers of the published versions, oldest first."""
        at = self._path(f"{self.root}/pointers")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int:
        """The version that counts; 0 if nothing was published."""
        return max(self.versions(), default=0)

    def _pointer(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.root}/pointers/{version:0{WIDTH}d}", wholetext=True).first()[0])

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table of a version, by default the one that counts."""
        version = version or self.version()
        return self.spark.read.parquet(f"{self.root}/data/{self._pointer(version)['folder']}/{name}")

    def publish(self, tables: dict[str, DataFrame], base: int) -> int:
        """Write tables as the version after base, which is version() as the run began, and move the pointer.

        Each table is opened again before the pointer moves. Raises Conflict if there is a later version than base.
        """
        folder = f"{base + 1:0{WIDTH}d}-{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/data/{folder}/{name}")
            self.spark.read.schema(df.schema).parquet(f"{self.root}/data/{folder}/{name}").limit(1).count()
        self._point(base + 1, folder, sorted(tables))
        return base + 1

    def _point(self, version: int, folder: str, names: list[str]) -> None:
        self._fs.mkdirs(self._path(f"{self.root}/pointers"))
        made, to = self._path(f"{self.root}/pointers/_{folder}"), self._path(f"{self.root}/pointers/{version:0{WIDTH}d}")
        out = self._fs.create(made, False)
        out.write(json.dumps({"folder": folder, "tables": names}).encode())
        out.close()
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = getattr(self.spark._jvm, "org.apache.hadoop.fs.Options$Rename").NONE
        try:
            self._context.rename(made, to, none)  # fails where the name is taken
        except Exception as e:
            self._fs.delete(made, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {version} of {self.root} was published by another run") from e
            raise

    def prune(self, keep: int = 2) -> None:
        """Delete all but the last versions that count, and what failed runs left; not while another run writes."""
        kept = self.versions()[-keep:]
        folders = {self._pointer(v)["folder"] for v in kept}
        for v in self.versions():
            if v not in kept:
                self._fs.delete(self._path(f"{self.root}/pointers/{v:0{WIDTH}d}"), False)
        for f in self._fs.listStatus(self._path(f"{self.root}/data")):
            if f.getPath().getName() not in folders:
                self._fs.delete(f.getPath(), True)
