"""What the operators share: reading a table, shared scratch space, column names that can't clash."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from docmill.sources.tables import table

__all__ = ["Space", "fresh", "remove", "scratch", "slices", "stage", "table"]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    A session on one machine that names none, as in tests, gets a folder of that machine; one on a cluster
    raises, since its executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = found.get() if found.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="docmill-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root}/docmill-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df as Parquet to scratch space and read it again: lineage ends here, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch space."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Space:
    """Written tables of one computation, which go when it is done with them."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self.paths = spark, scratch(spark, name), {}

    def write(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        """df written below the space's folder and read again; see stage()."""
        path = f"{self.root}/{len(self.paths)}-{name}"
        schema = df.schema
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no plan still to run reads."""
        for df in tables:
            remove(self.spark, self.paths[id(df)][1])


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """batches cut so that no piece of several rows holds more than size bytes in a column of texts; longer texts stand alone."""
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for k, n in enumerate(lengths.tolist()):
            if held and held + n > size:
                yield b.slice(first, k - first)
                first, held = k, 0
            held += n
        if b.num_rows > first:
            yield b.slice(first)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of df has it (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
