"""Session settings that every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: UTC keeps timestamp text equal on every machine; ANSI mode stays on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def build(master: str | None = None, shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; on a cluster leave master and shuffle_partitions to spark-submit."""
    builder = SparkSession.builder.appName("docmill")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in more.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which driver and executors share (spark.checkpoint.dir).

    Only a session on one machine that names none, as in tests, gets a folder of that machine.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="docmill-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again, so that no plan grows from round to round and lost executors cost nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
