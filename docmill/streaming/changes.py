"""Change detection over a stream of landed texts: each micro-batch is compared with the state that the last one left.

Not a windowed operator; there is no event time in it. The state is a table of one row per key, written anew
after a batch's result into the folder of its number, so a batch that fails is compared with the same state as before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docmill.functions import keys
from docmill.operators import sync


def watch(stream: DataFrame, key: str, body: str, out: str, state: str, checkpoint: str) -> StreamingQuery:
    """Append (key, status, content_hash, batch) of every batch to out; the last folder batch=... of state holds one row per key."""

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        now = rows.groupBy(key).agg(F.max_by(body, keys.content_hash(F.col(body))).alias(body)).select(key, keys.content_hash(F.col(body)).alias("content_hash"))
        try:
            before = spark.read.parquet(state).where(F.col("batch") < number)
            # one number; the folders' names tell it
            last = before.agg(F.max("batch").alias("last")).first().last
            known = before.where(F.col("batch") == F.lit(last)).select(key, "content_hash")
        except AnalysisException as e:  # the first batch finds no state
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = now.limit(0)
        result = sync.change_status(now, known, key).withColumn("batch", F.lit(number))
        result.write.mode("overwrite").parquet(f"{out}/batch={number}")
        known.join(now.select(key), key, "left_anti").unionByName(now).write.mode("overwrite").parquet(f"{state}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
