"""Incremental state: what is new, changed, unchanged or gone since the last run."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def change_status(current: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """(key, status, content_hash, previous_hash) from content hashes (INC-01)."""
    old = state.select(key, F.col("content_hash").alias("previous_hash"))
    status = F.when(F.col("previous_hash").isNull(), "new").when(F.col("previous_hash") == F.col("content_hash"), "unchanged").otherwise("changed")
    return current.select(key, "content_hash").join(old, key, "left").select(key, status.alias("status"), "content_hash", "previous_hash")


def compare(candidate: DataFrame, published: DataFrame, key: str, body: str) -> DataFrame:
    """(key, action) of each candidate: created, updated or unchanged, byte by byte (INC-02)."""
    old = published.select(key, F.col(body).alias("old"), F.lit(True).alias("there"))
    action = F.when(F.col("there").isNull(), "created").when(F.col(body).eqNullSafe(F.col("old")), "unchanged").otherwise("updated")
    return candidate.select(key, body).join(old, key, "left").select(key, action.alias("action"))


def file_status(listing: DataFrame, state: DataFrame) -> DataFrame:
    """(id, status): what a run does to listed and known files (JOI-06, FLT-07); the rows that it leaves are those of file_tree.next_state().

    listing: id, modified, slug, hash, duplicate (what a checker said; null: no), error. Cheap tests come
    first: a file with the same time and slug is skipped without looking at its text.
    """
    old = state.select("id", F.col("modified").alias("old_modified"), F.col("slug").alias("old_slug"), F.col("hash").alias("old_hash"), F.lit(True).alias("known"))
    both = listing.withColumn("listed", F.lit(True)).join(old, "id", "full_outer")
    status = (
        F.when(F.col("listed").isNull(), "deleted")
        .when(F.col("known") & (F.col("modified") == F.col("old_modified")) & (F.col("slug") == F.col("old_slug")), "unchanged")
        .when(F.col("error").isNotNull(), "error")
        .when(F.col("known") & (F.col("hash") == F.col("old_hash")), "synchronized")
        .when(F.coalesce("duplicate", F.lit(False)), "skipped (duplicate)")
        .otherwise("candidate")
    )
    return both.select("id", status.alias("status"))


def stream_hash(df: DataFrame, by: list[str], order: list[str], value: str, separator: str) -> DataFrame:
    """(by, n, length, hash): rows, characters and SHA-256 of each group's values in order, joined by separator; null values are left out.

    Each group is sorted by Spark and goes through the hash row by row, so that no array or string holds a group.
    The hash of a joined text is sequential: one task still reads each group once.
    """
    fields = [df.schema[c] for c in by]
    schema = T.StructType([*fields, T.StructField("n", T.LongType()), T.StructField("length", T.LongType()), T.StructField("hash", T.StringType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, types = None, None
        n, length, digest, first = 0, 0, hashlib.sha256(), True

        def done() -> pa.RecordBatch:
            values = [pa.array([k], t) for k, t in zip(key, types, strict=True)]
            return pa.RecordBatch.from_arrays([*values, pa.array([n], pa.int64()), pa.array([length], pa.int64()), pa.array([digest.hexdigest()], pa.string())], names=schema.names)

        for b in batches:
            types = [b.schema.field(k).type for k in range(len(by))]
            keys = zip(*[b.column(k).to_pylist() for k in range(len(by))], strict=True)
            for now, run in groupby(zip(keys, b.column(len(by)).to_pylist(), strict=True), key=lambda x: x[0]):
                if now != key:
                    if key is not None:
                        yield done()
                    key, n, length, digest, first = now, 0, 0, hashlib.sha256(), True
                for _, v in run:
                    n += 1
                    if v is not None:
                        one = v if first else separator + v
                        first = False
                        length += len(one)
                        digest.update(one.encode())
        if key is not None:
            yield done()

    dealt = df.repartition(*by).sortWithinPartitions(*by, *order)
    return dealt.select(*by, value).mapInArrow(rows, schema)


def set_hash(df: DataFrame, by: list[str], key: str, value: str) -> DataFrame:
    """Order-insensitive hash of key:value pairs per group (AGG-08)."""
    pairs = F.concat_ws(":", F.col(key).cast("string"), F.col(value).cast("string"))
    return stream_hash(df.select(*by, pairs.alias("_pair")), by, ["_pair"], "_pair", "|").select(*by, F.col("hash").alias("set_hash"))


def list_hash(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Order-sensitive hash of values per group (AGG-09)."""
    values = df.select(*by, F.col(order).alias("_order"), F.col(value).alias("_by"), F.col(value).cast("string").alias("_value"))
    return stream_hash(values, by, ["_order", "_by"], "_value", "\n").select(*by, F.col("hash").alias("list_hash"))


# Decisions in order of severity.
SEVERITY = ("no_change", "auto_merge", "requires_review", "rejected", "error")


def worst(decisions: DataFrame, by: list[str], decision: str = "decision") -> DataFrame:
    """The most severe decision of each group (AGG-10)."""
    rank = F.array_position(F.array(*[F.lit(x) for x in SEVERITY]), F.col(decision))
    return decisions.groupBy(*by).agg(F.max_by(decision, rank).alias("decision"), F.count("*").alias("n_documents"))


def ladder(*steps: tuple[Column, str]) -> Column:
    """The first decision whose condition holds (RUL-05)."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for condition, decision in steps:
        out = out.when(condition, decision)
    return out
