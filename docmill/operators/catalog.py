"""Catalog against index: matching by two keys, what is missing, counters, guards, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _last(index: DataFrame, key: str, name: str) -> DataFrame:
    """The last index row of each key, as one struct."""
    return index.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct("path", "title"), "pos").alias(name))


def match(active: DataFrame, index: DataFrame) -> DataFrame:
    """active (title_key, slug, ...) with index_path, index_title and status (JOI-01): the title decides, else the slug.

    Two equi-joins, never one with OR. Where both keys fail the row is new and gets the path of its slug.
    """
    both = active.join(_last(index, "title_key", "by_title"), "title_key", "left").join(_last(index, "slug", "by_slug"), "slug", "left")
    hit = F.coalesce("by_title", "by_slug")
    return both.select(*active.columns, F.when(hit.isNull(), "new_unindexed").otherwise("indexed").alias("status"), hit["path"].alias("index_path"), hit["title"].alias("index_title"))


def missing(index: DataFrame, matched: DataFrame) -> DataFrame:
    """Index rows that no active row was matched with (JOI-02, JOI-03)."""
    return index.join(matched.where("index_path IS NOT NULL").select(F.col("index_path").alias("path")).distinct(), "path", "left_anti")


def counters(matched: DataFrame, gone: DataFrame) -> DataFrame:
    """One row: active, matched, new, missing (AGG-02)."""
    a = matched.agg(F.count("*").alias("active"), F.count_if(F.col("status") == "indexed").alias("matched"), F.count_if(F.col("status") == "new_unindexed").alias("new"))
    return a.crossJoin(gone.agg(F.count("*").alias("missing")))  # one row each


def retire(active: DataFrame, gone: DataFrame) -> DataFrame:
    """gone with what to do about each row (INC-06): retire it, unless more would go than are active, or none is active at all."""
    n = active.agg(F.count("*").alias("n_active")).crossJoin(gone.agg(F.count("*").alias("n_gone")))  # one row
    action = F.when(F.col("n_active") == 0, "rejected").when(F.col("n_gone") > F.col("n_active"), "keep_for_review").otherwise("retire")
    return gone.crossJoin(F.broadcast(n)).select(*gone.columns, action.alias("action"))


def counts_with_zero(dimension: DataFrame, facts: DataFrame, key: str, name: str) -> DataFrame:
    """Counts by key with a zero for keys without rows (AGG-04); facts are counted before they are joined."""
    return dimension.select(key).distinct().join(facts.groupBy(key).agg(F.count("*").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


# Fixed value: ranges of places that are counted apart.
BUCKETS = 1024


def insert_positions(index: DataFrame, new: DataFrame, folder: Column) -> DataFrame:
    """(path, ord) of index (path, pos) and new (path) rows once each new row stands behind the last row of its folder (WIN-05)."""
    a = index.select("path", folder.alias("folder"), "pos")
    last = a.groupBy("folder").agg(F.max("pos").alias("last"))
    b = new.select("path", folder.alias("folder")).join(last, "folder", "left")
    both = a.select("path", F.col("pos").cast("double").alias("place"), F.lit(0).alias("is_new")).unionByName(b.select("path", F.coalesce(F.col("last").cast("double"), F.lit(float("inf"))).alias("place"), F.lit(1).alias("is_new")))
    # the place is given by counting what comes before: sums over buckets of places, which are few, then a window inside each bucket
    before = both.groupBy("place").agg(F.count("*").alias("n"))
    known = F.when(F.col("place") < float("inf"), F.col("place"))
    ends = both.agg(F.min(known).alias("low"), F.max(known).alias("high"))  # one row
    share = F.floor((F.col("place") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)) * BUCKETS)
    bucket = F.when(F.col("place") == float("inf"), BUCKETS).otherwise(F.least(F.coalesce(share, F.lit(0)), F.lit(BUCKETS - 1)))
    before = before.crossJoin(F.broadcast(ends)).select("place", "n", bucket.alias("bucket"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = before.groupBy("bucket").agg(F.sum("n").alias("n")).select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    running = Window.partitionBy("bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    offset = before.join(F.broadcast(starts), "bucket").select("place", (F.col("first") + F.coalesce(F.sum("n").over(running), F.lit(0))).alias("start"))
    inside = Window.partitionBy("place").orderBy("is_new", "path")
    return both.join(offset, "place").select("path", "is_new", (F.col("start") + F.row_number().over(inside)).alias("ord"))


def upsert(index: DataFrame, added: DataFrame, removed: DataFrame, key: str = "path") -> DataFrame:
    """index without removed rows, added rows replacing equal keys (SNK-04, SET-05, INC-05)."""
    out = removed.select(key).unionByName(added.select(key)).distinct()
    return index.join(out, key, "left_anti").unionByName(added)


def bump(index: DataFrame, added: DataFrame, removed: DataFrame, version: int, today: str, key: str = "path") -> DataFrame:
    """One row: version and last_updated of an index after upsert() (SNK-04); both move only if a row is new, other than before, or gone."""
    old = index.select(key, F.struct(*index.columns).alias("old"))
    new = added.select(key, F.struct(*index.columns).alias("new"))
    moved = new.join(old, key, "left").where(~F.col("new").eqNullSafe(F.col("old"))).select(key).unionByName(removed.select(key).join(old, key, "left_semi"))
    return moved.agg((F.lit(version) + F.when(F.count("*") > 0, 1).otherwise(0)).alias("version"), F.when(F.count("*") > 0, today).alias("last_updated"), F.countDistinct(key).alias("n_changed"))


def apply(published: DataFrame, candidates: DataFrame, retired: DataFrame, key: str = "path") -> DataFrame:
    """(key, md, action) once candidates (key, md) are promoted and retired keys deleted (SNK-08).

    A row that is both is promoted: it was scraped again. Deleted rows stay in the result without a text, so
    that whoever writes it can remove their state.
    """
    new = candidates.select(key, F.col("md").alias("new"), F.lit(True).alias("scraped"))
    both = published.select(key, "md", F.lit(True).alias("known")).join(new, key, "full_outer").join(retired.select(key).distinct().withColumn("gone", F.lit(True)), key, "left")
    action = (
        F.when(F.col("scraped") & F.col("known").isNull(), "added")
        .when(F.col("scraped") & F.col("md").eqNullSafe(F.col("new")), "unchanged")
        .when(F.col("scraped"), "replaced")
        .when(F.col("gone"), "deleted")
        .otherwise("kept")
    )
    return both.select(key, F.when(F.col("scraped"), F.col("new")).when(F.col("gone"), F.lit(None)).otherwise(F.col("md")).alias("md"), action.alias("action"))
