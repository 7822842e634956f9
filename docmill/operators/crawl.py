"""Breadth-first crawl over landed pages and their links, level by level (GRF-01, SRC-05)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.operators.ranks import numbered
from docmill.session import cut


#: Up to so many rows are numbered by one task; more of them in ranges (ranks.numbered).
ONE_TASK = 100_000


def placed(df: DataFrame, order: list[str], most: int, name: str) -> DataFrame:
    """The first ``most`` rows of df in the order of some columns, with their places from 0."""
    if most <= ONE_TASK:
        return df.orderBy(*order).limit(most).withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)
    return numbered(df, order, name).where(F.col(name) <= most).withColumn(name, F.col(name) - 1)


def reach(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, depth) of all that can be reached from roots, however deep; edges are (src, dst)."""
    level = cut(roots.select("node").distinct())
    seen, taken, depth = level, [], 0
    while not level.isEmpty():
        taken.append(level.withColumn("depth", F.lit(depth)))
        found = edges.join(level.withColumnRenamed("node", "src"), "src").select(F.col("dst").alias("node")).distinct()
        level = cut(found.join(seen, "node", "left_anti"))
        seen = cut(seen.unionByName(level)) if depth % 10 == 9 else seen.unionByName(level)
        depth += 1
    return reduce(DataFrame.unionByName, taken) if taken else level.withColumn("depth", F.lit(0))


def crawl(pages: DataFrame, links: DataFrame, roots: DataFrame, max_depth: int, max_pages: int) -> DataFrame:
    """(node, depth, status) of a crawl with a budget: fetched and failed pages, and pending ones without a depth.

    pages (node, final, failed): where a page's address leads, and whether it can't be read; nodes that
    aren't landed fail. links (node, ord, dst): links of final pages in their order. roots (node, ord).

    A level takes its pages in the order in which they were found, as far as the budget goes. A page whose
    final address was fetched before is dropped, with its links; a failed one uses up budget. A link is
    queued while fetched and queued pages together are below the budget, else it is pending, as is all that
    is queued when depth or budget end. Places in a level are taken among max_pages rows at most, in ranges if
    these are many; links are joined by Spark, whatever their number.
    """
    queue = cut(placed(roots.groupBy("node").agg(F.min("ord").alias("ord")), ["ord", "node"], max_pages, "pos").select("node", "pos"))
    visited = queue.select("node")
    finals = cut(queue.select(F.col("node").alias("final")).limit(0))
    done, pending, n = [], [], 0
    for depth in range(max_depth + 1):
        if n >= max_pages or queue.isEmpty():
            break
        pending.append(queue.where(F.col("pos") >= max_pages - n).select("node"))
        batch = queue.where(F.col("pos") < max_pages - n)
        got = batch.join(pages, "node", "left").select("pos", "node", F.coalesce("final", "node").alias("final"), F.coalesce("failed", F.lit(True)).alias("failed"))
        read = got.where("NOT failed").groupBy("final").agg(F.min("pos").alias("pos")).join(finals, "final", "left_anti")
        good = read.select("pos", F.col("final").alias("node"), F.lit("fetched").alias("status"))
        bad = got.where("failed").select("pos", "node", F.lit("failed").alias("status"))
        counted = cut(placed(good.unionByName(bad), ["pos"], max_pages, "so_far").withColumn("so_far", F.col("so_far") + 1 + n))
        done.append(counted.select("node", F.lit(depth).alias("depth"), "status"))
        fetched = counted.where("status = 'fetched'").select("pos", "node", "so_far")
        # a page's own final address counts as visited from its turn on
        turn = fetched.select(F.col("node").alias("dst"), F.col("pos").alias("turn"))
        seen = links.join(fetched, "node").select("pos", "so_far", "ord", "dst").join(visited.withColumnRenamed("node", "dst"), "dst", "left_anti")
        seen = seen.join(turn, "dst", "left").where("turn IS NULL OR turn > pos").groupBy("dst").agg(F.min(F.struct("pos", "ord", "so_far")).alias("at"))
        # all links up to the first that finds no room are queued, so only max_pages of them can be
        seen, n = cut(seen), n + counted.count()
        first = placed(seen.select("dst", "at.so_far", F.col("at.pos").alias("from"), F.col("at.ord").alias("ord")), ["from", "ord", "dst"], max_pages, "pos")
        queue = cut(first.where(F.col("so_far") + F.col("pos") < max_pages).select(F.col("dst").alias("node"), "pos"))
        pending.append(seen.select(F.col("dst").alias("node")).join(queue, "node", "left_anti"))
        finals = cut(finals.unionByName(fetched.select(F.col("node").alias("final"))))
        visited = cut(visited.unionByName(queue.select("node")).unionByName(fetched.select("node")))
    pending.append(queue.select("node"))
    fetched = reduce(DataFrame.unionByName, done) if done else queue.select("node", F.lit(0).alias("depth"), F.lit("").alias("status")).limit(0)
    left = reduce(DataFrame.unionByName, pending).distinct().join(fetched, "node", "left_anti")
    return fetched.unionByName(left.select("node", F.lit(None).cast("int").alias("depth"), F.lit("pending").alias("status")))


def capped(edges: DataFrame, roots: DataFrame, max_depth: int, max_pages: int) -> DataFrame:
    """crawl() of pages that all can be read where they are, with links in the order of their targets."""
    pages = edges.select(F.col("dst").alias("node")).unionByName(roots.select("node")).distinct()
    return crawl(pages.select("node", F.col("node").alias("final"), F.lit(False).alias("failed")), edges.select(F.col("src").alias("node"), F.col("dst").alias("ord"), "dst"), roots.select("node", F.col("node").alias("ord")), max_depth, max_pages)
