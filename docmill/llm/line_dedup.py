r"""Line dedup: overlapping windows of three consecutive lines.

Lines are what \n separates; those without a word take no part and stay. Each run of three consecutive
other lines is hashed (128 bits, so that corpora of any size stay free of chance hits), windows that occur
again anywhere are found by a partially aggregated count, and every occurrence but the first, by doc_id
and then position, has its three lines covered. Covered lines, merged over all windows, are removed.

Rows of equal doc_id and text are one occurrence and are treated alike. Null ids come first. Null texts
stay null, empty ones empty; texts of fewer than three lines with words never change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.common import fresh, stage, table

WORD = r"[^\x20\x09-\x0D]"


def _identity(doc_id: Column, text: Column) -> Column:
    """Orders rows by doc_id, and tells apart texts of one id."""
    return F.struct(doc_id.isNotNull().alias("known"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.xxhash64(text).alias("text"))


def windows(docs: DataFrame) -> DataFrame:
    """(row, lines, hash) for every three consecutive lines with words: who, their numbers from 0, and the content."""
    numbered = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    full = F.filter(numbered, lambda s: s.x.rlike(WORD))
    three = F.arrays_zip(full.alias("a"), F.slice(full, 2, F.size(full)).alias("b"), F.slice(full, 3, F.size(full)).alias("c"))
    three = F.filter(three, lambda z: z.c.isNotNull())
    each = F.transform(
        three,
        lambda z: F.struct(
            F.array(z.a.i, z.b.i, z.c.i).alias("lines"),
            F.unhex(F.md5(F.concat_ws("\n", z.a.x, z.b.x, z.c.x))).alias("hash"),
        ),
    )
    out = docs.where("text IS NOT NULL").select(_identity(F.col("doc_id").cast("long"), F.col("text")).alias("row"), F.explode(each).alias("w"))
    return out.select("row", "w.lines", "w.hash")


def covered(docs: DataFrame) -> DataFrame:
    """(row, covered): the line numbers that later occurrences of repeated windows cover."""
    found = stage(windows(docs), "windows")
    # written before the join, so that Spark may split a window that is found everywhere
    repeated = stage(found.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct("row", "lines")).alias("first")).where("n > 1").select("hash", "first"), "repeated")
    later = found.join(repeated, "hash").where(F.struct("row", "lines") > F.col("first"))
    return later.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("lines"))).alias("covered"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with text cleaned, and n_lines, n_removed (an existing column keeps its name, the new one gets a leading underscore)."""
    n_lines, n_removed, row, lines, gone = fresh(docs, "n_lines", "n_removed", "row", "lines", "covered")
    # the lines are made before the join, once, and the text is put together from them after it
    cut = docs.select(*(c for c in docs.columns if c != "text"), _identity(F.col("doc_id").cast("long"), F.col("text")).alias(row), F.split("text", "\n", -1).alias(lines))
    marked = cut.join(covered(docs).select(F.col("row").alias(row), F.col("covered").alias(gone)), row, "left")
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    kept = F.when(F.col(gone).isNull(), F.col(lines)).otherwise(F.transform(keep, lambda i: F.get(F.col(lines), i)))
    text = F.when(F.col(lines).isNotNull(), F.array_join(kept, "\n"))
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return marked.select(*columns, F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(n_lines), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(n_removed))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without later occurrences of repeated three-line windows."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL
), f AS (SELECT * FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), w AS (
  SELECT doc_id, i, lead(i) OVER o AS i1, lead(i, 2) OVER o AS i2, x || chr(10) || lead(x) OVER o || chr(10) || lead(x, 2) OVER o AS k
  FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM w WHERE k IS NOT NULL
), c AS (SELECT DISTINCT doc_id, unnest([i, i1, i2]) AS i FROM r WHERE n > 1
), t AS (
  SELECT l.doc_id, string_agg(CASE WHEN c.i IS NULL THEN l.x END, chr(10) ORDER BY l.i) AS text, count(*) AS n_lines, count(c.i) AS n_removed
  FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.i = c.i GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN t USING (doc_id)
"""
