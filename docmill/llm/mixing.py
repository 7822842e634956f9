"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its share of the wanted total over its number of documents. Each document is
repeated as often as the inverse of a Poisson distribution with that mean says at a uniform number hashed
from the seed and its doc_id: any task makes the same choice anywhere, with no state to lose. The copies
are dealt and ordered by a hash of seed, doc_id and copy number, which is a global shuffle without sampling.

Rows with equal doc_id and source get the same number of copies; rows without a doc_id stand for their text
instead, so they are dealt and repeated one by one. A null source is a source; sources of weight 0 or without
a weight get no copies. Texts may be null or empty. An empty table gives an empty one. A rate above SUMMAND,
whose Poisson terms don't fit doubles, is the sum of equal smaller ones, each with a hashed number of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.common import fresh, stage, table

#: The rates are sent to all tasks if there are at most so many sources; beyond that they are joined.
BROADCAST_SOURCES = 20_000
SUMMAND = 500.0


def tempered(docs: DataFrame, power: float = 0.7) -> DataFrame:
    """(source, weight): each source's number of documents to a power, which favours small sources."""
    return docs.groupBy("source").agg(F.pow(F.count("*").cast("double"), F.lit(power)).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, total: float | None = None) -> DataFrame:
    """(source, rate, parts, cdf): mean copies of a document, the number of equal summands of that mean, and the running sums of one summand's Poisson distribution up to where they reach 1.

    total: wanted number of documents on average (default: as many as there are).
    """
    counts = docs.groupBy("source").agg(F.count("*").cast("double").alias("n"))
    both = counts.join(weights.select(F.col("source").alias("of"), F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight")), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    sums = both.agg(F.sum("weight").alias("all_weight")).crossJoin(counts.agg(F.sum("n").alias("all_n")))  # one row
    wanted = F.lit(float(total)) if total is not None else F.col("all_n")
    rate = F.round(wanted * F.col("weight") / F.col("all_weight") / F.col("n"), 9)
    out = both.crossJoin(F.broadcast(sums)).where("weight > 0").select("source", rate.alias("rate")).where("rate > 0").withColumn("parts", F.ceil(F.col("rate") / SUMMAND).cast("int"))
    out = out.withColumn("mean", F.when(F.col("parts") == 1, F.col("rate")).otherwise(F.col("rate") / F.col("parts")))
    top = F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 40).cast("int")
    first = F.exp(-F.col("mean"))
    # term k is term k - 1 times mean / k
    cdf = F.aggregate(
        F.sequence(F.lit(1), top),
        F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all")),
        lambda s, k: F.struct((s.p * F.col("mean") / k).alias("p"), (s.c + s.p * F.col("mean") / k).alias("c"), F.concat(s["all"], F.array(s.c + s.p * F.col("mean") / k)).alias("all")),
        lambda s: s["all"],
    )
    return out.select("source", "rate", "parts", cdf.alias("cdf"))


def uniform(seed: int, *values: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of seed and values."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(v.cast("string"), F.lit("")) for v in values]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, weights: DataFrame, seed: int = 17, total: float | None = None) -> DataFrame:
    """docs repeated and shuffled, with rate, n_copies, copy (from 1) and shuffle_key, by which each partition is in order."""
    rate, n_copies, copy, key, source, parts, cdf, who = fresh(docs, "rate", "n_copies", "copy", "shuffle_key", "mixed_source", "parts", "cdf", "who")
    known = stage(rates(docs.select("source"), weights, total), "rates")
    size = known.count()
    known = known.select(F.col("source").alias(source), F.col("rate").alias(rate), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    known = F.broadcast(known) if size <= BROADCAST_SOURCES else known
    # rows without an id are told apart by their text, so that they don't all go to one task
    unknown = F.when(F.col("text").isNotNull(), F.concat(F.lit("text/"), F.md5("text"))).otherwise("") if "text" in docs.columns else F.lit("")
    joined = docs.join(known, F.col("source").eqNullSafe(F.col(source))).withColumn(who, F.coalesce(F.col("doc_id").cast("string"), unknown))

    def inverse(*values: Column) -> Column:
        """How many running sums are below the number hashed from values, which is where it would be put among them."""
        return F.aggregate(
            F.array(uniform(seed, *values)),
            F.lit(0).cast("long"),
            lambda _, u: F.array_position(F.sort_array(F.array_append(F.col(cdf), u)), u) - 1,
        )

    summands = F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0).cast("long"), lambda s, k: s + inverse(F.col(who), k))
    counted = joined.withColumn(n_copies, F.when(F.col(parts) == 1, inverse(F.col(who))).otherwise(summands))
    copies = counted.where(F.col(n_copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n_copies).cast("int"))))
    keyed = copies.withColumn(key, F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(who), F.col(copy).cast("string")).cast("binary")))
    return keyed.select(*docs.columns, rate, n_copies, copy, key).repartition(key).sortWithinPartitions(key, "doc_id")


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to tempered source weights, as many as there are on average."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs, tempered(docs))


OP5_SQL = """
WITH RECURSIVE counts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY source
), weights AS (SELECT source, n, pow(n, CAST(0.7 AS DOUBLE)) AS weight FROM counts
), rates AS (
  SELECT source, round((SELECT sum(n) FROM counts) * weight / (SELECT sum(weight) FROM weights) / n, 9) AS rate FROM weights
), cdf AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate) + 40)
), chosen AS (
  SELECT d.*, CAST(CAST('0x' || substr(md5('17:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u FROM documents d
), counted AS (
  SELECT h.doc_id, h.text, h.lang, h.source, h.n_chars, c.rate, count(*) AS n_copies
  FROM chosen h JOIN cdf c ON h.source IS NOT DISTINCT FROM c.source AND c.c < h.u GROUP BY ALL
)
SELECT doc_id, text, lang, source, n_chars, rate, n_copies, CAST(copy AS INTEGER) AS copy, md5('17:' || CAST(doc_id AS VARCHAR) || ':' || CAST(copy AS VARCHAR)) AS shuffle_key
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM counted)
"""
