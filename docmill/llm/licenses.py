"""License scans by ordered signature rules.

Hundreds of regular expressions (license_rules) name the licenses that a text holds, grants, refers to or
mentions. A document in which no rule's keyword stands is passed over; in the others, only those rules are
tried whose longest fixed part stands there. All matches become intervals of words with the rule's priority.
An interval is suppressed if another one contains it that is stronger, or as strong and longer, or as strong
and equal but earlier in the list; so "gpl" inside "licensed under the gnu gpl v3" says nothing of its own.
What is left gives the labels. Base phrases are the strongest rules and are never suppressed.

Everything is a DataFrame expression. Texts are read in one pass without a shuffle; only the intervals of
documents with a match are dealt out, by a number of the row, so a group holds the matches of one text.

Null, empty and wordless texts have no words, no labels ('') and score 0. Repeated rows are judged one by
one. Texts of any length are scanned whole. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.llm.common import stage, table
from docmill.llm.license_rules import KINDS, Rule, rules

#: What is in no word, before capital letters are lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: How sure a label of each kind is.
SURE = (1.0, 1.0, 0.875, 0.75, 0.5)


def spaced(text: Column) -> Column:
    """The words of a text with one blank on either side of each; empty if there are none."""
    words = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BETWEEN, "  "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def n_words(words: Column) -> Column:
    """Number of words in what spaced() makes, or in a part of it."""
    return ((F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))) / 2).cast("long")


def hits(words: Column, table_: list[Rule]) -> Column:
    """array<struct<rule, gaps, sizes>>: words before each match since the last one, and words in it, for each rule that matches."""
    listed = F.array(*(F.struct(F.lit(r.rule).alias("rule"), F.lit(r.needle).alias("needle"), F.lit(r.regex).alias("regex")) for r in table_))
    tried = F.filter(listed, lambda r: F.contains(words, r["needle"]))
    found = F.transform(tried, lambda r: F.struct(r["rule"].alias("rule"), F.transform(F.split(words, r["regex"], -1), n_words).alias("gaps"), F.transform(F.regexp_extract_all(words, r["regex"], F.lit(0)), n_words).alias("sizes")))
    return F.filter(found, lambda h: F.size(h["sizes"]) > 0)


def scan(docs: DataFrame, listed: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of docs.

    listed: other rules than license_rules.rules(), numbered from 0; those of priority 0 are base phrases, and their places are
    counted. score is the certainty of the strongest label.
    """
    listed = rules() if listed is None else listed
    keywords = sorted({r.keyword for r in listed})
    words = docs.select("doc_id", spaced(F.col("text")).alias("words"))
    words = words.select("doc_id", n_words(F.col("words")).alias("n_words"), "words", F.lower("words").alias("lower"))
    # lower() also folds letters beyond A to Z, so it may let too many texts through here, never too few
    likely = F.lit(False)
    for k in keywords:
        likely = likely | F.contains("lower", F.lit(k))
    words = words.select("doc_id", "n_words", F.when(likely, F.translate("words", UPPER, LOWER)).alias("words"))
    scanned = stage(words.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", F.when(F.col("words").isNotNull(), hits(F.col("words"), listed)).alias("hits")), "licenses")
    loud = F.coalesce(F.size("hits"), F.lit(0)) > 0
    return intervals(scanned.where(loud), listed).unionByName(scanned.where(~loud).select("doc_id", "n_words", *(c.alias(n) for n, c in _nothing().items())))


def _nothing() -> dict[str, Column]:
    none = F.lit(None).cast("long")
    return {"n_base": F.lit(0).cast("long"), "first_word": none, "last_word": none, "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}


def intervals(scanned: DataFrame, listed: list[Rule]) -> DataFrame:
    """The result rows of documents with matches: places, suppression, labels."""
    of_rule = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("rule") + 1)
    each = scanned.select("row", "doc_id", "n_words", F.explode("hits").alias("hit"))
    each = each.select("row", "doc_id", "n_words", "hit.rule", F.posexplode(F.arrays_zip("hit.gaps", "hit.sizes")).alias("at", "match")).where("match.sizes IS NOT NULL")
    each = each.repartition("row").select("row", "doc_id", "n_words", "rule", "match.sizes", F.sum(F.col("match.gaps") + F.col("match.sizes")).over(Window.partitionBy("row", "rule").orderBy("at")).alias("end"))
    placed = each.select("row", "doc_id", "n_words", "rule", of_rule([r.label for r in listed]).alias("label"), of_rule([r.priority for r in listed]).alias("priority"), (F.col("end") - F.col("sizes")).alias("start"), "end")
    before = Window.partitionBy("row").orderBy("start", F.desc("end"), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    # all that can contain an interval stands before it, so the furthest end there tells, for each strength
    furthest = F.array(*(F.max(F.when(F.col("priority") <= p, F.col("end"))).over(before) for p in range(len(KINDS))))
    kept = placed.withColumn("furthest", F.coalesce(F.element_at(furthest, F.col("priority") + 1), F.lit(-1))).where("priority = 0 OR furthest < end")
    base = F.col("priority") == 0
    return kept.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(F.element_at(F.array(*map(F.lit, SURE)), F.col("priority") + 1)).alias("score"),
    ).drop("row")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, base places and license labels of every document."""
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same rows in DuckDB's SQL: intervals by sums, suppression by looking for a container."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    values = ",\n".join(f"({r.rule}, {quote(r.label)}, {r.priority}, {quote(r.keyword)}, {quote(r.regex)})" for r in rules())
    sure = " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(SURE))
    count = lambda c: f"(length({c}) - length(replace({c}, ' ', ''))) // 2"
    return rf"""
WITH rules(rule, label, priority, keyword, regex) AS (VALUES
{values}),
trimmed AS (SELECT row_number() OVER () AS r, doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g'), ' ') AS t FROM documents),
words AS (SELECT r, doc_id, CASE WHEN t = '' THEN '' ELSE ' ' || t || ' ' END AS w FROM trimmed),
found AS (SELECT r, rule, label, priority, string_split_regex(w, regex) AS gaps, regexp_extract_all(w, regex) AS got FROM words JOIN rules ON contains(w, keyword)),
each AS (SELECT r, rule, label, priority, generate_subscripts(got, 1) AS k, {count("unnest(gaps[1:len(got)])")} AS gap, {count("unnest(got)")} AS size FROM found WHERE len(got) > 0),
ends AS (SELECT r, rule, label, priority, size, sum(gap + size) OVER (PARTITION BY r, rule ORDER BY k) AS stop FROM each),
placed AS (SELECT r, rule, label, priority, stop - size AS start, stop FROM ends),
kept AS (SELECT * FROM placed d WHERE priority = 0 OR NOT EXISTS (SELECT 1 FROM placed e WHERE e.r = d.r AND e.start <= d.start AND e.stop >= d.stop AND (e.priority < d.priority
  OR (e.priority = d.priority AND (e.stop - e.start > d.stop - d.start OR (e.stop - e.start = d.stop - d.start AND e.rule < d.rule)))))),
told AS (SELECT r, count(*) FILTER (priority = 0) AS n_base, min(start) FILTER (priority = 0) AS first_word, max(start) FILTER (priority = 0) AS last_word,
  array_to_string(list_sort(list(DISTINCT label) FILTER (priority = 0)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(CASE priority {sure} END) AS score FROM kept GROUP BY r)
SELECT doc_id, CAST({count("w")} AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score FROM words LEFT JOIN told USING (r)
"""


OP12_SQL = _sql()
