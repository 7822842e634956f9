"""Queries that compare snapshots. Two are derived from each table by remainders of its id: index and source, published and current."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import keys
from docmill.jobs import sqltext as s
from docmill.operators import catalog, file_tree, sections, sync, unique
from docmill.session import shared_folder
from docmill.sources.published import Published
from docmill.sources.tables import table


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.substring_index("text", "\n", 1)
    return table(spark, sf_dir, "documents").select("doc_id", t.alias("title"), keys.title_key(t).alias("title_key"), "lang", "source")


def _all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an index row, with the slug of the title."""
    return _titles(spark, sf_dir).select(F.concat(F.lit("docs/"), "doc_id", F.lit(".md")).alias("path"), "title", "title_key", F.concat(F.lit("s"), F.col("doc_id") % 400).alias("slug"), F.col("doc_id").alias("pos"), "lang", "source")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexed: ids not divisible by 7."""
    return _all(spark, sf_dir).where("pos % 7 <> 0")


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active: ids not divisible by 5; every third one's title has changed, so that the slug must do."""
    t = _titles(spark, sf_dir).where("doc_id % 5 <> 0")
    return t.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat("title_key", F.lit(" new"))).otherwise(F.col("title_key")).alias("title_key"), F.concat(F.lit("s"), F.col("doc_id") % 500).alias("slug"))


def catalog_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-01: active rows matched with the index by title, else by slug."""
    return catalog.match(_active(spark, sf_dir), _index(spark, sf_dir)).select("doc_id", "status", "index_path", "index_title")


def catalog_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-02, JOI-03, JOI-13: index rows that nothing active matches."""
    return catalog.missing(_index(spark, sf_dir), catalog.match(_active(spark, sf_dir), _index(spark, sf_dir))).select("path", "title", "slug")


def catalog_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02."""
    m = catalog.match(_active(spark, sf_dir), _index(spark, sf_dir))
    return catalog.counters(m, catalog.missing(_index(spark, sf_dir), m))


def retire_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-06: what to do about each missing index row."""
    a = _active(spark, sf_dir)
    return catalog.retire(a, catalog.missing(_index(spark, sf_dir), catalog.match(a, _index(spark, sf_dir))).select("path"))


def unindexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-04, JOI-13, SRC-16: documents that no index row has a path for."""
    paths = table(spark, sf_dir, "documents").select(F.concat(F.lit("docs/"), "doc_id", F.lit(".md")).alias("path"))
    return paths.join(_index(spark, sf_dir).select("path"), "path", "left_anti")


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01: all documents by category and top folder."""
    return _all(spark, sf_dir).groupBy(F.col("lang").alias("category"), F.substring_index("path", "/", 1).alias("folder")).agg(F.count("*").alias("n"))


def sector_counts_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04: all German documents by source, with zeros."""
    return catalog.counts_with_zero(table(spark, sf_dir, "documents"), _all(spark, sf_dir).where("lang = 'de'"), "source", "n")


def dup_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-04: all documents whose title or slug an earlier one has."""
    i = _all(spark, sf_dir).select("pos", "title_key", "slug")
    return unique.flags(i, {"title_key": "title", "slug": "slug"}, "pos").select("pos", "title_repeated", "title_first", "slug_repeated", "slug_first")


def insert_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-05: places once new rows stand behind the last row of their folder."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("/"), "doc_id", F.lit(".md")).alias("path"))
    return catalog.insert_positions(d.where("doc_id % 7 <> 0").select("path", F.col("doc_id").alias("pos")), d.where("doc_id % 7 = 0").select("path"), F.substring_index("path", "/", 1))


def index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-04, SET-05, INC-05: the index after retired rows went and candidates came or replaced."""
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("docs/"), "doc_id", F.lit(".md")).alias("path"), "doc_id", "lang")
    index = d.where("doc_id % 7 <> 0").select("path", F.col("lang").alias("category"))
    return catalog.upsert(index, d.where("doc_id % 11 = 0").select("path", F.lit("replaced").alias("category")), d.where("doc_id % 13 = 0").select("path"))


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Published (ids not divisible by 7) and current texts (not by 5); every eleventh current text has one more line."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    new = F.when(F.col("doc_id") % 11 == 0, F.concat("text", F.lit("\none more line"))).otherwise(F.col("text"))
    return d.where("doc_id % 7 <> 0"), d.where("doc_id % 5 <> 0").withColumn("text", new)


def change_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-01."""
    old, new = (x.select("doc_id", keys.content_hash(F.col("text")).alias("content_hash")) for x in _versions(spark, sf_dir))
    return sync.change_status(new, old, "doc_id").select("doc_id", "status", "content_hash", "previous_hash")


def doc_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-02."""
    old, new = _versions(spark, sf_dir)
    return sync.compare(new, old, "doc_id", "text")


def _files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    listing = d.where("id % 5 <> 0").select("id", F.when(F.col("id") % 3 == 0, 2).otherwise(1).alias("modified"), F.when(F.col("id") % 13 == 0, "moved").otherwise(F.col("source")).alias("slug"), keys.content_hash(F.when(F.col("id") % 9 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("hash"), (F.col("id") % 27 == 0).alias("duplicate"), F.when(F.col("id") % 39 == 0, "unreadable").alias("error"))
    state = d.where("id % 7 <> 0").select("id", F.lit(1).alias("modified"), F.col("source").alias("slug"), keys.content_hash(F.col("text")).alias("hash"))
    return listing, state


def file_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-06, INC-03, INC-04, FLT-07, RUL-08: status of listed and known files."""
    return sync.file_status(*_files(spark, sf_dir))


def file_tree_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-03, INC-04, FLT-07, SNK-01: a tree's state after two runs, the second of which reads what the first published.

    The first finds ids not divisible by 5, the second, which writes no candidates, those not divisible by 7. In between those divisible
    by 3 were touched, those by 13 moved, those by 9 rewritten.
    """
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source", "lang")
    n = F.col("id")
    fixed = [F.concat(F.lit("f"), "id").alias("name"), F.col("lang").alias("sector"), F.concat(F.lit("l"), "id").alias("link"), F.lit("like another").alias("explanation")]
    first = d.where("id % 5 <> 0").select("id", *fixed, F.lit("2026-01-01").cast("timestamp").alias("modified"), F.concat("source", F.lit("/"), "id").alias("path"), F.col("source").alias("slug"), keys.content_hash(F.col("text")).alias("hash"), (n % 27 == 0).alias("duplicate"), F.when(n % 39 == 0, "unreadable").alias("error"))
    second = d.where("id % 7 <> 0").select(
        "id", *fixed, F.when(n % 3 == 0, "2026-02-02").otherwise("2026-01-01").cast("timestamp").alias("modified"), F.concat(F.when(n % 13 == 0, "moved").otherwise(F.col("source")), F.lit("/"), "id").alias("path"), F.when(n % 13 == 0, "moved").otherwise(F.col("source")).alias("slug"),
        keys.content_hash(F.when(n % 9 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("hash"), (n % 54 == 0).alias("duplicate"), F.when(n % 26 == 0, "unreadable").alias("error"),
    )
    tree = Published(spark, f"{shared_folder(spark)}/tree-{uuid.uuid4().hex}")
    nothing = file_tree.next_state(first.limit(0), first.limit(0).withColumn("status", F.lit("")), "2026-01-05").drop("outcome")
    tree.publish({"state": file_tree.next_state(first, nothing, "2026-01-05").drop("outcome")}, tree.version())
    tree.publish({"state": file_tree.next_state(second, tree.read("state"), "2026-02-05", write=False)}, tree.version())
    return tree.read("state").select("id", "outcome", "status", "path", "slug", "sector", "hash", "explanation", "error", "link", F.date_format("modified", "yyyy-MM-dd").alias("modified"), F.date_format("last_processed", "yyyy-MM-dd").alias("last_processed"))


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-12."""
    return file_status(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


def set_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-08, AGG-09: hashes of each source's documents as a set and as a list."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return sync.set_hash(d, ["source"], "doc_id", "n_chars").join(sync.list_hash(d, ["source"], "doc_id", "n_chars"), "source")


def _diff(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    old, new = _versions(spark, sf_dir)
    cut = lambda d: sections.md_sections(sections.with_headings(d), "doc_id", "md")
    current = new.select("doc_id").join(old.select("doc_id", F.lit(True).alias("has_current")), "doc_id", "left").withColumn("has_current", F.coalesce("has_current", F.lit(False)))
    changes = sections.diff_sections(cut(new), cut(old.join(new.select("doc_id"), "doc_id", "left_semi")), "doc_id")
    return current, changes


def section_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI-05, SET-04, TXT-20: sections that differ between the two versions."""
    return _diff(spark, sf_dir)[1]


def diff_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RUL-03: decision and reason per current document."""
    return sections.decide(*_diff(spark, sf_dir), "doc_id", ("Part 1", "Part 2"))


def run_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-10, RUL-05, RUL-06: the worst decision of each source."""
    d = sections.decide(*_diff(spark, sf_dir), "doc_id", ("Part 1", "Part 2")).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return sync.worst(d, ["source"])


_TITLES = f"t AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, {s.title_key('split_part(text, chr(10), 1)')} AS title_key, lang, source FROM documents)"
_INDEX = "i AS (SELECT 'docs/' || doc_id || '.md' AS path, title, title_key, 's' || (doc_id % 400) AS slug, doc_id AS pos, lang, source FROM t WHERE doc_id % 7 <> 0)"
_MATCH = f"""{_TITLES}, {_INDEX}, a AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN title_key || ' new' ELSE title_key END AS title_key, 's' || (doc_id % 500) AS slug FROM t WHERE doc_id % 5 <> 0),
bt AS (SELECT title_key, arg_max(path, pos) AS path, arg_max(title, pos) AS title FROM i GROUP BY 1), bs AS (SELECT slug, arg_max(path, pos) AS path, arg_max(title, pos) AS title FROM i GROUP BY 1),
m AS (SELECT a.doc_id, CASE WHEN coalesce(bt.path, bs.path) IS NULL THEN 'new_unindexed' ELSE 'indexed' END AS status, coalesce(bt.path, bs.path) AS index_path, CASE WHEN bt.path IS NOT NULL THEN bt.title ELSE bs.title END AS index_title
  FROM a LEFT JOIN bt ON a.title_key = bt.title_key LEFT JOIN bs ON a.slug = bs.slug),
g AS (SELECT * FROM i WHERE path NOT IN (SELECT index_path FROM m WHERE index_path IS NOT NULL))"""
_VERSIONS = "old AS (SELECT doc_id, text FROM documents WHERE doc_id % 7 <> 0), new AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN text || chr(10) || 'one more line' ELSE text END AS text FROM documents WHERE doc_id % 5 <> 0)"


def _cut(name: str) -> str:
    md = "array_to_string([CASE WHEN (i - 1) % 3 = 2 THEN '## Part ' || ((i - 1) // 3) || chr(10) || l[i] ELSE l[i] END for i in range(1, len(l) + 1)], chr(10))"
    return f"""{name}_s AS (SELECT doc_id, name, {s.squeeze('body')} AS body FROM (SELECT doc_id, run, coalesce(max(head), '__preface__') AS name, string_agg(CASE WHEN head IS NULL THEN line END, chr(10) ORDER BY pos) AS body FROM (
  SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM (SELECT doc_id, line, pos, nullif(regexp_extract(line, '^##{s.WS}+(.+?){s.WS}*$', 1), '') AS head FROM (
  SELECT doc_id, unnest(string_split(md, chr(10))) AS line, unnest(range(len(string_split(md, chr(10))))) AS pos FROM (SELECT doc_id, {md} AS md FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM {name})))))
  GROUP BY doc_id, run))"""


_DIFF = f"""{_VERSIONS}, {_cut('old')}, {_cut('new')},
d AS (SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, coalesce(n.name, o.name) AS name, CASE WHEN coalesce(n.name, o.name) = '__preface__' THEN CASE WHEN coalesce(n.body, '') <> coalesce(o.body, '') THEN 'changed' END
  WHEN o.doc_id IS NULL THEN 'added' WHEN n.doc_id IS NULL THEN 'removed' WHEN coalesce(n.body, '') <> coalesce(o.body, '') THEN 'changed' END AS change
  FROM new_s n FULL JOIN (SELECT * FROM old_s WHERE doc_id IN (SELECT doc_id FROM new)) o ON n.doc_id = o.doc_id AND n.name = o.name),
c AS (SELECT doc_id, count_if(change = 'changed') AS changed, count_if(change = 'added') AS added, count_if(change = 'removed') AS removed, count_if(change = 'changed' AND name IN ('Part 1', 'Part 2')) AS sensitive FROM d WHERE change IS NOT NULL GROUP BY doc_id),
z AS (SELECT n.doc_id, o.doc_id IS NOT NULL AS there, coalesce(changed, 0) AS changed, coalesce(added, 0) AS added, coalesce(removed, 0) AS removed, coalesce(sensitive, 0) AS sensitive FROM new n LEFT JOIN old o USING (doc_id) LEFT JOIN c USING (doc_id)),
e AS (SELECT doc_id, CASE WHEN NOT there THEN 'requires_review' WHEN changed + added + removed = 0 THEN 'no_change' WHEN added + removed + sensitive > 0 THEN 'requires_review' ELSE 'auto_merge' END AS decision,
  CASE WHEN NOT there THEN 'no_existing_md' WHEN changed + added + removed = 0 THEN 'sections_match' WHEN added + removed > 0 THEN 'structural_change' WHEN sensitive > 0 THEN 'sensitive_section_changed' ELSE 'only_non_sensitive_changes' END AS reason, changed, added, removed, sensitive FROM z)"""
_FILES = """l AS (SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS modified, CASE WHEN doc_id % 13 = 0 THEN 'moved' ELSE source END AS slug, sha256(CASE WHEN doc_id % 9 = 0 THEN text || '!' ELSE text END) AS hash FROM documents WHERE doc_id % 5 <> 0),
k AS (SELECT doc_id AS id, 1 AS modified, source AS slug, sha256(text) AS hash FROM documents WHERE doc_id % 7 <> 0),
f AS (SELECT coalesce(l.id, k.id) AS id, CASE WHEN l.id IS NULL THEN 'deleted' WHEN k.id IS NOT NULL AND l.modified = k.modified AND l.slug = k.slug THEN 'unchanged' WHEN l.id % 39 = 0 THEN 'error'
  WHEN k.id IS NOT NULL AND l.hash = k.hash THEN 'synchronized' WHEN l.id % 27 = 0 THEN 'skipped (duplicate)' ELSE 'candidate' END AS status FROM l FULL JOIN k ON l.id = k.id)"""

QUERIES = {f.__name__: f for f in (catalog_match, catalog_missing, catalog_counters, retire_guard, unindexed, category_counts, sector_counts_zero, dup_flags, insert_order, index_upsert, change_status, doc_compare, file_status, file_tree_runs, run_totals, set_hash, section_diff, diff_decision, run_decision)}
SQL = {
    "catalog_match": f"WITH {_MATCH} SELECT doc_id, status, index_path, index_title FROM m",
    "catalog_missing": f"WITH {_MATCH} SELECT path, title, slug FROM g",
    "catalog_counters": f"WITH {_MATCH} SELECT (SELECT count(*) FROM m) AS active, (SELECT count_if(status = 'indexed') FROM m) AS matched, (SELECT count_if(status = 'new_unindexed') FROM m) AS new, (SELECT count(*) FROM g) AS missing",
    "retire_guard": f"WITH {_MATCH} SELECT path, CASE WHEN (SELECT count(*) FROM a) = 0 THEN 'rejected' WHEN (SELECT count(*) FROM g) > (SELECT count(*) FROM a) THEN 'keep_for_review' ELSE 'retire' END AS action FROM g",
    "unindexed": "SELECT 'docs/' || doc_id || '.md' AS path FROM documents WHERE doc_id % 7 = 0",
    "category_counts": "SELECT lang AS category, 'docs' AS folder, count(*) AS n FROM documents GROUP BY lang",
    "sector_counts_zero": "SELECT source, count_if(lang = 'de') AS n FROM documents GROUP BY source",
    "dup_flags": f"WITH {_TITLES}, i AS (SELECT doc_id AS pos, title_key, 's' || (doc_id % 400) AS slug FROM t) SELECT pos, title_key <> '' AND row_number() OVER (PARTITION BY title_key ORDER BY pos) > 1 AS title_repeated, CASE WHEN title_key <> '' THEN min(pos) OVER (PARTITION BY title_key) ELSE pos END AS title_first, row_number() OVER (PARTITION BY slug ORDER BY pos) > 1 AS slug_repeated, min(pos) OVER (PARTITION BY slug) AS slug_first FROM i",
    "insert_order": """
WITH d AS (SELECT doc_id, source || '/' || doc_id || '.md' AS path, source FROM documents), l AS (SELECT source, max(doc_id) AS last FROM d WHERE doc_id % 7 <> 0 GROUP BY source),
b AS (SELECT path, doc_id::DOUBLE AS place, 0 AS is_new FROM d WHERE doc_id % 7 <> 0 UNION ALL SELECT path, coalesce(last::DOUBLE, 'inf'::DOUBLE), 1 FROM d LEFT JOIN l USING (source) WHERE doc_id % 7 = 0)
SELECT path, is_new, row_number() OVER (ORDER BY place, is_new, path) AS ord FROM b""",
    "index_upsert": "SELECT 'docs/' || doc_id || '.md' AS path, CASE WHEN doc_id % 11 = 0 THEN 'replaced' ELSE lang END AS category FROM documents WHERE doc_id % 11 = 0 OR (doc_id % 7 <> 0 AND doc_id % 13 <> 0)",
    "change_status": f"WITH {_VERSIONS} SELECT new.doc_id, CASE WHEN old.doc_id IS NULL THEN 'new' WHEN old.text = new.text THEN 'unchanged' ELSE 'changed' END AS status, sha256(new.text) AS content_hash, sha256(old.text) AS previous_hash FROM new LEFT JOIN old USING (doc_id)",
    "doc_compare": f"WITH {_VERSIONS} SELECT new.doc_id, CASE WHEN old.doc_id IS NULL THEN 'created' WHEN old.text = new.text THEN 'unchanged' ELSE 'updated' END AS action FROM new LEFT JOIN old USING (doc_id)",
    "file_status": f"WITH {_FILES} SELECT id, status FROM f",
    "file_tree_runs": """
WITH a AS (SELECT doc_id AS id, CASE WHEN doc_id % 39 = 0 THEN 'error' WHEN doc_id % 27 = 0 THEN 'skipped (duplicate)' ELSE 'candidate' END AS status, source || '/' || doc_id AS path, source AS slug, CASE WHEN doc_id % 39 > 0 AND doc_id % 27 > 0 THEN lang END AS sector,
  CASE WHEN doc_id % 39 > 0 THEN sha256(text) END AS hash, CASE WHEN doc_id % 39 > 0 AND doc_id % 27 = 0 THEN 'like another' END AS explanation, CASE WHEN doc_id % 39 = 0 THEN 'unreadable' END AS error,
  CASE WHEN doc_id % 39 > 0 AND doc_id % 27 > 0 THEN 'l' || doc_id END AS link, '2026-01-01' AS modified, '2026-01-05' AS last_processed FROM documents WHERE doc_id % 5 <> 0),
b AS (SELECT doc_id AS n, lang, CASE WHEN doc_id % 13 = 0 THEN 'moved' ELSE source END || '/' || doc_id AS p, CASE WHEN doc_id % 13 = 0 THEN 'moved' ELSE source END AS s, sha256(CASE WHEN doc_id % 9 = 0 THEN text || '!' ELSE text END) AS h, CASE WHEN doc_id % 3 = 0 THEN '2026-02-02' ELSE '2026-01-01' END AS m FROM documents WHERE doc_id % 7 <> 0),
o AS (SELECT *, CASE WHEN n IS NULL THEN 'deleted' WHEN id IS NOT NULL AND m = modified AND s = slug THEN 'unchanged' WHEN n % 26 = 0 THEN 'failed' WHEN h = hash THEN 'same' WHEN n % 54 = 0 THEN 'duplicate' ELSE 'processed' END AS outcome FROM a FULL JOIN b ON id = n),
w AS (SELECT *, outcome IN ('deleted', 'unchanged', 'same') OR (outcome = 'failed' AND id IS NOT NULL) AS old FROM o)
SELECT coalesce(id, n) AS id, outcome, CASE WHEN outcome = 'deleted' THEN 'deleted' WHEN old THEN status WHEN outcome = 'failed' THEN 'error' WHEN outcome = 'duplicate' THEN 'skipped (duplicate)' ELSE 'pending-write' END AS status,
  CASE WHEN old AND outcome <> 'same' THEN path ELSE p END AS path, CASE WHEN old AND outcome <> 'same' THEN slug ELSE s END AS slug, CASE WHEN old THEN sector WHEN outcome = 'processed' THEN lang END AS sector, CASE WHEN old THEN hash WHEN outcome <> 'failed' THEN h END AS hash,
  CASE WHEN old THEN explanation WHEN outcome = 'duplicate' THEN 'like another' END AS explanation, CASE WHEN old THEN error WHEN outcome = 'failed' THEN 'unreadable' END AS error, CASE WHEN old THEN link WHEN outcome = 'processed' THEN 'l' || n END AS link,
  CASE WHEN old AND outcome <> 'same' THEN modified ELSE m END AS modified, CASE WHEN outcome = 'unchanged' OR (outcome = 'failed' AND old) THEN last_processed ELSE '2026-02-05' END AS last_processed FROM w""",
    "run_totals": f"WITH {_FILES} SELECT status, count(*) AS n FROM f GROUP BY status",
    "set_hash": "SELECT source, sha256(string_agg(doc_id || ':' || n_chars, '|' ORDER BY doc_id || ':' || n_chars)) AS set_hash, sha256(string_agg(CAST(n_chars AS VARCHAR), chr(10) ORDER BY doc_id)) AS list_hash FROM documents GROUP BY source",
    "section_diff": f"WITH {_DIFF} SELECT doc_id, name, change FROM d WHERE change IS NOT NULL",
    "diff_decision": f"WITH {_DIFF} SELECT * FROM e",
    "run_decision": f"WITH {_DIFF} SELECT source, CASE max(CASE decision WHEN 'no_change' THEN 1 WHEN 'auto_merge' THEN 2 ELSE 3 END) WHEN 1 THEN 'no_change' WHEN 2 THEN 'auto_merge' ELSE 'requires_review' END AS decision, count(*) AS n_documents FROM e JOIN documents USING (doc_id) GROUP BY source",
}
