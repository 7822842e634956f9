"""Queries over topics, appendices and complements, and small functions that no other query reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import dates, keys, urls
from docmill.jobs import pages as pg
from docmill.jobs import sheets as sh
from docmill.jobs import sqltext as s
from docmill.operators import grid, links, reports, topics
from docmill.sources.tables import table

TODAY = "2026-05-21"
_KINDS = {"system_hosts": ("tionsh.example.net",), "internal_suffixes": ("example.net", "example.com"), "system_words": ("/the",)}


def _rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fourteen topics with the pages of equal remainder, of which those divisible by 3 belong to none, and one page in 50 isn't landed."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.where("page_id % 3 <> 0").select((F.col("page_id") % 14).alias("topic"), "page_id")
    return topics.rollup(listed, pages.where("page_id % 50 <> 1"), **_KINDS)


def topic_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-18, AGG-05, FLT-03: signals, link counts and reasons for review of every topic."""
    return _rolled(spark, sf_dir).withColumn("reasons", F.array_join("reasons", ";"))


def topic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-03: a document per topic."""
    return _rolled(spark, sf_dir).withColumn("title", F.concat(F.lit("Tema "), "topic")).select("topic", topics.document(TODAY).alias("md"))


def link_appendices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-05: each page's links as an appendix."""
    md = topics.link_appendix(links.anchors(table(spark, sf_dir, "pages"), **_KINDS), ["page_id"])
    return md.select("page_id", F.length("md").alias("length"), keys.content_hash(F.col("md")).alias("hash"))


def sheet_complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-07: a document around each exam sheet's table."""
    e = grid.exams(sh.exam_cells(spark, sf_dir))
    tables = reports.md_table(e, ["sheet"], ["r"], {"Código": F.col("code"), "Materia": F.col("subject")})
    name = F.concat(F.lit("Planilla "), "sheet", F.when(F.col("sheet") % 2 == 0, ".CSV").otherwise(".xlsx"))
    md = topics.complement(name, F.col("md"), F.lit(TODAY), F.concat(F.lit("https://example.org/"), "sheet"), "carpeta")
    return tables.select("sheet", F.length(md).alias("length"), keys.content_hash(md).alias("hash"))


def zone_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT-04: the date of each event in a zone three hours behind."""
    return table(spark, sf_dir, "events").select("event_id", dates.date_in(F.col("ts"), "America/Argentina/Buenos_Aires").alias("day"))


def safe_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-04: paths below two folders that may be written to; others are null."""
    n = F.col("doc_id")
    path = F.concat(F.element_at(F.array(F.lit("kb/"), F.lit("cursos/"), F.lit("other/"), F.lit("kb/../")), (n % 4 + 1).cast("int")), n, F.when(n % 5 == 0, "//x.md").when(n % 7 == 0, ".txt").otherwise(".md"))
    return table(spark, sf_dir, "documents").select("doc_id", urls.safe_path(path, ("kb/", "cursos/")).alias("path"))


def locale_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-02: nations of each region in the order of a language, accents and all."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", F.concat(F.when(F.col("n_nationkey") % 2 == 0, "á").otherwise("a"), F.lower("n_name")).alias("name"))
    return reports.name_rank(n, "name", ["n_regionkey"])


_ROLLED = rf"""
{pg._ANCHORS.replace('FROM pages', 'FROM (SELECT * FROM pages WHERE page_id % 50 <> 1)')},
lt AS (SELECT page_id % 14 AS topic, page_id FROM pages WHERE page_id % 3 <> 0),
tx AS (SELECT page_id, html, {s.normalize_spaces(s.html_to_text('html'))} AS text FROM pages WHERE page_id % 50 <> 1),
pp AS (SELECT topic, count(*) AS pages, count_if(tx.page_id IS NULL) AS failed, count_if(length(text) >= 80) AS pages_with_content, coalesce(bool_or(regexp_matches(html, '(?i)<iframe\b')), false) AS has_iframe,
  coalesce(bool_or(regexp_matches(lower(text), 'nombre{s.WS}+y{s.WS}+apellido') OR regexp_matches(lower(text), 'dni|documento') AND regexp_matches(lower(text), 'listado|lista|alumnos|estudiantes')), false) AS personal_data FROM lt LEFT JOIN tx ON lt.page_id = tx.page_id GROUP BY topic),
pl AS (SELECT topic, count(*) AS links, count_if(kind = 'pdf') AS pdf_links, count(DISTINCT CASE WHEN kind = 'google_sheet' THEN url END) AS sheet_links, count(DISTINCT CASE WHEN kind = 'system' THEN url END) AS system_links FROM k JOIN lt ON k.page_id = lt.page_id GROUP BY topic),
ro AS (SELECT pp.*, coalesce(links, 0) AS links, coalesce(pdf_links, 0) AS pdf_links, coalesce(sheet_links, 0) AS sheet_links, coalesce(system_links, 0) AS system_links FROM pp LEFT JOIN pl ON pp.topic = pl.topic),
rr AS (SELECT *, list_filter([CASE WHEN has_iframe THEN '{topics.REASONS[0]}' END, CASE WHEN sheet_links > 0 THEN '{topics.REASONS[1]}' END, CASE WHEN personal_data THEN '{topics.REASONS[2]}' END, CASE WHEN system_links > 0 THEN '{topics.REASONS[3]}' END, CASE WHEN failed > 0 THEN '{topics.REASONS[4]}' END], lambda x: x IS NOT NULL) AS rs FROM ro)"""

QUERIES = {f.__name__: f for f in (topic_rollup, topic_documents, link_appendices, sheet_complements, zone_dates, safe_paths, locale_ranks)}
SQL = {
    "topic_rollup": f"WITH {_ROLLED} SELECT topic, pages, failed, pages_with_content, has_iframe, personal_data, links, pdf_links, sheet_links, system_links, array_to_string(rs, ';') AS reasons, len(rs) > 0 AS requires_review FROM rr",
    "topic_documents": f"""
WITH {_ROLLED} SELECT topic, replace('# Tema ' || topic || '~~## Resumen~~- **Páginas**: ' || pages || '~- **Con contenido**: ' || pages_with_content || '~- **Links**: ' || links || '~- **PDF**: ' || pdf_links
  || CASE WHEN len(rs) > 0 THEN '~~## Motivos de revisión~~- ' || array_to_string(rs, '~- ') ELSE '' END || '~~**Última revisión automática**: {TODAY}', '~', chr(10)) AS md FROM rr""",
    "link_appendices": f"WITH {pg._ANCHORS}, m AS (SELECT page_id, '## Enlaces' || chr(10) || chr(10) || string_agg('- [' || text || '](' || url || ')', chr(10) ORDER BY ord) AS md FROM k GROUP BY page_id) SELECT page_id, length(md) AS length, sha256(md) AS hash FROM m",
    "sheet_complements": f"""
WITH {sh._EXAM}, m AS (SELECT sheet, '| Código | Materia |' || chr(10) || '| :--- | :--- |' || chr(10) || string_agg('| ' || code || ' | ' || subject || ' |', chr(10) ORDER BY r) AS t, 'Planilla ' || sheet || CASE WHEN sheet % 2 = 0 THEN '.CSV' ELSE '.xlsx' END AS name FROM exam GROUP BY sheet),
d AS (SELECT sheet, replace('# Planilla ' || sheet || '~~## Contenido~~' || t || '~~## Metadatos del Documento~~- **Origen**: carpeta (`' || name || '`)~- **Fecha de modificación**: `{TODAY}`~- **Categoría**: Complemento Institucional~~## Fuentes consultadas~~- [' || name || '](https://example.org/' || sheet || ')', '~', chr(10)) AS md FROM m)
SELECT sheet, length(md) AS length, sha256(md) AS hash FROM d""",
    "zone_dates": "SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d') AS day FROM events",
    "safe_paths": "SELECT doc_id, CASE WHEN doc_id % 4 < 2 AND doc_id % 5 <> 0 AND doc_id % 7 <> 0 THEN CASE WHEN doc_id % 4 = 0 THEN 'kb/' ELSE 'cursos/' END || doc_id || '.md' END AS path FROM documents",
    "locale_ranks": "WITH n AS (SELECT n_nationkey, n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN 'á' ELSE 'a' END || lower(n_name) AS name FROM nation) SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY strip_accents(name), name) AS place FROM n",
}
