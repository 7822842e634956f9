"""Queries over files: given tables are landed as trees, sheets, registries and indexes in the shared folder, and read back as such."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import keys, urls
from docmill.jobs import sqltext as s
from docmill.session import shared_folder
from docmill.sources import landed, tree
from docmill.sources.tables import table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drive_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11, SRC-12, SRC-14: every page is a file below its host; some are word files, some of a kind without a reader, some not UTF-8, some not to be indexed."""
    p = table(spark, sf_dir, "pages")
    n = F.col("page_id")
    kind = F.when(n % 5 == 1, "doc").when(n % 5 == 2, "bin").when(n % 5 == 3, "md").otherwise("html")
    path = F.concat(F.when(n % 7 == 0, "No_Indexar/").otherwise(""), F.coalesce(F.nullif(urls.host(F.col("url")), F.lit("")), F.lit("none")), F.lit("/"), n.cast("string"), F.lit("."), kind)
    content = F.when(n % 11 == 0, F.unhex(F.lit("FFFE"))).otherwise(F.col("html").cast("binary"))
    out = _folder(spark, "drive")
    tree.write(p.select(path.alias("path"), content.alias("content")), out)
    files = tree.read(spark, out).where("NOT contains(lower(path), 'no_indexar')").select("path", "modified", "length", "content", F.col("error").alias("unread"))
    read = landed.extract(files.where("unread IS NULL OR path LIKE '%.doc'").drop("unread"))
    return read.select("path", "length", F.length("text").alias("n_chars"), "error").unionByName(files.where("unread IS NOT NULL AND path NOT LIKE '%.doc'").select("path", "length", F.lit(None).cast("int").alias("n_chars"), F.lit("not UTF-8").alias("error")))


def sheet_tabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-08, SRC-09: orders as sheets of at most 200 rows, a file each; a sheet that can't be read is a tab that isn't ok, and the others have their cells."""
    o = table(spark, sf_dir, "orders")
    line = F.concat_ws(",", "o_orderkey", F.concat(F.lit('"'), F.trim("o_orderpriority"), F.lit('"')), "o_orderstatus")
    # a sheet has 200 keys at most
    sheets = o.groupBy(F.floor(F.col("o_orderkey") / 200).alias("sheet")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))), lambda x: x.line), "\n").alias("csv"))
    content = F.when(F.col("sheet") % 17 == 3, F.unhex(F.lit("41FF"))).otherwise(F.col("csv").cast("binary"))
    out = _folder(spark, "sheets")
    tree.write(sheets.select(F.concat(F.lit("year/"), F.col("sheet").cast("string"), F.lit(".csv")).alias("path"), content.alias("content")), out)
    cells = landed.tree_sheets(spark, out).groupBy(F.col("sheet").alias("tab")).agg(F.count("*").alias("cells"), F.countDistinct("r").alias("rows"))
    return landed.tabs(spark, out).select("tab", "ok").join(cells, "tab", "left").select("tab", "ok", F.coalesce("cells", F.lit(0)).alias("cells"), F.coalesce("rows", F.lit(0)).alias("rows"))


def markdown_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-16: pages as Markdown files; those in folders below aren't read, nor those of another kind."""
    p = table(spark, sf_dir, "pages")
    n = F.col("page_id")
    path = F.concat(F.when(n % 3 == 0, "below/").otherwise(""), F.col("page_id").cast("string"), F.when(n % 5 == 0, ".txt").otherwise(".md"))
    out = _folder(spark, "markdown")
    tree.write(p.select(path.alias("path"), F.concat(F.lit("# "), F.col("url"), F.lit("\n\n"), F.col("html")).alias("content")), out)
    return landed.markdown(spark, out).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.length("markdown").alias("length"), keys.content_hash(F.col("markdown")).alias("hash"))


def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-07, SRC-21: the sources of all documents as a registry file, read back with their places."""
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    row = F.struct(F.col("source").alias("slug"), F.concat(F.lit("kb/"), "source", F.lit(".md")).alias("indice_path"), F.concat(F.lit("https://example.org/"), "source").alias("url"), F.when(F.col("n") % 2 == 0, "section").otherwise("microsite").alias("strategy"), F.col("n").cast("int").alias("maxPages"))
    out = _folder(spark, "registry")
    # a registry is one file by nature; it has a row for each source
    text = d.agg(F.to_json(F.struct(F.array_sort(F.collect_list(row)).alias("sources"))).alias("content")).select(F.lit("sources.json").alias("path"), "content")
    tree.write(text, out)
    return landed.registry(spark, f"{out}/sources.json").select("pos", "place", "slug", "indice_path", "url", "strategy", "maxPages")


def index_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-15: each source's languages as an index file, read back with title keys and slugs."""
    d = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    row = F.struct(F.concat("lang", F.lit("/"), "source", F.lit(".md")).alias("path"), F.concat(F.lit("Título  de "), "source", F.lit(": "), F.upper("lang")).alias("title"), F.col("lang").alias("category"), F.when(F.col("n") % 2 == 0, "a").alias("sector"))
    out = _folder(spark, "index")
    tree.write(d.agg(F.to_json(F.struct(F.array_sort(F.collect_list(row)).alias("items"))).alias("content")).select(F.lit("index.json").alias("path"), "content"), out)
    return landed.index(spark, f"{out}/index.json").select("pos", "path", "title", "category", "sector", "title_key", "slug")


def taxonomy_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-19, RUL-01: a taxonomy file with a sector for each language, whose rules are three of its sources; every document is routed by it."""
    d = table(spark, sf_dir, "documents")
    sources = d.groupBy("lang").agg(F.slice(F.array_sort(F.collect_set("source")), 1, 3).alias("pathPrefix"))
    sector = F.struct(F.concat(F.lit("s-"), "lang").alias("key"), F.struct(F.struct("pathPrefix").alias("match")).alias("value"))
    spec = sources.agg(F.array_sort(F.collect_list(sector)).alias("s"))
    text = spec.select(F.lit("taxonomy.json").alias("path"), F.to_json(F.struct(F.map_from_entries("s").alias("sectors"), F.lit("rest").alias("fallback"), F.array(F.struct(F.lit("s-en").alias("sector"), F.struct(F.array(F.lit("9")).alias("titleIncludes")).alias("match"), F.lit(True).alias("force"))).alias("overrides"))).alias("content"))
    out = _folder(spark, "taxonomy")
    tree.write(text, out)
    rules = landed.taxonomy(spark, f"{out}/taxonomy.json")
    rows = d.select("doc_id", F.col("source").alias("path"), F.col("doc_id").cast("string").alias("title"), F.col("lang").alias("category"), F.lit(None).cast("string").alias("sector"))
    return rows.select("doc_id", rules.route().alias("routed"))


QUERIES = {f.__name__: f for f in (drive_texts, sheet_tabs, markdown_files, source_registry, index_file, taxonomy_file)}
_HOST = r"coalesce(nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), ''), 'none')"
SQL = {
    "drive_texts": f"""
WITH p AS (SELECT page_id AS n, html, {_HOST} AS host, CASE page_id % 5 WHEN 1 THEN 'doc' WHEN 2 THEN 'bin' WHEN 3 THEN 'md' ELSE 'html' END AS kind, page_id % 11 = 0 AS bad FROM pages WHERE page_id % 7 <> 0)
SELECT host || '/' || n || '.' || kind AS path, CASE WHEN bad THEN 2 ELSE strlen(html) END AS length,
  CASE WHEN kind = 'doc' AND NOT bad THEN length({s.trim(s.rr(s.rr("array_to_string([chr(CAST(('0x' || b) AS INTEGER)) for b in regexp_extract_all(hex(encode(html)), '..')], '')", r'[^\x20-\x7E\x{A0}-\x{FF}\n]+', "' '"), ' {2,}', "' '"))})
    WHEN kind = 'doc' THEN 2 WHEN bad OR kind = 'bin' THEN NULL ELSE length(html) END AS n_chars,
  CASE WHEN kind = 'doc' THEN NULL WHEN bad THEN 'not UTF-8' WHEN kind = 'bin' THEN 'no reader for bin' END AS error FROM p""",
    "sheet_tabs": """
SELECT CAST(o_orderkey // 200 AS VARCHAR) AS tab, (o_orderkey // 200) % 17 <> 3 AS ok, CASE WHEN (o_orderkey // 200) % 17 <> 3 THEN 3 * count(*) ELSE 0 END AS cells, CASE WHEN (o_orderkey // 200) % 17 <> 3 THEN count(*) ELSE 0 END AS rows FROM orders GROUP BY o_orderkey // 200""",
    "markdown_files": "SELECT page_id || '.md' AS file, length(m) AS length, sha256(m) AS hash FROM (SELECT page_id, '# ' || url || chr(10) || chr(10) || html AS m FROM pages WHERE page_id % 3 <> 0 AND page_id % 5 <> 0)",
    "source_registry": """
SELECT CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS pos, 'sources[' || (row_number() OVER (ORDER BY source) - 1) || ']' AS place, source AS slug, 'kb/' || source || '.md' AS indice_path, 'https://example.org/' || source AS url,
  CASE WHEN n % 2 = 0 THEN 'section' ELSE 'microsite' END AS strategy, CAST(n AS INTEGER) AS "maxPages" FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)""",
    "index_file": f"""
WITH g AS (SELECT lang || '/' || source || '.md' AS path, 'Título  de ' || source || ': ' || upper(lang) AS title, lang AS category, CASE WHEN count(*) % 2 = 0 THEN 'a' END AS sector, source AS slug FROM documents GROUP BY source, lang)
SELECT CAST(row_number() OVER (ORDER BY path) - 1 AS INTEGER) AS pos, path, title, category, sector, {s.title_key('title')} AS title_key, slug FROM g""",
    "taxonomy_file": """
WITH r AS (SELECT lang, list_sort(list(DISTINCT source))[1:3] AS prefixes FROM documents GROUP BY lang),
f AS (SELECT doc_id, min('s-' || r.lang) AS routed FROM documents d JOIN r ON len(list_filter(r.prefixes, lambda p: starts_with(d.source, p))) > 0 GROUP BY doc_id)
SELECT doc_id, CASE WHEN CAST(doc_id AS VARCHAR) LIKE '%9%' THEN 's-en' ELSE coalesce(routed, 'rest') END AS routed FROM documents LEFT JOIN f USING (doc_id)""",
}
