"""Queries that check documents and report on them. Programme texts with defects are made of the documents table by remainders of doc_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import keys, urls
from docmill.functions import text as tx
from docmill.jobs import sqltext as s
from docmill.operators import checks, reports, sections
from docmill.sources import landed
from docmill.sources.tables import table

TODAY = "2026-05-21"
#: The heading below which a made programme has its document's text; its dates are checked too.
TEXT_BELOW = "Aranceles e inscripción"


def _late(c: Column) -> Column:
    """Whole texts, of which one in seven ends in a phrase, placeholder, fence or heading that a check must report."""
    n = F.col("doc_id")
    return F.when(n % 28 == 0, F.concat(c, F.lit("\nEs un placer informarle"))).when(n % 28 == 7, F.concat(c, F.lit(" {Fecha de inicio}"))).when(n % 28 == 14, F.concat(c, F.lit("\n## Contenido\n```"))).when(n % 28 == 21, F.concat(c, F.lit(" Vence: 10/11/2024"))).otherwise(c)


def _programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A programme per document: every heading but one in eleven, two of them swapped in one of thirteen, and other defects.

    The whole text, to which one in seven adds a late defect, stands below one heading, a remark below the others.
    """
    n = F.col("doc_id")
    cohort = F.concat(F.lit("Inicio: "), (n % 40 + 1995).cast("string"), F.lit("-"), F.lpad((n % 12 + 1).cast("string"), 2, "0"), F.when(n % 4 == 0, " a confirmar").otherwise(""))
    parts = []
    for k, name in enumerate(checks.REQUIRED):
        body = cohort if name == "Próxima cohorte" else _late(F.col("text")) if name == TEXT_BELOW else F.lit("Ver ficha")
        one = F.concat(F.lit(f"## {name}\n"), body, F.lit("\n"))
        parts.append(F.when(n % 11 != k, one).otherwise(F.lit("")))
    parts = [F.when(n % 13 == 0, parts[1]).otherwise(parts[0]), F.when(n % 13 == 0, parts[0]).otherwise(parts[1]), *parts[2:]]
    body = F.concat(
        F.when(n % 17 == 0, "").otherwise(F.concat(F.lit("# Programme "), n.cast("string"), F.lit("\n"))),
        *parts,
        F.when(n % 6 == 0, "Quedamos a disposición\n").otherwise(""),
        F.when(n % 8 == 0, "```\ncode\n```\n").otherwise(""),
        F.when(n % 5 == 0, F.concat(F.repeat(F.lit("{Nombre del curso} "), (n % 9).cast("int")), F.lit("{a/b c}"))).otherwise(""),
        F.when(n % 3 == 0, "").otherwise("**Última revisión humana**: 2026-01-15"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars", body.alias("md"))


def structure_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-01, FLT-06."""
    return _programmes(spark, sf_dir).select("doc_id", F.array_join(checks.structure(F.col("md")), ";").alias("missing"))


def prohibited_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-02, VAL-04."""
    return _programmes(spark, sf_dir).select("doc_id", F.array_join(checks.prohibited(F.col("md")), ";").alias("prohibited"), checks.no_closing(F.col("md")).alias("no_closing"))


def placeholder_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-03, ORD-04."""
    return _programmes(spark, sf_dir).select("doc_id", F.array_join(checks.placeholders(F.col("md")), ";").alias("placeholders"), F.length(reports.preview(F.col("md"))).alias("preview_length"))


def size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-06: each text against the one with the next id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    other = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("current"))
    return d.join(other, "doc_id", "left").select("doc_id", checks.size_gate(F.col("text"), F.col("current")).alias("gate"))


def stale_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-05, DAT-05: past dates in dated sections."""
    return checks.stale_dates(sections.md_sections(_programmes(spark, sf_dir), "doc_id", "md"), "doc_id", TODAY)


def document_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-08, VAL-05, EXP-10: all checks together, as counts."""
    p = _programmes(spark, sf_dir).withColumn("current", F.when(F.col("doc_id") % 9 == 0, F.repeat("md", F.lit(4))).when(F.col("doc_id") % 9 == 1, F.substr("md", F.lit(1), F.lit(100))))
    return checks.validate(p, "doc_id", "md", "current", TODAY).select("doc_id", "ok", F.size("errors").alias("n_errors"), F.size("warnings").alias("n_warnings"), F.size("urls").alias("n_urls"))


FOLDERS, FORBIDDEN = ("docs", "cursos", "more"), ("docs/x0.md",)


def _index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """An index, files and routing with defects of all kinds, by remainders of doc_id."""
    n = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    name = n.cast("string")
    path = (
        F.when(n % 43 == 2, F.lit(None)).when(n % 41 == 0, F.concat(F.lit("docs/x"), n % 82, F.lit(".md"))).when(n % 50 == 3, F.concat(F.lit("cursos/"), F.element_at(F.array(F.lit("overview"), F.lit("Listado-Cursos"), name), (n / 50 % 3 + 1).cast("int")), F.lit(".md")))
        .when(n % 37 == 5, F.concat(F.lit("/abs/"), name, F.lit(".md"))).when(n % 37 == 6, F.concat(F.lit("docs/../"), name, F.lit(".md"))).when(n % 37 == 7, F.concat(F.lit("docs/"), name, F.lit(".txt"))).when(n % 37 == 8, F.concat(F.lit("docs\\"), name, F.lit(".md")))
        .when(n % 47 == 4, F.concat(F.lit("other/"), name, F.lit(".md"))).when(n % 6 == 1, F.concat(F.lit("more/deep/"), name, F.lit(".md"))).otherwise(F.concat(F.lit("docs/"), name, F.lit(".md")))
    )
    d = d.withColumn("path", path)
    head = F.substring_index("text", "\n", 1)
    index = d.where("doc_id % 10 <> 7").select(
        "path", F.when(n % 19 == 0, F.lit(None)).when(n % 19 == 1, " - ").when(n % 2 == 0, F.upper(head)).otherwise(head).alias("title"), F.when(n % 23 == 0, F.lit(None)).otherwise(F.col("lang")).alias("category"),
        F.when(n % 31 == 0, "ftp://x").when(n % 31 == 1, "").when(n % 3 == 0, "https://example.org/x").alias("url"), n.alias("pos"),
    )
    files = d.where("doc_id % 12 <> 5 AND path IS NOT NULL").groupBy("path").agg((F.max(n) % 8 != 0).alias("is_file"))
    return index, files, d.where("doc_id % 14 <> 2 AND path IS NOT NULL").groupBy("path").agg(F.when(F.max(n) % 9 == 0, "nowhere").otherwise("a").alias("sector"))


def index_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-09, JOI-12, JOI-13, FLT-05, WIN-04."""
    index, files, routing = _index(spark, sf_dir)
    return checks.index_violations(index, ("a", "b"), FOLDERS, files, routing, 0, "2026-5-1", FORBIDDEN)


def course_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-11, AGG-13: parts as a catalog, with defects by remainders of their keys."""
    n = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(
        n.alias("pos"), F.when(n % 90 == 1, F.lit(None)).otherwise(F.concat(F.lit("c"), n % 1900)).alias("slug"), F.when(n % 100 == 1, "").otherwise(F.col("p_name")).alias("title"), keys.title_key(F.when(n % 100 == 1, "").otherwise(F.col("p_name"))).alias("title_key"),
        F.when(n % 70 == 1, "x").when(n % 70 == 2, F.lit(None)).otherwise(F.lit("https://example.org/c")).alias("detail_url"), F.when(n % 80 == 1, "mailto:x").when(n % 80 == 2, "").alias("signup_url"), F.when(n % 85 == 1, "/q").when(n % 2 == 0, "http://example.org/q").alias("query_url"),
        F.when(n % 60 == 1, "1/2/2026").when(n % 60 == 3, "").when(n % 2 == 0, "2026-02-01").alias("start_date"),
    )
    counts = p.agg((F.count("*") - 1).alias("active"), F.lit(-1).alias("matched"), F.count_if(F.col("slug").isNull()).alias("new"), F.lit(None).cast("int").alias("missing"))
    return checks.catalog_violations(p, counts)


def freshness_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FRS-01, FRS-02, ORD-01, DAT-03, JOI-11, SNK-07: staleness of every document, in the report's order within its source."""
    n = F.col("doc_id")
    d = table(spark, sf_dir, "documents")
    day = F.date_add(F.lit("2025-06-01").cast("date"), (n % 300).cast("int")).cast("string")
    md = F.when(n % 5 == 0, F.concat(F.lit("x PENDIENTE — draft autogenerado el "), day)).when(n % 5 < 3, F.concat(F.lit("**Última revisión humana**: "), day)).otherwise("none")
    items = d.select(n.cast("string").alias("path"), F.concat(F.lit("T"), n).alias("title"), F.col("source").alias("category"), md.alias("md"))
    sources = d.where("doc_id % 3 <> 0").select(n.cast("string").alias("path"), F.concat(F.lit("s"), n % 40).alias("slug"), n.alias("ord"))
    state = spark.range(0, 40).where("id % 4 <> 0").select(F.concat(F.lit("s"), "id").alias("slug"), F.expr("timestamp'2026-05-20 12:00:00' - make_dt_interval(CAST(id AS int))").alias("checked"))
    r = reports.freshness(items, sources, state, TODAY)
    return reports.urgency_place(r, "category").select("path", "category", "review_status", "human_days", "auto_days", "human_icon", "auto_icon", "place")


def candidate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-03 to RND-05, SNK-02, EXP-11: a document made of each page's text, as length and hash."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", tx.title(F.col("html")).alias("title"), tx.html_to_text(tx.crop_main(F.col("html"))).alias("text"))
    md = reports.document(F.col("title"), {"Contenido": F.array_join(tx.bullets(F.col("text")), "\n"), "Fuentes consultadas": F.concat(F.lit("- "), urls.normalized(F.col("url")))}, F.lit(f"**Última revisión automática**: {TODAY}"))
    return p.select("page_id", F.length(md).alias("length"), keys.content_hash(md).alias("hash"))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-06, SNK-06: the counts of index violations as a Markdown list, per severity."""
    c = index_violations(spark, sf_dir).groupBy("severity", "rule").agg(F.count("*").alias("n"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("rule", F.concat(F.lit("- **"), "rule", F.lit("**: "), F.col("n").cast("string")).alias("line")))), lambda x: x.line)
    return c.groupBy("severity").agg(F.array_join(lines, "\n").alias("md"))


def listing_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13, SRC-17, JOI-15: the longer of two extractions of each text, and whether a listed date is missing from it."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("layer"))
    model = d.where("doc_id % 3 <> 0").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat("layer", F.lit(" 2026-03-01"))).otherwise(F.lit("")).alias("model"))
    both = d.join(model, "doc_id", "left").withColumn("model", F.coalesce("model", F.lit("")))
    best = landed.longer(F.col("layer"), F.col("model"))
    return both.select("doc_id", F.length(best).alias("length"), (~best.contains("2026-03-01")).alias("drifted"))


_LATE = """text || CASE n % 28 WHEN 0 THEN chr(10) || 'Es un placer informarle' WHEN 7 THEN ' {{Fecha de inicio}}' WHEN 14 THEN chr(10) || '## Contenido' || chr(10) || '```' WHEN 21 THEN ' Vence: 10/11/2024' ELSE '' END"""
_COHORT = "'Inicio: ' || (n % 40 + 1995) || '-' || lpad(CAST(n % 12 + 1 AS VARCHAR), 2, '0') || CASE WHEN n % 4 = 0 THEN ' a confirmar' ELSE '' END"
_PARTS = [f"CASE WHEN n % 11 <> {k} THEN '## {name}' || chr(10) || {_COHORT if name == 'Próxima cohorte' else f"({_LATE})" if name == TEXT_BELOW else "'Ver ficha'"} || chr(10) ELSE '' END" for k, name in enumerate(checks.REQUIRED)]
_P = f"""p AS (SELECT doc_id, n, CASE WHEN n % 17 = 0 THEN '' ELSE '# Programme ' || n || chr(10) END || CASE WHEN n % 13 = 0 THEN {_PARTS[1]} || {_PARTS[0]} ELSE {_PARTS[0]} || {_PARTS[1]} END || {' || '.join(_PARTS[2:])}
  || CASE WHEN n % 6 = 0 THEN 'Quedamos a disposición' || chr(10) ELSE '' END || CASE WHEN n % 8 = 0 THEN '```' || chr(10) || 'code' || chr(10) || '```' || chr(10) ELSE '' END
  || CASE WHEN n % 5 = 0 THEN repeat('{{Nombre del curso}} ', CAST(n % 9 AS INTEGER)) || '{{a/b c}}' ELSE '' END || CASE WHEN n % 3 = 0 THEN '' ELSE '**Última revisión humana**: 2026-01-15' END AS md FROM (SELECT *, doc_id AS n FROM documents))"""
_P = _P.replace("{{", "{").replace("}}", "}")


def _in_order(name: str, required: tuple[str, ...]) -> str:
    """CTEs name0, name1, ...: what is left of md behind each required heading in turn, and which are missing."""
    out = [f"{name}0 AS (SELECT doc_id, md AS rest, CAST([] AS VARCHAR[]) AS missing FROM p)"]
    for k, heading in enumerate(required):
        pattern = f"^##{s.WS}+{heading}{s.WS}*$"
        found = f"regexp_matches(rest, '(?m){pattern}')"
        out.append(f"{name}{k + 1} AS (SELECT doc_id, CASE WHEN {found} THEN regexp_replace(rest, '(?ms)\\A.*?{pattern}', '') ELSE rest END AS rest, CASE WHEN {found} THEN missing ELSE list_append(missing, '{heading}') END AS missing FROM {name}{k})")
    return ", ".join(out)


_FOUND = r"list_filter(regexp_extract_all(md, '\{[A-ZÁÉÍÓÚÑa-záéíóúñ][^{}\n]{2,80}\}'), lambda x: NOT contains(x, '/') AND NOT contains(x, '@'))"
_VERDICTS = f"""{_P}, {_in_order("prog", checks.REQUIRED)}, {_in_order("comp", checks.REQUIRED_COMPLEMENT)},
v AS (SELECT doc_id, n, md, CASE WHEN coalesce(starts_with(list_filter(string_split(md, chr(10)), lambda x: {s.trim('x')} <> '')[1], '# '), false) THEN [] ELSE ['H1'] END || CASE WHEN contains(md, '## Contenido') THEN c.missing ELSE r.missing END AS missing,
  list_filter([{s.names(checks.PROHIBITED)}], lambda x: contains(md, x)) || CASE WHEN regexp_matches(md, '(?m)^```') THEN ['code'] ELSE [] END AS prohibited, {_FOUND}[1:5] || CASE WHEN len({_FOUND}) > 5 THEN [(len({_FOUND}) - 5) || ' more'] ELSE [] END AS placeholders,
  NOT contains(md, '## Contenido') AND NOT contains(md, '**Última revisión humana**') AS no_closing FROM p JOIN prog{len(checks.REQUIRED)} r USING (doc_id) JOIN comp{len(checks.REQUIRED_COMPLEMENT)} c USING (doc_id))"""
_INDEX = f"""
d AS (SELECT doc_id AS n, lang, split_part(text, chr(10), 1) AS head, CASE WHEN doc_id % 43 = 2 THEN NULL WHEN doc_id % 41 = 0 THEN 'docs/x' || (doc_id % 82) || '.md' WHEN doc_id % 50 = 3 THEN 'cursos/' || ['overview', 'Listado-Cursos', doc_id::VARCHAR][(doc_id // 50) % 3 + 1] || '.md'
  WHEN doc_id % 37 = 5 THEN '/abs/' || doc_id || '.md' WHEN doc_id % 37 = 6 THEN 'docs/../' || doc_id || '.md' WHEN doc_id % 37 = 7 THEN 'docs/' || doc_id || '.txt' WHEN doc_id % 37 = 8 THEN 'docs\\' || doc_id || '.md'
  WHEN doc_id % 47 = 4 THEN 'other/' || doc_id || '.md' WHEN doc_id % 6 = 1 THEN 'more/deep/' || doc_id || '.md' ELSE 'docs/' || doc_id || '.md' END AS path FROM documents),
i AS (SELECT n, path, CASE WHEN n % 19 = 0 THEN NULL WHEN n % 19 = 1 THEN ' - ' WHEN n % 2 = 0 THEN replace(upper(head), 'ẞ', 'SS') ELSE head END AS title, CASE WHEN n % 23 <> 0 THEN lang END AS category, CASE WHEN n % 31 = 0 THEN 'ftp://x' WHEN n % 31 = 1 THEN '' WHEN n % 3 = 0 THEN 'https://example.org/x' END AS url FROM d WHERE n % 10 <> 7),
f AS (SELECT path, max(n) % 8 <> 0 AS is_file FROM d WHERE n % 12 <> 5 AND path IS NOT NULL GROUP BY path), g AS (SELECT path, CASE WHEN max(n) % 9 = 0 THEN 'nowhere' ELSE 'a' END AS routed FROM d WHERE n % 14 <> 2 AND path IS NOT NULL GROUP BY path),
k AS (SELECT i.*, f.is_file, g.routed, {s.title_key('title')} AS tk FROM i LEFT JOIN f USING (path) LEFT JOIN g USING (path) WHERE path IS NOT NULL),
m AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY n) > 1 AS pa, tk <> '' AND row_number() OVER (PARTITION BY tk ORDER BY n) > 1 AS ta FROM k),
w AS (SELECT 'error' AS severity, path AS key, 'no_title' AS rule FROM m WHERE coalesce(title, '') = '' UNION ALL SELECT 'error', path, 'no_category' FROM m WHERE category IS NULL UNION ALL SELECT 'error', path, 'not_markdown' FROM m WHERE path NOT LIKE '%.md'
  UNION ALL SELECT 'error', path, 'unsafe_path' FROM m WHERE path LIKE '/%' OR path LIKE '%..%' OR contains(path, '\\') UNION ALL SELECT 'error', path, 'forbidden' FROM m WHERE path = 'docs/x0.md'
  UNION ALL SELECT 'warning', path, 'unknown_folder' FROM m WHERE split_part(path, '/', 1) NOT IN ('docs', 'cursos', 'more') UNION ALL SELECT 'error', path, 'no_file' FROM m WHERE is_file IS NULL UNION ALL SELECT 'error', path, 'not_a_file' FROM m WHERE NOT is_file
  UNION ALL SELECT 'error', path, 'bad_url' FROM m WHERE url IN ('', 'ftp://x') UNION ALL SELECT 'error', path, 'not_routed' FROM m WHERE routed IS NULL UNION ALL SELECT 'error', path, 'bad_sector' FROM m WHERE routed = 'nowhere'
  UNION ALL SELECT 'error', path, 'aggregate' FROM m WHERE path IN ('cursos/overview.md', 'cursos/Listado-Cursos.md') UNION ALL SELECT 'error', path, 'path_repeated' FROM m WHERE pa UNION ALL SELECT 'warning', path, 'title_repeated' FROM m WHERE ta
  UNION ALL SELECT 'error', 'items[' || n || ']', 'no_path' FROM i WHERE path IS NULL UNION ALL SELECT 'error', 'index', 'version' UNION ALL SELECT 'error', 'index', 'last_updated'
  UNION ALL SELECT 'warning', path, 'not_indexed' FROM f WHERE is_file AND regexp_matches(path, '^(docs|cursos|more)/[^/]*[.]md$') AND path NOT IN (SELECT path FROM k))"""
_DATES = "".join(f""",
s{k} AS (SELECT doc_id, regexp_extract(md, '(?ms)^##{s.WS}+{name}{s.WS}*?$(.*?)(?:^##{s.WS}|\\z)', 1) AS body FROM v),
x{k} AS (SELECT doc_id, unnest(regexp_extract_all(body, '[0-9]{{4}}-[0-9]{{2}}(?:-[0-9]{{2}})?') || regexp_extract_all(body, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')) AS found FROM s{k} WHERE NOT regexp_matches(body, '(?i)no publicado|consultar|cerrada|a confirmar|por confirmar'))""" for k, name in enumerate(checks.DATED)) + """,
xs AS (SELECT * FROM x0 UNION ALL SELECT * FROM x1),
ys AS (SELECT doc_id, CASE WHEN contains(found, '/') THEN string_split(found, '/') ELSE list_reverse(string_split(found || CASE WHEN length(found) = 7 THEN '-28' ELSE '' END, '-')) END AS a FROM xs),
past AS (SELECT doc_id, count(*) AS n_past FROM ys WHERE CAST(a[3] AS INTEGER) BETWEEN 2000 AND 2100 AND make_date(CASE WHEN CAST(a[3] AS INTEGER) BETWEEN 2000 AND 2100 THEN CAST(a[3] AS INTEGER) ELSE 2000 END, 1, 1) + to_months(CAST(a[2] AS INTEGER) - 1) + to_days(CAST(a[1] AS INTEGER) - 1) < DATE '2026-05-21' GROUP BY doc_id)"""

QUERIES = {f.__name__: f for f in (structure_check, prohibited_check, placeholder_check, size_gate, stale_dates, document_check, index_violations, course_violations, freshness_rank, candidate_documents, run_summary, listing_merge)}
SQL = {
    "structure_check": f"WITH {_VERDICTS} SELECT doc_id, array_to_string(missing, ';') AS missing FROM v",
    "prohibited_check": f"WITH {_VERDICTS} SELECT doc_id, array_to_string(prohibited, ';') AS prohibited, no_closing FROM v",
    "placeholder_check": f"WITH {_VERDICTS} SELECT doc_id, array_to_string(placeholders, ';') AS placeholders, length(array_to_string(string_split(md, chr(10))[1:8], chr(10))) AS preview_length FROM v",
    "stale_dates": rf"""
WITH {_P}, x AS (SELECT doc_id, unnest(string_split(md, chr(10))) AS line, unnest(range(len(string_split(md, chr(10))))) AS pos FROM p),
h AS (SELECT *, nullif(regexp_extract(line, '^##{s.WS}+(.+?){s.WS}*$', 1), '') AS head FROM x), r AS (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM h),
g AS (SELECT doc_id, run, max(head) AS name, string_agg(CASE WHEN head IS NULL THEN line END, chr(10) ORDER BY pos) AS body FROM r GROUP BY doc_id, run),
o AS (SELECT doc_id, name, arg_max(coalesce(body, ''), run) AS body FROM g WHERE name IN ({s.names(checks.DATED)}) GROUP BY doc_id, name),
f AS (SELECT doc_id, name, unnest(regexp_extract_all(body, '\d{{4}}-\d{{2}}(?:-\d{{2}})?') || regexp_extract_all(body, '\d{{2}}/\d{{2}}/\d{{4}}')) AS found FROM o WHERE NOT regexp_matches(body, '(?i)no publicado|consultar|cerrada|a confirmar|por confirmar')),
y AS (SELECT *, CASE WHEN contains(found, '/') THEN string_split(found, '/') ELSE list_reverse(string_split(found || CASE WHEN length(found) = 7 THEN '-28' ELSE '' END, '-')) END AS a FROM f)
SELECT doc_id, name, found FROM y WHERE CAST(a[3] AS INTEGER) BETWEEN 2000 AND 2100 AND make_date(CASE WHEN CAST(a[3] AS INTEGER) BETWEEN 2000 AND 2100 THEN CAST(a[3] AS INTEGER) ELSE 2000 END, 1, 1) + to_months(CAST(a[2] AS INTEGER) - 1) + to_days(CAST(a[1] AS INTEGER) - 1) < DATE '2026-05-21'""",
    "document_check": f"""
WITH {_VERDICTS}{_DATES}, u AS (SELECT v.*, coalesce(n_past, 0) AS n_past, length(md) / nullif(CASE WHEN n % 9 = 0 THEN 4 * length(md) WHEN n % 9 = 1 THEN least(length(md), 100) END, 0) AS ratio FROM v LEFT JOIN past USING (doc_id)),
e AS (SELECT doc_id, len(missing) + len(prohibited) + len(placeholders) + CASE WHEN no_closing THEN 1 ELSE 0 END + CASE WHEN ratio < 0.3 THEN 1 ELSE 0 END AS n_errors, n_past + CASE WHEN ratio > 3.0 THEN 1 ELSE 0 END + CASE WHEN regexp_matches(md, '(?i)PENDIENTE — draft autogenerado') THEN 1 ELSE 0 END AS n_warnings,
  len(list_distinct(regexp_extract_all(regexp_extract(md, '(?ms)^##{s.WS}+Fuentes consultadas{s.WS}*?$.*', 0), 'https?://[^\\s)<>"''`]+[^\\s)<>"''`.,;:]'))) AS n_urls FROM u)
SELECT doc_id, n_errors = 0 AS ok, n_errors, n_warnings, n_urls FROM e""",
    "size_gate": "SELECT a.doc_id, CASE WHEN length(b.text) > 0 THEN CASE WHEN length(a.text) / length(b.text) < 0.3 THEN 'error' WHEN length(a.text) / length(b.text) > 3.0 THEN 'warning' ELSE 'ok' END END AS gate FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 1",
    "index_violations": f"WITH {_INDEX} SELECT severity, key, rule FROM w",
    "course_violations": f"""
WITH p AS (SELECT p_partkey AS n, 'active[' || p_partkey || ']' AS key, CASE WHEN p_partkey % 90 <> 1 THEN 'c' || (p_partkey % 1900) END AS slug, CASE WHEN p_partkey % 100 = 1 THEN '' ELSE {s.title_key('p_name')} END AS tk FROM part),
m AS (SELECT *, slug IS NOT NULL AND row_number() OVER (PARTITION BY slug ORDER BY n) > 1 AS sa, tk <> '' AND row_number() OVER (PARTITION BY tk ORDER BY n) > 1 AS ta FROM p)
SELECT 'error' AS severity, key, 'no_title' AS rule FROM m WHERE n % 100 = 1 UNION ALL SELECT 'error', key, 'no_slug' FROM m WHERE slug IS NULL UNION ALL SELECT 'error', key, 'bad_detail_url' FROM m WHERE n % 70 IN (1, 2) UNION ALL SELECT 'error', key, 'bad_signup_url' FROM m WHERE n % 80 = 1
UNION ALL SELECT 'error', key, 'bad_query_url' FROM m WHERE n % 85 = 1 UNION ALL SELECT 'error', key, 'bad_date' FROM m WHERE n % 60 = 1 UNION ALL SELECT 'error', key, 'slug_repeated' FROM m WHERE sa UNION ALL SELECT 'warning', key, 'title_repeated' FROM m WHERE ta
UNION ALL SELECT 'error', 'catalog', unnest(['matched_count', 'missing_count', 'rows']) UNION ALL SELECT 'warning', 'catalog', 'new_rows'""",
    "freshness_rank": """
WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS path, source AS category, doc_id AS n, CASE WHEN doc_id % 5 < 3 THEN DATE '2025-06-01' + CAST(doc_id % 300 AS INTEGER) END AS day FROM documents),
r AS (SELECT path, category, CASE WHEN n % 5 = 0 THEN 'draft' WHEN n % 5 < 3 THEN 'reviewed' ELSE 'pending' END AS review_status, CAST(DATE '2026-05-21' - day AS INTEGER) AS human_days, CASE WHEN n % 3 <> 0 AND (n % 40) % 4 <> 0 THEN CAST(n % 40 AS INTEGER) END AS auto_days FROM d)
SELECT path, category, review_status, human_days, auto_days, CASE WHEN human_days IS NULL OR human_days > 180 THEN 'red' WHEN review_status = 'draft' THEN 'yellow' ELSE 'green' END AS human_icon, CASE WHEN auto_days IS NULL OR auto_days > 14 THEN 'red' ELSE 'green' END AS auto_icon,
  row_number() OVER (PARTITION BY category ORDER BY review_status = 'reviewed', human_days DESC NULLS FIRST, auto_days DESC NULLS FIRST, path) AS place FROM r""",
    "candidate_documents": f"""
WITH t AS (SELECT page_id, url, {s.title('html')} AS title, {s.html_to_text(s.crop_main('html'))} AS text FROM pages),
b AS (SELECT page_id, url, title, array_to_string([CASE WHEN regexp_matches(x, '^[-*]{s.WS}+') THEN x ELSE '- ' || x END for x in list_filter([{s.squeeze('y')} for y in string_split(text, chr(10))], lambda z: z <> '')], chr(10)) AS items, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)) || coalesce(nullif(regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/+$', ''), ''), '/') AS link FROM t),
m AS (SELECT page_id, concat_ws(chr(10) || chr(10), '# ' || title, CASE WHEN items <> '' THEN '## Contenido' || chr(10) || chr(10) || items END, '## Fuentes consultadas' || chr(10) || chr(10) || '- ' || link, '**Última revisión automática**: 2026-05-21') AS md FROM b)
SELECT page_id, length(md) AS length, sha256(md) AS hash FROM m""",
    "run_summary": f"WITH {_INDEX}, c AS (SELECT severity, rule, count(*) AS n FROM w GROUP BY ALL) SELECT severity, string_agg('- **' || rule || '**: ' || n, chr(10) ORDER BY rule) AS md FROM c GROUP BY severity",
    "listing_merge": "SELECT doc_id, CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 = 0 THEN length(text) + 11 ELSE length(text) END AS length, NOT (doc_id % 3 <> 0 AND doc_id % 2 = 0 OR text LIKE '%2026-03-01%') AS drifted FROM documents",
}
