"""Queries over document texts: keys, cleaning, dates, sections, lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import dates, keys, text
from docmill.jobs import sqltext as s
from docmill.operators import sections
from docmill.sources.tables import table


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *(columns or ("text",)))


def _head() -> Column:
    return F.substring_index("text", "\n", 1)


def slugify_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY-01 to KEY-04: four kinds of slugs of each document's first line."""
    h = _head()
    dated = F.concat(h, F.lit(" 2026"))
    return _docs(spark, sf_dir).select("doc_id", keys.slug(h).alias("slug"), keys.slug(h, None).alias("slug_or_empty"), keys.course_slug(h).alias("course_slug"), keys.dated_slug(dated).alias("dated_slug"))


def title_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY-05 over whole texts, as a hash, and of the first line."""
    return _docs(spark, sf_dir).select("doc_id", keys.title_key(_head()).alias("title_key"), keys.content_hash(keys.title_key(F.col("text"))).alias("text_key_hash"))


def token_set_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY-06: word sets of first lines, as if they were names."""
    return _docs(spark, sf_dir).select("doc_id", keys.name_key(_head()).alias("name_key"))


def folder_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY-07: folder names with and without their ordinal prefix."""
    raw = F.concat(F.lpad((F.col("doc_id") % 20).cast("string"), 2, "0"), F.lit(" - "), "source", F.lit("_"), F.upper("lang"))
    key = keys.folder_key(raw)
    return _docs(spark, sf_dir, "source", "lang").select("doc_id", key.alias("folder"), keys.without_number(key).alias("folder_name"))


def doc_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY-09: number of keywords, and of distinct ones."""
    k = _docs(spark, sf_dir).select("doc_id", keys.keywords(F.col("text")).alias("k"))
    return k.select("doc_id", F.size("k").alias("n_keywords"), F.size(F.array_distinct("k")).alias("n_distinct"), keys.content_hash(F.array_join(F.array_sort(F.array_distinct("k")), " ")).alias("keyword_hash"))


def doc_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY-10, KEY-11, TXT-13: hashes of the text, of the date-neutral text, and of a field list."""
    dated = F.concat("text", F.lit("\nUpdated 2026-05-21"))
    return _docs(spark, sf_dir, "text", "lang", "source", "n_chars").select(
        "doc_id", keys.content_hash(F.col("text")).alias("text_hash"), keys.content_hash(text.neutral_date(dated, "2026-05-21")).alias("neutral_hash"), keys.fields_hash(F.col("lang"), F.col("source"), F.col("n_chars")).alias("fields_hash")
    )


def sanitize_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-11: runs of rules and padding, added to each text, shortened."""
    long = F.concat("text", F.lit("\n|:------|=====|"), F.repeat(F.lit("-"), (F.col("doc_id") % 90).cast("int")), F.repeat(F.lit(" "), (F.col("doc_id") % 200).cast("int")), F.lit("|____|"))
    clean = text.sanitize_runs(long)
    return _docs(spark, sf_dir).select("doc_id", F.length(clean).alias("length"), keys.content_hash(clean).alias("hash"))


def scrub_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-12 over whole texts, numbers added in front and behind, as length and hash."""
    number = F.lpad((F.col("doc_id") % 1000).cast("string"), 3, "0")
    given = F.concat(F.lit("DNI 23.701."), number, F.lit(" "), "text", F.lit(" DNI N° 23.701."), number, F.lit(" y (D.N.I. 38.898.177) fin"))
    scrubbed = text.scrub_ids(given)
    return _docs(spark, sf_dir).select("doc_id", F.length(scrubbed).alias("length"), keys.content_hash(scrubbed).alias("hash"))


def clean_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-08, TXT-09, TXT-10: lengths and hash of normalized texts."""
    t = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", text.clean_length(t).alias("clean_length"), F.length(text.normalize_spaces(t)).alias("spaced_length"), keys.content_hash(text.student_text(t)).alias("student_hash"))


def fenced_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-14, TXT-18: texts taken out of a fence that every second one has, and their first heading."""
    fenced = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("```markdown\n# Title "), F.col("doc_id").cast("string"), F.lit("\n"), "text", F.lit("\n```"))).otherwise(F.col("text"))
    bare = text.strip_fence(fenced)
    return _docs(spark, sf_dir).select("doc_id", F.length(bare).alias("length"), text.h1_title(bare, F.lit("untitled")).alias("title"))


def table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-15: first lines as table cells and as subject names."""
    return _docs(spark, sf_dir).select("doc_id", text.clean_cell(_head()).alias("cell"), text.clean_subject(F.concat(F.lit('- "'), _head(), F.lit('"'))).alias("subject"))


def cut_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-16, TXT-21: the part between markers that are put around each text."""
    given = F.concat(F.lit("Inicio\n"), F.when(F.col("doc_id") % 3 == 0, F.lit("Requisitos\n")).otherwise(F.lit("")), "text", F.lit("\nCONSULTAS\nwrite to us"))
    body = text.cut_noise(given)
    return _docs(spark, sf_dir).select("doc_id", F.length(body).alias("length"), keys.content_hash(body).alias("hash"))


ACRONYMS = ("IVA", "AFIP", "PYME", "TIC", "RRHH")


def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-17: words of the first line with capitals, acronyms kept."""
    return _docs(spark, sf_dir).select("doc_id", text.title_case(F.concat(_head(), F.lit(" iva pyme")), ACRONYMS).alias("titled"))


def text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT-01, DAT-02, DAT-05: dates written into each text, found again, missing days and overflows resolved."""
    d = F.col("doc_id")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    given = F.concat(F.lit("Inicio: "), (d % 28 + 1).cast("string"), F.lit("/"), (d % 12 + 1).cast("string"), F.lit("/2025 x "), (d % 150 + 1960).cast("string"), F.lit("-"), two(d % 14 + 1), F.lit(" y "), two(d % 31 + 1), F.lit("/02/2024"))
    rows = _docs(spark, sf_dir).select("doc_id", given.alias("t"))
    found = rows.select("doc_id", dates.start_date(F.col("t")).alias("start"), dates.iso_date(F.substr("t", F.lit(-10))).alias("iso"), dates.dates_in(F.col("t")).alias("f"))
    return found.select("doc_id", "start", "iso", F.array_join(F.array_sort(F.transform("f", lambda x: F.concat(x.found, F.lit("="), x.day.cast("string")))), ";").alias("dates"))


def weekday_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01, STR-02: weekday and hours taken apart and put together."""
    day = F.element_at(F.array(*[F.lit(x) for x in ("Lunes", "Martes", "Ver horarios", "Miércoles", "")]), (F.col("doc_id") % 5 + 1).cast("int"))
    given = F.concat(day, F.lit(" "), F.when(F.col("doc_id") % 3 > 0, F.concat((F.col("doc_id") % 24).cast("string"), F.lit("  hs"))).otherwise(F.lit("")))
    one = dates.split_weekday(given)
    return _docs(spark, sf_dir).select("doc_id", one.alias("o")).select("doc_id", "o.day", "o.hours", dates.join_weekday(F.col("o.day"), F.col("o.hours")).alias("both"))


def md_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-04, WIN-02: sections of each document's Markdown."""
    md = sections.with_headings(_docs(spark, sf_dir))
    out = sections.md_sections(md, "doc_id", "md")
    return out.select("doc_id", "ord", "name", F.length("body").alias("length"), keys.content_hash(F.col("body")).alias("hash"))


def named_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-05: parts of each text below known headings, which stand before every fourth line."""
    heads = F.array(F.lit("Objetivos"), F.lit("COSTO"), F.lit("evaluacion"))
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.when(i % 4 == 3, F.concat(F.element_at(heads, (i % 3 + 1).cast("int")), F.lit("\n"), x)).otherwise(x))
    out = sections.named_sections(_docs(spark, sf_dir).withColumn("t", F.array_join(lines, "\n")), "doc_id", "t")
    return out.select("doc_id", "name", F.length("body").alias("length"), keys.content_hash(F.col("body")).alias("hash"))


def bullet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-11: texts as list items."""
    b = text.bullets(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", b.alias("b")).select("doc_id", F.size("b").alias("n_items"), keys.content_hash(F.array_join("b", "\n")).alias("hash"))


def name_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-08: names in one cell apart (line breaks, semicolons, hyphens between spaces; commas stay), without hyphens at their ends."""
    cell = F.concat(F.lit("- "), _head(), F.lit(" -; N/D  - "), F.substring_index("text", " ", 2), F.lit("<br/>x, y-"))
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(keys.split_names(cell)).alias("ord", "name"))


_H = "split_part(text, chr(10), 1)"
_MD = "array_to_string([CASE WHEN (i - 1) % 3 = 2 THEN '## Part ' || ((i - 1) // 3) || chr(10) || l[i] ELSE l[i] END for i in range(1, len(l) + 1)], chr(10))"
_GIVEN = "'DNI 23.701.' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || ' ' || text || ' DNI N° 23.701.' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || ' y (D.N.I. 38.898.177) fin'"
_NUMBER = rf"(?i)(^|[^A-Za-z0-9_])D\.?{s.WS}*N\.?{s.WS}*I\.?{s.WS}*(?:N[°º]?|:)?{s.WS}*\d(?:\d|\.|{s.WS}){{5,}}\d"
_SCRUBBED = s.rr(s.rr(_GIVEN, _NUMBER, r"'\1DNI [omitido]'"), rf"(?i)\({s.WS}*D\.?N\.?I\.?[^)]*\)", "'(DNI [omitido])'")

QUERIES = {
    f.__name__: f
    for f in (slugify_docs, title_key, token_set_key, folder_keys, doc_keywords, doc_hashes, sanitize_runs, scrub_ids, clean_length, fenced_text, table_cells, cut_noise, title_case, text_dates, weekday_cells, md_sections, named_sections, bullet_lines, name_lists)
}
SQL = {
    "slugify_docs": f"SELECT doc_id, {s.slug(_H)} AS slug, {s.slug(_H, None)} AS slug_or_empty, substr(replace({s.title_key(_H)}, ' ', '-'), 1, 120) AS course_slug, {s.slug(_H, None)} AS dated_slug FROM documents",
    "title_key": f"SELECT doc_id, {s.title_key(_H)} AS title_key, sha256({s.title_key('text')}) AS text_key_hash FROM documents",
    "token_set_key": f"SELECT doc_id, {s.name_key(_H)} AS name_key FROM documents",
    "folder_keys": f"SELECT doc_id, folder, regexp_replace(folder, '^\\d+{s.WS}*[-_]{s.WS}*', '') AS folder_name FROM (SELECT doc_id, {s.folder_key("lpad(CAST(doc_id % 20 AS VARCHAR), 2, '0') || ' - ' || source || '_' || upper(lang)")} AS folder FROM documents)",
    "doc_keywords": f"SELECT doc_id, len(k) AS n_keywords, len(list_distinct(k)) AS n_distinct, sha256(array_to_string(list_sort(list_distinct(k)), ' ')) AS keyword_hash FROM (SELECT doc_id, {s.keywords('text')} AS k FROM documents)",
    "doc_hashes": "SELECT doc_id, sha256(text) AS text_hash, sha256(replace(text || chr(10) || 'Updated 2026-05-21', '2026-05-21', '{DATE}')) AS neutral_hash, sha256('=' || lang || chr(31) || '=' || source || chr(31) || '=' || n_chars) AS fields_hash FROM documents",
    "sanitize_runs": f"""
SELECT doc_id, length(t) AS length, sha256(t) AS hash FROM (SELECT doc_id, {s.rr(s.rr(s.rr(s.rr(s.rr("text || chr(10) || '|:------|=====|' || repeat('-', CAST(doc_id % 90 AS INTEGER)) || repeat(' ', CAST(doc_id % 200 AS INTEGER)) || '|____|'", ":-{4,}", "':---'"), "-{4,}", "'---'"), "={4,}", "'==='"), "_{4,}", "'___'"), " {80,}", "' '")} AS t FROM documents)""",
    "scrub_ids": f"SELECT doc_id, length(t) AS length, sha256(t) AS hash FROM (SELECT doc_id, {_SCRUBBED} AS t FROM documents)",
    "clean_length": f"""
SELECT doc_id, length({s.squeeze('text')}) AS clean_length, length({s.normalize_spaces('text')}) AS spaced_length,
  sha256(array_to_string(list_filter(list_transform({s.lines(s.normalize_spaces('text'))}, lambda x: {s.normalize_spaces('x')}), lambda x: lower(x) NOT IN ('', 'image', 'iframe')), chr(10))) AS student_hash FROM documents""",
    "fenced_text": "SELECT doc_id, length(text) + CASE WHEN doc_id % 2 = 0 THEN length('# Title ' || doc_id) + 1 ELSE 0 END AS length, CASE WHEN doc_id % 2 = 0 THEN 'Title ' || doc_id ELSE 'untitled' END AS title FROM documents",
    "table_cells": f"SELECT doc_id, coalesce(nullif({s.squeeze(f'replace({_H}, chr(124), chr(47))')}, ''), 'N/D') AS cell, {s.squeeze(s.rr(s.rr(_H, '[“”' + chr(34) + chr(39) + ']'), f'^(?:-|{s.WS})+'))} AS subject FROM documents",
    "cut_noise": f"SELECT doc_id, length(b) AS length, sha256(b) AS hash FROM (SELECT doc_id, {s.normalize_spaces('CASE WHEN doc_id % 3 = 0 THEN ' + chr(39) + 'Requisitos' + chr(39) + ' || chr(10) || text ELSE ' + chr(39) + 'Inicio' + chr(39) + ' || chr(10) || text END')} AS b FROM documents)",
    "title_case": f"SELECT doc_id, {s.title_case(f"({_H} || ' iva pyme')", ACRONYMS)} AS titled FROM documents",
    "text_dates": """
WITH p AS (SELECT doc_id, doc_id % 28 + 1 AS d1, doc_id % 12 + 1 AS m1, doc_id % 150 + 1960 AS y, doc_id % 14 + 1 AS m, doc_id % 31 + 1 AS d FROM documents)
SELECT doc_id, '2025-' || lpad(CAST(m1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(d1 AS VARCHAR), 2, '0') AS start, '2024-02-' || lpad(CAST(d AS VARCHAR), 2, '0') AS iso,
  array_to_string(list_sort(list_filter([CASE WHEN y BETWEEN 2000 AND 2100 THEN y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '=' || CAST(make_date(y, 1, 1) + to_months(CAST(m - 1 AS INTEGER)) + to_days(27) AS DATE) END,
    CASE WHEN d1 >= 10 AND m1 >= 10 THEN d1 || '/' || m1 || '/2025=' || CAST(make_date(2025, m1, d1) AS DATE) END,
    lpad(CAST(d AS VARCHAR), 2, '0') || '/02/2024=' || CAST(DATE '2024-02-01' + CAST(d - 1 AS INTEGER) AS DATE)], lambda x: x IS NOT NULL)), ';') AS dates FROM p""",
    "weekday_cells": """
WITH g AS (SELECT doc_id, ['Lunes', 'Martes', 'Ver horarios', 'Miércoles', ''][doc_id % 5 + 1] AS w, CASE WHEN doc_id % 3 > 0 THEN (doc_id % 24) || ' hs' ELSE '' END AS h FROM documents),
o AS (SELECT doc_id, CASE WHEN w IN ('Lunes', 'Martes', 'Miércoles') THEN w ELSE 'N/D' END AS day, coalesce(nullif(CASE WHEN w IN ('Lunes', 'Martes', 'Miércoles') THEN h ELSE trim(w || ' ' || h) END, ''), 'N/D') AS hours FROM g)
SELECT doc_id, day, hours, CASE WHEN day <> 'N/D' AND hours <> 'N/D' THEN day || ' — ' || hours WHEN day <> 'N/D' THEN day WHEN hours <> 'N/D' THEN hours ELSE 'N/D' END AS "both" FROM o""",
    "md_sections": f"""
WITH m AS (SELECT doc_id, {_MD} AS md FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
x AS (SELECT doc_id, unnest(string_split('## __preface__' || chr(10) || md, chr(10))) AS line, unnest(range(len(string_split(md, chr(10))) + 1)) AS pos FROM m),
h AS (SELECT *, regexp_extract(line, '^##{s.WS}+(.+?){s.WS}*$', 1) AS head FROM x), r AS (SELECT *, sum(CASE WHEN head <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM h),
g AS (SELECT doc_id, run, max(head) AS name, {s.trim("coalesce(string_agg(CASE WHEN head = '' THEN line END, chr(10) ORDER BY pos), '')")} AS body FROM r GROUP BY doc_id, run),
o AS (SELECT doc_id, name, min(run) AS first, arg_max(body, run) AS body FROM g GROUP BY doc_id, name)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first) - 1 AS INTEGER) AS ord, name, length(body) AS length, sha256(body) AS hash FROM o""",
    "named_sections": f"""
WITH t AS (SELECT doc_id, array_to_string([CASE WHEN (i - 1) % 4 = 3 THEN ['Objetivos', 'COSTO', 'evaluacion'][(i - 1) % 3 + 1] || chr(10) || l[i] ELSE l[i] END for i in range(1, len(l) + 1)], chr(10)) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
x AS (SELECT doc_id, {s.normalize_spaces('line')} AS line, pos FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM t)),
h AS (SELECT *, CASE line WHEN 'Objetivos' THEN 'Objetivos' WHEN 'COSTO' THEN 'Costo' WHEN 'evaluacion' THEN 'Evaluación' END AS head FROM x WHERE line <> ''),
r AS (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM h),
g AS (SELECT doc_id, run, coalesce(max(head), 'Información adicional') AS name, string_agg(CASE WHEN head IS NULL THEN line END, chr(10) ORDER BY pos) AS body FROM r GROUP BY doc_id, run),
o AS (SELECT doc_id, name, arg_max(body, run) AS body FROM g WHERE body <> '' GROUP BY doc_id, name)
SELECT doc_id, name, length(body) AS length, sha256(body) AS hash FROM o""",
    "bullet_lines": f"SELECT doc_id, len(b) AS n_items, sha256(array_to_string(b, chr(10))) AS hash FROM (SELECT doc_id, [CASE WHEN regexp_matches(x, '^[-*]{s.WS}+') THEN x ELSE '- ' || x END for x in list_filter([{s.squeeze('y')} for y in string_split(coalesce(text, ''), chr(10))], lambda z: z <> '')] AS b FROM documents)",
    "name_lists": f"""
WITH g AS (SELECT doc_id, '- ' || {_H} || ' -; N/D  - ' || array_to_string(string_split(text, ' ')[1:2], ' ') || chr(10) || 'x, y-' AS cell FROM documents),
c AS (SELECT doc_id, list_filter([{s.trim(s.rr('y', f'^[-{s.WS[1:-1]}]+|[-{s.WS[1:-1]}]+$'))} for y in string_split({s.rr('cell', f'[;' + chr(92) + f'n]+|{s.WS}+-{s.WS}+', 'chr(10)')}, chr(10))], lambda z: z <> '' AND upper(z) <> 'N/D') AS p FROM g)
SELECT doc_id, unnest(p) AS name, CAST(unnest(range(len(p))) AS INTEGER) AS ord FROM c""",
}
