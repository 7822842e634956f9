"""Queries over landed web pages: extraction, links, sections of a site, crawl."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import keys, text, urls
from docmill.jobs import sqltext as s
from docmill.operators import crawl, links, sync
from docmill.operators import section_documents as section_docs
from docmill.sources.tables import table


def page_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-01 to TXT-05, TXT-07, KEY-10: title, text, length and hash of every page."""
    return links.process_pages(table(spark, sf_dir, "pages"), text.crop_main).select("page_id", "url", "title", "text", "length", "content_hash")


def page_blog_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-06, TXT-07, SRC-04: the same for pages with a content container; articles stand in for containers."""
    pages = table(spark, sf_dir, "pages").withColumn("html", F.regexp_replace("html", "<article>", '<div class="post blog-content">'))
    return links.process_pages(pages, text.blog_content).select("page_id", "url", "title", "text", "length", "content_hash")


def page_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-02, SRC-06: strategy of each source by its host, and whether its page may be fetched (SRC-03); others are skipped."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    strategy = F.when(F.startswith(urls.host("url"), F.lit("www.")), "homepage").when(F.startswith(urls.host("url"), F.lit("blog.")), "single_page").when(F.startswith(urls.host("url"), F.lit("m.")), "skipped").otherwise("microsite")
    return pages.select("page_id", strategy.alias("strategy"), F.when(strategy == "skipped", F.lit(None)).otherwise(urls.normalized(F.col("url"))).alias("fetch_url"), urls.is_http(F.col("url")).alias("valid"))


def menu_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-01, WIN-03: menu links of each page, first occurrences in order."""
    return links.menu_links(table(spark, sf_dir, "pages"), r"""(?i)<a(?![A-Za-z0-9_])[^>]*href\s*=\s*["'](/[^"']*)["']""").select("page_id", "ord", "link")


def section_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-02, URL-01, URL-02, URL-05: links inside a site section, pages and documents apart."""
    return links.section_links(table(spark, sf_dir, "pages"), F.lit("/")).select("page_id", "kind", "link", "ord")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-03, URL-04: anchors with text and kind, distinct by url."""
    return links.anchors(table(spark, sf_dir, "pages"), system_hosts=("tionsh.example.net",), internal_suffixes=("example.net", "example.com"), system_words=("/the",)).select("page_id", "ord", "text", "url", "kind")


def link_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-05, AGG-11: link counts by kind over all pages."""
    return page_links(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("links"), F.countDistinct("url").alias("urls"), F.countDistinct("page_id").alias("pages"))


def page_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-03, FLT-04, AGG-05: risk signals of each site host, merged over its pages."""
    return links.host_signals(table(spark, sf_dir, "pages"), word=r"(?i)(nicht|pour)", second=r"(?i)(und|une)")


def section_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY-08, FLT-01, FLT-02, WIN-04, RUL-04: class and target document of every crawled page."""
    return links.section_candidates(table(spark, sf_dir, "pages"), prefix="/en", section_id="english", folder="kb").select("page_id", "slug", "path", "class", "collision")


def site_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RUL-04, RND-05, KEY-08, FLT-03: every host as a crawled section, with its documents, landing row and appendices; some pages are thin or failed, some have a document or a pending link."""
    n = F.col("page_id")
    p = table(spark, sf_dir, "pages").withColumn("section", F.coalesce(F.nullif(urls.host(F.col("url")), F.lit("")), F.lit("none")))
    read = F.when(n % 3 == 0, "corto").otherwise(text.html_to_text(text.crop_main(F.col("html"))))
    pages = p.select("section", n.alias("ord"), "url", text.title(F.col("html")).alias("title"), read.alias("text"), F.when(n % 13 == 5, "HTTP 500").alias("error"))
    found = p.where("page_id % 6 = 0").select("section", n.alias("ord"), F.lit("document").alias("kind"), F.concat("url", F.lit(".pdf")).alias("url")).unionByName(p.where("page_id % 7 = 0").select("section", n.alias("ord"), F.lit("pending").alias("kind"), F.concat("url", F.lit("/more")).alias("url")))
    about = p.select("section").distinct().select("section", F.replace("section", F.lit("."), F.lit("-")).alias("section_id"), F.concat(F.lit("Sitio "), "section").alias("name"), F.lit("kb").alias("folder"), F.lit("/en").alias("prefix"), (F.length("section") % 2 == 0).alias("truncated"))
    docs = section_docs.candidates(pages, found, about, "2026-05-21", "el sitio", "el asistente")
    return docs.select("section", "slug", "path", "url", "is_root", F.size("review_reasons").alias("n_reasons"), F.length("md").alias("length"), keys.content_hash(F.col("md")).alias("hash"))


def section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-03: pages of each class per host."""
    found = links.section_candidates(table(spark, sf_dir, "pages"), prefix="/en", section_id="english", folder="kb")
    return found.groupBy("host").agg(*[F.count_if(F.col("class") == c).alias(c) for c in ("important", "low", "archive", "errored")])


def crawl_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRF-01 without caps: depth of every page below its root. Real links do not resolve, so page k is linked from (k - 1) div 3."""
    pages = table(spark, sf_dir, "pages").select("page_id")
    edges = pages.where("page_id > 0").select(F.expr("(page_id - 1) div 3").alias("src"), F.col("page_id").alias("dst"))
    return crawl.reach(edges, pages.where("page_id = 0").select(F.col("page_id").alias("node")))


def crawl_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRF-01, ORD-05, SET-03: the same crawl with a depth and page budget, and what is left pending."""
    pages = table(spark, sf_dir, "pages").select("page_id")
    edges = pages.where("page_id > 0").select(F.expr("(page_id - 1) div 3").alias("src"), F.col("page_id").alias("dst"))
    return crawl.capped(edges, pages.where("page_id = 0").select(F.col("page_id").alias("node")), max_depth=4, max_pages=80)


def site(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages, links and roots of a site with faults: the tree of page ids with links back, one in eleven pages leads to the one before, one in thirteen can't be read."""
    n = F.col("page_id")
    pages = table(spark, sf_dir, "pages").select("page_id")
    found = pages.select(n.alias("node"), F.when(n % 11 == 10, n - 1).otherwise(n).alias("final"), (n % 13 == 12).alias("failed"))
    down = pages.where("page_id > 0").select(F.expr("(page_id - 1) div 3").alias("node"), (n % 3).cast("int").alias("ord"), n.alias("dst"))
    back = pages.where("page_id > 0").select(n.alias("node"), F.lit(5).alias("ord"), F.expr("page_id div 2").alias("dst"))
    return found, down.unionByName(back), pages.where("page_id = 0").select(n.alias("node"), F.lit(0).alias("ord"))


def crawl_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRF-01, SRC-05: a crawl of at most 200 pages with redirects, pages that fail, and links back; tested against a plain loop."""
    return crawl.crawl(*site(spark, sf_dir), max_depth=6, max_pages=200)


def raw_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-19, SNK-01: one raw text per host, its pages in order."""
    pages = links.process_pages(table(spark, sf_dir, "pages"), text.crop_main).withColumn("host", urls.host("url"))
    one = F.format_string("=== %s ===\n%s\n%s", "url", "title", "text")
    out = sync.stream_hash(pages.select("host", "page_id", one.alias("block")), ["host"], ["page_id", "block"], "block", "\n\n")
    return out.select("host", F.col("n").alias("n_pages"), F.col("hash").alias("raw_hash"), F.col("length").alias("raw_length"))


def url_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-21, SET-01, SET-02, EXP-10, VAL-10: urls of three places with the place they come from, distinct, with a validity flag."""
    pages = table(spark, sf_dir, "pages")
    index = pages.select("url", F.format_string("index[%d]", "page_id").alias("place"))
    registry = pages.where("page_id % 5 = 0").select("url", F.format_string("sources[%d]", F.expr("page_id div 5")).alias("place"))
    inline = pages.select(F.explode(F.regexp_extract_all("html", F.lit(r"""https?://[^\s"'<>)]+"""), F.lit(0))).alias("url"), F.format_string("page[%d]", "page_id").alias("place"))
    return links.check_urls([index, registry, inline])


def _pages_sql(content: str, source: str = "pages") -> str:
    return f"""
WITH c AS (SELECT page_id, url, html, {content} AS main FROM {source}),
t AS (SELECT page_id, url, coalesce(nullif({s.section_title('main')}, ''), {s.title('html')}) AS title, {s.html_to_text('main')} AS text FROM c)
SELECT page_id, url, title, text, length(text) AS length, sha256(text) AS content_hash FROM t"""


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1))"
_ORIGIN = "lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1))"
_PATH = "coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), ''), '/')"
_NORMAL = f"CASE WHEN {_ORIGIN} = '' THEN url ELSE {_ORIGIN} || coalesce(nullif({s.rr(_PATH, '/+$')}, ''), '/') END"
_ANCHORS = rf"""
a AS (
  SELECT page_id, url AS base, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*href\s*=\s*["'']([^"'']+)["''][^>]*>(.*?)</a>', 1)) AS href,
    unnest(regexp_extract_all(html, '(?is)<a\b[^>]*href\s*=\s*["'']([^"'']+)["''][^>]*>(.*?)</a>', 2)) AS inner_html,
    unnest(range(len(regexp_extract_all(html, '(?is)<a\b[^>]*href\s*=\s*["'']([^"'']+)["''][^>]*>(.*?)</a>', 1)))) AS pos
  FROM pages
), r AS (SELECT page_id, pos, lower(regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)) || trim({s.decode('href')}) AS url, {s.normalize_spaces(s.html_to_text('inner_html'))} AS text FROM a),
f AS (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY pos) AS rn FROM r),
k AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS ord, coalesce(nullif(text, ''), url) AS text, url,
  CASE WHEN {_HOST} = 'docs.google.com' AND lower(url) LIKE '%/spreadsheets/%' THEN 'google_sheet' WHEN lower(url) LIKE '%.pdf' OR lower(url) LIKE '%.pdf?%' THEN 'pdf'
  WHEN {_HOST} = 'tionsh.example.net' OR lower(url) LIKE '%/the%' THEN 'system' WHEN {_HOST} LIKE '%example.net' OR {_HOST} LIKE '%example.com' THEN 'internal' ELSE 'external' END AS kind
  FROM f WHERE rn = 1)"""
_SECTION = rf"""
p AS (SELECT page_id, url, {_HOST} AS host, {s.rr(_PATH, '/+$')} AS path, {s.html_to_text(s.crop_main('html'))} AS text FROM pages),
b AS (SELECT *, list_filter(string_split(CASE WHEN starts_with(lower(path), '/en') THEN substr(path, 4) ELSE path END, '/'), lambda x: x <> '' AND lower(x) <> 'categorias') AS parts,
  list_contains(list_transform(string_split(path, '/'), lambda x: lower(x)), 'categorias') AS archive FROM p),
d AS (SELECT *, CASE WHEN len(parts) = 0 THEN 'english' ELSE {s.slug("array_to_string(parts, '-')")} END AS base FROM b),
k AS (SELECT page_id, host, base, CASE WHEN text = '' THEN 'errored' WHEN archive THEN 'archive' WHEN length({s.squeeze('text')}) >= 200 THEN 'important' ELSE 'low' END AS class FROM d),
x AS (SELECT page_id, host, 'english-' || base AS slug, 'kb/' || base || '.md' AS path, class, class = 'important' AND row_number() OVER (PARTITION BY base, class = 'important' ORDER BY page_id) > 1 AS collision FROM k)"""

QUERIES = {f.__name__: f for f in (page_extract, page_blog_extract, page_landing, menu_links, section_links, page_links, link_kinds, page_signals, section_documents, site_sections, section_counts, crawl_reach, crawl_capped, crawl_site, raw_envelope, url_checks)}
SQL = {
    "page_extract": _pages_sql(s.crop_main("html")),
    "page_blog_extract": _pages_sql(s.blog_content("html"), "(SELECT page_id, url, replace(html, '<article>', '<div class=\"post blog-content\">') AS html FROM pages)"),
    "page_landing": f"""
SELECT page_id, strategy, CASE WHEN strategy = 'skipped' THEN NULL ELSE {_NORMAL} END AS fetch_url, regexp_matches(url, '^(?i)https?://[^/?#\\s]+') AS valid
FROM (SELECT *, CASE WHEN starts_with({_HOST}, 'www.') THEN 'homepage' WHEN starts_with({_HOST}, 'blog.') THEN 'single_page' WHEN starts_with({_HOST}, 'm.') THEN 'skipped' ELSE 'microsite' END AS strategy FROM pages)""",
    "menu_links": rf"""
WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)<a\b[^>]*href\s*=\s*["''](/[^"'']*)["'']', 1)) AS href, unnest(range(len(regexp_extract_all(html, '(?i)<a\b[^>]*href\s*=\s*["''](/[^"'']*)["'']', 1)))) AS pos FROM pages),
r AS (SELECT page_id, pos, {_ORIGIN} || trim(replace(href, '&amp;', '&')) AS link FROM a), f AS (SELECT *, row_number() OVER (PARTITION BY page_id, link ORDER BY pos) AS rn FROM r)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INTEGER) AS ord, link FROM f WHERE rn = 1""",
    "section_links": rf"""
WITH a AS (SELECT page_id, url AS base, unnest(regexp_extract_all(html, '(?i)<a\b[^>]*href\s*=\s*["'']([^"'']+)["'']', 1)) AS href, unnest(range(len(regexp_extract_all(html, '(?i)<a\b[^>]*href\s*=\s*["'']([^"'']+)["'']', 1)))) AS pos FROM pages),
r AS (SELECT page_id, pos, lower(regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)) || trim(replace(href, '&amp;', '&')) AS url FROM a),
k AS (SELECT page_id, pos, CASE WHEN regexp_matches({_PATH}, '(?i)\.(pdf|docx?|xlsx?|pptx?|odt|ods|odp|csv|zip|rar|7z)$') THEN 'document' WHEN regexp_matches({_PATH}, '(?i)\.(jpe?g|png|gif|webp|svg|bmp|tiff?|ico|avif|mp4|webm|mov|avi|mp3|wav|ogg)$|/wp-content/uploads/') THEN 'media' ELSE 'page' END AS kind, url FROM r),
l AS (SELECT page_id, pos, kind, CASE WHEN kind = 'page' THEN {_NORMAL} ELSE url END AS link FROM k WHERE kind <> 'media'),
f AS (SELECT *, row_number() OVER (PARTITION BY page_id, kind, link ORDER BY pos) AS rn FROM l)
SELECT page_id, kind, link, CAST(row_number() OVER (PARTITION BY page_id, kind ORDER BY pos) - 1 AS INTEGER) AS ord FROM f WHERE rn = 1""",
    "page_links": f"WITH {_ANCHORS} SELECT page_id, CAST(ord AS INTEGER) AS ord, text, url, kind FROM k",
    "link_kinds": f"WITH {_ANCHORS} SELECT kind, count(*) AS links, count(DISTINCT url) AS urls, count(DISTINCT page_id) AS pages FROM k GROUP BY kind",
    "page_signals": rf"""
WITH t AS (SELECT {_HOST} AS host, html, lower({s.squeeze(s.html_to_text('html'))}) AS text FROM pages)
SELECT host, bool_or(regexp_matches(html, '(?i)<iframe\b')) AS has_iframe, bool_or(regexp_matches(text, '(?i)(nicht|pour)') AND regexp_matches(text, '(?i)(und|une)')) AS personal_data, count(*) AS n_pages,
  count_if(length(text) >= 80) AS n_useful FROM t GROUP BY host""",
    "section_documents": f"WITH {_SECTION} SELECT page_id, slug, path, class, collision FROM x",
    "site_sections": rf"""
WITH p AS (SELECT page_id AS ord, url, coalesce(nullif({_HOST}, ''), 'none') AS section, {s.rr(_PATH, '/+$')} AS path, {s.title('html')} AS title, CASE WHEN page_id % 3 = 0 THEN 'corto' ELSE {s.html_to_text(s.crop_main('html'))} END AS text, page_id % 13 = 5 AS bad,
  lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)) || coalesce(nullif({s.rr(_PATH, '/+$')}, ''), '/') AS norm FROM pages),
b AS (SELECT *, list_filter(string_split(CASE WHEN starts_with(lower(path), '/en') THEN substr(path, 4) ELSE path END, '/'), lambda x: x <> '') AS steps, replace(section, '.', '-') AS sid FROM p),
k AS (SELECT *, CASE WHEN len(list_filter(steps, lambda x: lower(x) <> 'categorias')) = 0 THEN sid ELSE {s.slug("array_to_string(list_filter(steps, lambda x: lower(x) <> 'categorias'), '-')")} END AS base,
  CASE WHEN bad THEN 'errored' WHEN list_contains(list_transform(steps, lambda x: lower(x)), 'categorias') THEN 'archive' WHEN length({s.squeeze('text')}) >= 200 THEN 'important' ELSE 'low' END AS kind FROM b),
r AS (SELECT section, sid, arg_min(norm, ord) AS root, arg_min(base, ord) AS root_base, length(section) % 2 = 0 AS truncated, string_agg('  - ' || url || '.pdf', '~' ORDER BY ord) FILTER (ord % 6 = 0) AS documents, string_agg('  - ' || coalesce(nullif(title, ''), '(sin título)') || ': ' || url, '~' ORDER BY ord) FILTER (kind = 'low') AS low,
  string_agg('  - ' || url || ' (HTTP 500)', '~' ORDER BY ord) FILTER (kind = 'errored') AS failed, string_agg('  - ' || url || '/more', '~' ORDER BY ord) FILTER (ord % 7 = 0) AS pending FROM k GROUP BY section, sid),
a AS (SELECT *, coalesce(documents, low, failed, CASE WHEN truncated THEN pending END) IS NOT NULL AS material, CASE WHEN coalesce(documents, low, failed, pending) IS NOT NULL THEN '## Enlaces relacionados (no ingeridos)~~el asistente debe entregar estos enlaces para que el usuario los abra; no se incorporó su contenido al documento.~'
  || coalesce('~- **Documentos (PDF / planillas / ofimática)** — link-only, pueden contener datos personales:~' || documents, '') || coalesce('~- **Subpáginas sin contenido textual suficiente** (revisar si conviene incluirlas):~' || low, '')
  || coalesce('~- **Subpáginas que no se pudieron descargar** durante la revisión automática:~' || failed, '')
  || CASE WHEN truncated THEN coalesce('~- ⚠️ **Crawl truncado**: se alcanzó el tope de páginas o profundidad. Estas URLs quedaron sin bajar y deben revisarse (ampliar maxPages/maxDepth si hay contenido útil):~' || pending, '') ELSE '' END END AS appendix FROM r),
i AS (SELECT k.*, norm = root AS is_root, appendix, coalesce(nullif(title, ''), 'Sitio ' || section) AS named, row_number() OVER (PARTITION BY section, base ORDER BY ord) > 1 AS again,
  regexp_matches({s.squeeze('text')}, '(?i)nombre y apellido') OR (regexp_matches({s.squeeze('text')}, '(?i)(?:dni|documento)') AND regexp_matches({s.squeeze('text')}, '(?i)listado|lista|nómina|nomina|alumnos|estudiantes|inscriptos')) AS personal,
  array_to_string([CASE WHEN regexp_matches(x, '^[-*]{s.WS}+') THEN x ELSE '- ' || x END for x in list_filter([{s.squeeze('y')} for y in string_split(text, chr(10))], lambda z: z <> '')], chr(10)) AS items FROM k JOIN a USING (section, sid) WHERE kind = 'important'),
d AS (SELECT section, sid || '-' || base AS slug, 'kb/' || base || '.md' AS path, url, is_root, personal::INT + again::INT AS n_reasons, '# ' || named || replace('~~## Para qué sirve~~- Documento del sector **Sitio ' || section || '** generado automáticamente desde el sitio.~- Es un candidato automático: debe pasar por revisión humana antes de mergearse a `indice.json`.~~## Información publicada~~', '~', chr(10)) || items
  || CASE WHEN is_root THEN coalesce(chr(10) || chr(10) || replace(appendix, '~', chr(10)), '') ELSE '' END || replace('~~## Advertencias para el asistente~~' || CASE WHEN personal THEN '- Requiere revisión humana: posibles datos personales/listados nominales.~' ELSE '' END
  || CASE WHEN again THEN '- Requiere revisión humana: colisión de ruta: kb/' || base || '.md ya fue derivado de otra subpágina.~' ELSE '' END || CASE WHEN NOT personal AND NOT again THEN '- No se detectaron señales automáticas de datos personales; la revisión humana sigue siendo obligatoria.~' ELSE '' END
  || '- No responder con datos personalizados ni detrás de login; derivar al sistema o enlace oficial correspondiente.~~## Fuentes consultadas~~- ', '~', chr(10)) || named || ': ' || url
  || replace('~~---~~**Última revisión automática**: 2026-05-21 (candidato generado por el scraper de secciones WordPress)~**Revisión humana**: pendiente~', '~', chr(10)) AS md FROM i
  UNION ALL SELECT section, sid || '-' || root_base, 'kb/' || root_base || '.md', root, true, 0, replace('# Sitio ' || section || '~~## Para qué sirve~~- Índice de enlaces del sector **Sitio ' || section || '**. La página principal no tenía contenido textual propio suficiente.~- Candidato automático: requiere revisión humana antes de mergearse.~~' || appendix
  || '~~## Advertencias para el asistente~~- Entregar los enlaces de arriba para que el usuario los abra; no se ingirió su contenido.~~---~~**Última revisión automática**: 2026-05-21 (landing de sección)~**Revisión humana**: pendiente~', '~', chr(10)) FROM a WHERE material AND section NOT IN (SELECT section FROM i WHERE is_root))
SELECT section, slug, path, url, is_root, n_reasons, length(md) AS length, sha256(md) AS hash FROM d""",
    "section_counts": f"WITH {_SECTION} SELECT host, count_if(class = 'important') AS important, count_if(class = 'low') AS low, count_if(class = 'archive') AS archive, count_if(class = 'errored') AS errored FROM x GROUP BY host",
    "crawl_reach": "WITH RECURSIVE r AS (SELECT page_id AS node, 0 AS depth FROM pages WHERE page_id = 0 UNION ALL SELECT p.page_id, r.depth + 1 FROM pages p JOIN r ON p.page_id > 0 AND (p.page_id - 1) // 3 = r.node) SELECT node, CAST(depth AS INTEGER) AS depth FROM r",
    "crawl_capped": """
WITH RECURSIVE r AS (SELECT page_id AS node, 0 AS depth FROM pages WHERE page_id = 0 UNION ALL SELECT p.page_id, r.depth + 1 FROM pages p JOIN r ON p.page_id > 0 AND (p.page_id - 1) // 3 = r.node),
f AS (SELECT node, depth FROM (SELECT *, row_number() OVER (ORDER BY depth, node) AS n FROM r WHERE depth <= 4) WHERE n <= 80)
SELECT node, CAST(depth AS INTEGER) AS depth, 'fetched' AS status FROM f
UNION ALL SELECT p.page_id, NULL, 'pending' FROM pages p WHERE p.page_id > 0 AND (p.page_id - 1) // 3 IN (SELECT node FROM f) AND p.page_id NOT IN (SELECT node FROM f)""",
    "raw_envelope": f"""
WITH t AS ({_pages_sql(s.crop_main('html'))}), e AS (SELECT {_HOST} AS host, string_agg('=== ' || url || ' ===' || chr(10) || title || chr(10) || text, chr(10) || chr(10) ORDER BY page_id) AS raw, count(*) AS n_pages FROM t GROUP BY 1)
SELECT host, n_pages, sha256(raw) AS raw_hash, length(raw) AS raw_length FROM e""",
    "url_checks": r"""
WITH u AS (SELECT url, 'index[' || page_id || ']' AS place FROM pages UNION ALL SELECT url, 'sources[' || (page_id // 5) || ']' FROM pages WHERE page_id % 5 = 0
  UNION ALL SELECT unnest(regexp_extract_all(html, 'https?://[^\s"''<>)]+')), 'page[' || page_id || ']' FROM pages)
SELECT DISTINCT url, place, regexp_matches(url, '^(?i)https?://[^/?#\s]+') AS valid FROM u""",
}
