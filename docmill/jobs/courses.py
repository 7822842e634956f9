"""Queries over course listings, from cards to decisions. The listings are made of the pages table: each page stands for one with a few cards, of its title and id."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import keys, text, urls
from docmill.jobs import sqltext as s
from docmill.operators import catalog, listings, sync
from docmill.session import shared_folder
from docmill.sources import landed
from docmill.sources.published import Published
from docmill.sources.tables import table

SITE, TODAY = "https://www.example.org/cursos/", "2026-05-21"


def _titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", text.title(F.col("html")).alias("t"))


def _listing(p: Column, t: Column) -> Column:
    """Up to five cards: a full one; one that repeats its id on every fourth page; one without a link, without an id, and without a title on some."""
    n = lambda c: c.cast("string")
    other = F.when(p % 4 == 0, p).otherwise(p + 1000)
    return F.concat(
        F.lit("<h1>Cursos</h1><div class='curso'><img src='img/encabezados/"), n(p), F.lit(".jpg'><b>"), t, F.lit(" &amp; más</b><br>Inicio: <b>"), n(p % 28 + 1), F.lit("/"), n(p % 12 + 1),
        F.lit("/2026</b><a href='index.php?act=showSubcategoria&amp;id="), n(p), F.lit("'>Más información</a><a href='index.php?act=showLogin&amp;x=1'>i</a></div>"),
        F.lit("<DIV CLASS='curso'><b> Segundo  <i>curso</i>\n"), n(p), F.lit('</b><a href="../ver?act=showSubcategoria&id='), n(other), F.lit('">+</a><a href="?act=showConsulta">?</a><a href="x?id_curso='), n(p), F.lit('">i</a></div>'),
        F.when(p % 3 == 0, "<div class='curso'><b>Sin detalle</b></div>").otherwise(""),
        F.when(p % 5 == 0, "<div class='curso'><b>Libre</b><a href='index.php?act=showSubcategoria'>+</a></div>").otherwise(""),
        F.when(p % 7 == 0, "<div class='curso'><b> </b><a href='index.php?act=showSubcategoria&amp;id=7'>+</a></div>").otherwise(""),
    )


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _titled(spark, sf_dir).select("page_id", _listing(F.col("page_id"), F.col("t")).alias("html"))
    return listings.course_cards(pages, "page_id", "html", f"{SITE}lista.php")


def course_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-06, DAT-01, URL-01: the cards of every listing."""
    return _cards(spark, sf_dir).drop("pos")


def postgraduate_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXP-07, DAT-02, KEY-04: the postgraduate cards of every listing; one in three has no id."""
    return _postgraduate(spark, sf_dir).drop("pos", "raw_title")


def _postgraduate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    n = p.cast("string")
    html = F.concat(
        F.lit("<div class='curso'>\n<div><b>"), F.col("t"), F.lit("\n 2026.</b> Inicio: <b> "), F.when(p % 2 == 0, "05/03/2026").otherwise("5/3/2026"), F.lit(" </b>"),
        F.when(p % 3 == 0, F.concat(F.lit("<a href='/media/cursos-posgrado/"), n, F.lit(".pdf'>F</a>"))).otherwise(""),
        F.when(p % 3 < 2, F.concat(F.lit("<a href='i?act=showLogin&id_posgrado="), (p + 1).cast("string"), F.lit("'>P</a>"))).otherwise(""), F.lit("</div>\n </div>"),
    )
    pages = _titled(spark, sf_dir).select("page_id", html.alias("html"))
    return listings.postgraduate_cards(pages, "page_id", "html", "/media/", "/login?id=")


FACTS, CONTACT, MAIL = {"Unidad académica": "Facultad", "Acreditación": "no aplica"}, {"Email": "cursos@example.org", "Teléfono": "+54 000 0000"}, "cursos@example.org"


def course_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-04, TXT-17: a document for each card, of all twelve sections; their texts are made of the card's title where the page's id leaves one remainder or other."""
    p, t = F.col("page_id"), F.col("title")
    body = {
        "Contenidos": F.when(p % 2 == 0, F.concat(t, F.lit("\n\n * módulo final\n- "), t)),
        "Objetivos": F.lit(""),
        "Docentes": F.when(p % 3 == 0, t),
        "Datos clave del cursado": F.when(p % 5 == 0, t),
        "Evaluación": F.when(p % 3 == 1, F.concat(F.lit("- "), t)),
        "Certificación": F.when(p % 6 == 1, "Certificado"),
        "Costo": F.when(p % 7 == 0, "Sin cargo"),
        "Fundamentación": F.when(p % 4 == 0, t),
    }
    md = listings.course_document(body, TODAY, f"{SITE}lista.php", FACTS, CONTACT, MAIL)
    return _cards(spark, sf_dir).where("detail_id IS NOT NULL").select("page_id", "detail_id", F.length(md).alias("length"), keys.content_hash(md).alias("hash"))


def postgraduate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RND-04, TXT-12: a document for each postgraduate card; every other one has a programme, made of its title."""
    cards = _postgraduate(spark, sf_dir)
    program = F.when(F.col("page_id") % 2 == 0, F.concat(F.col("title"), F.lit("\nDocente: X, DNI 23.456.789 \n")))
    md = listings.postgraduate_document(program, TODAY, f"{SITE}posgrado", "la Facultad", MAIL, FACTS, CONTACT)
    return cards.select("page_id", "id", F.length(md).alias("length"), keys.content_hash(md).alias("hash"))


def course_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RUL-05, RUL-07, SRC-17, INC-01, JOI-01: all cards are listed, hydrated with their page, compared with the last run, matched with the index, and decided on.

    A card is its page and place. Landed: the details of even ids. The last run knew the cards of pages divisible by 3, of which
    those divisible by 9 have changed. The index knows the slugs of pages not divisible by 5, and the titles, with their page, of those divisible by 10.
    """
    named = F.concat("page_id", F.lit("-"), "pos")
    cards = _cards(spark, sf_dir).where("detail_id IS NOT NULL").withColumn("id", named).withColumn("slug", F.concat("slug", F.lit("-"), named)).withColumn("title_key", F.concat("title_key", F.lit(" "), "page_id", F.lit(" "), "pos"))
    details = table(spark, sf_dir, "pages").where("page_id % 2 = 0").select(F.concat(F.lit(f"{SITE}index.php?act=showSubcategoria&id="), "page_id").alias("url"), F.concat(F.lit("detail "), "page_id").alias("text"))
    full = landed.hydrate(cards, details, "detail_url").withColumn("content_hash", keys.fields_hash(F.col("title"), F.col("start_date"), F.col("detail_text")))
    known = full.where("page_id % 3 = 0").select("id", F.when(F.col("page_id") % 9 == 0, "old").otherwise(F.col("content_hash")).alias("content_hash"))
    status = sync.change_status(full, known, "id").select("id", "status")
    path, pos = F.concat(F.lit("cursos/"), "id", F.lit(".md")).alias("path"), (F.col("page_id") * 100 + F.col("pos")).alias("pos")
    by_slug = cards.where("page_id % 5 <> 0").select(path, "title", F.lit(None).cast("string").alias("title_key"), "slug", pos)
    by_title = cards.where("page_id % 10 = 0").select(path, "title", "title_key", F.lit(None).cast("string").alias("slug"), pos)
    matched = catalog.match(full.select("id", "title_key", "slug"), by_slug.unionByName(by_title)).select("id", F.col("status").alias("catalog"), "index_path")
    return full.join(status, "id").join(matched, "id").select("page_id", "pos", "detail_id", "status", "catalog", "index_path", listings.decision().alias("decision"))


def source_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06: every source by the plan of its strategy; sources to be done yield nothing."""
    host = urls.host("url")
    strategy = F.when(F.startswith(host, F.lit("www.")), "homepage").when(F.startswith(host, F.lit("blog.")), "single_page").when(F.startswith(host, F.lit("m.")), "tbd").otherwise("microsite")
    sources = _titled(spark, sf_dir).withColumn("strategy", strategy)
    plans = {
        "homepage": lambda d: d.select("page_id", "strategy", urls.normalized(F.col("url")).alias("result")),
        "single_page": lambda d: d.select("page_id", "strategy", F.col("t").alias("result")),
        "microsite": lambda d: d.select("page_id", "strategy", urls.origin(F.col("url")).alias("result")),
    }
    return landed.by_strategy(sources, plans)


def longer_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13: the longer of two readings of a page, its title and its first heading."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", landed.longer(text.title(F.col("html")), F.nullif(text.section_title(F.col("html")), F.lit(""))).alias("text"))


def _documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Published: ids not divisible by 7. Candidates: ids divisible by 3, changed where divisible by 6. Retired: ids divisible by 11."""
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("kb/"), "doc_id", F.lit(".md")).alias("path"), "doc_id", F.col("text").alias("md"))
    changed = F.when(F.col("doc_id") % 6 == 0, F.concat("md", F.lit("\nnuevo"))).otherwise(F.col("md"))
    return d.where("doc_id % 7 <> 0").select("path", "md"), d.where("doc_id % 3 = 0").select("path", changed.alias("md")), d.where("doc_id % 11 = 0").select("path")


def apply_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-08, SNK-01, INC-05: candidates promoted, retired documents deleted, published as one version together with their state, and read back."""
    done = catalog.apply(*_documents(spark, sf_dir))
    out = Published(spark, f"{shared_folder(spark)}/apply-{uuid.uuid4().hex}")
    state = done.where("action <> 'deleted'").select("path", keys.content_hash(F.col("md")).alias("content_hash"))
    out.publish({"documents": done, "state": state}, out.version())
    return out.read("documents").select("path", "action").join(out.read("state"), "path", "left")


def index_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-04: the index' version after added and removed rows."""
    published, candidates, retired = _documents(spark, sf_dir)
    return catalog.bump(published, candidates, retired, 41, TODAY)


def catalog_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-03: the catalog of course cards, written as JSON and read back."""
    out = f"{shared_folder(spark)}/catalog-{uuid.uuid4().hex}"
    cards = _cards(spark, sf_dir).select("page_id", "title", "start_date", "detail_id", "detail_url")
    cards.write.json(out)
    return spark.read.schema(cards.schema).json(out)


_T = f"t AS (SELECT page_id AS p, url, {s.title('html')} AS t FROM pages)"
_FIRST = s.normalize_spaces(s.html_to_text("(t || ' &amp; más')"))
_CARDS = f"""
{_T}, a AS (
  SELECT p, 0 AS pos, {_FIRST} AS title, '2026-' || lpad(CAST(p % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(p % 28 + 1 AS VARCHAR), 2, '0') AS start_date, CAST(p AS VARCHAR) AS course_id,
    '{SITE}index.php?act=showSubcategoria&id=' || p AS detail_url, NULL AS query_url, '{SITE}index.php?act=showLogin&x=1' AS signup_url, CAST(p AS VARCHAR) AS detail_id FROM t
  UNION ALL SELECT p, 1, 'Segundo curso' || chr(10) || p, NULL, CAST(p AS VARCHAR), 'https://www.example.org/ver?act=showSubcategoria&id=' || (p + 1000), '{SITE}lista.php?act=showConsulta', NULL, CAST(p + 1000 AS VARCHAR) FROM t WHERE p % 4 <> 0
  UNION ALL SELECT p, 2, 'Libre', NULL, NULL, '{SITE}index.php?act=showSubcategoria', NULL, NULL, NULL FROM t WHERE p % 5 = 0
), c AS (SELECT p AS page_id, pos, title, {s.title_key('title')} AS title_key, substr(replace({s.title_key('title')}, ' ', '-'), 1, 120) AS slug, start_date, detail_id, course_id, detail_url, query_url, signup_url FROM a WHERE title <> '')"""
_ASK = f"- No publicado en fuentes oficiales — consultar con {MAIL}."

QUERIES = {f.__name__: f for f in (course_cards, postgraduate_cards, course_documents, postgraduate_documents, course_plan, source_dispatch, longer_texts, apply_phase, index_version, catalog_json)}
SQL = {
    "course_cards": f"WITH {_CARDS} SELECT * EXCLUDE (pos) FROM c",
    "postgraduate_cards": f"""
WITH {_T}, r AS (SELECT p, {s.squeeze(s.decode("(t || chr(10) || ' 2026.')"))} AS raw FROM t WHERE p % 3 < 2),
w AS (SELECT p, {s.rr('raw', '\\.\\s*$')} AS raw FROM r)
SELECT p AS page_id, CAST(CASE WHEN p % 3 = 0 THEN p ELSE p + 1 END AS VARCHAR) AS id, {s.trim(s.rr('raw', f'{s.WS}+20[0-9]{{2}}{s.WS}*$'))} AS title, {s.slug(s.rr('raw', f'{s.WS}+20[0-9]{{2}}{s.WS}*$'), None)} AS slug,
  CASE WHEN p % 2 = 0 THEN '05/03/2026' ELSE '5/3/2026' END AS start_raw, CASE WHEN p % 2 = 0 THEN '2026-03-05' END AS start_date, CASE WHEN p % 3 = 0 THEN '/media/' || p || '.pdf' END AS pdf_url, '/login?id=' || (p + 1) AS signup_url
FROM w""",
    "course_documents": f"""
WITH {_CARDS}, w AS (SELECT *, {s.title_case('title')} AS h, regexp_replace(title, '^[-*]{s.WS}+', '') AS bare FROM c WHERE detail_id IS NOT NULL),
l AS (SELECT *, array_to_string([CASE WHEN regexp_matches(x, '^[-*]{s.WS}+') THEN x ELSE '- ' || x END for x in list_filter([{s.normalize_spaces('y')} for y in string_split(title, chr(10))], lambda z: z <> '')], '~') AS items,
  array_to_string(['  - ' || regexp_replace(x, '^[-*]{s.WS}+', '') for x in list_filter([{s.normalize_spaces('y')} for y in string_split(title, chr(10))], lambda z: z <> '')], '~') AS below FROM w),
m AS (SELECT page_id, detail_id, replace('# ' || h || '~~## Identificación~~- **Nombre oficial**: ' || title || '~- **Tipo**: Curso de formación profesional~- **Unidad académica**: Facultad~- **Acreditación**: no aplica~- **ID página detalle**: ' || detail_id || coalesce('~- **ID inscripción**: ' || course_id, '')
  || '~~## Modalidad y duración~~' || CASE WHEN page_id % 5 = 0 THEN items ELSE '{_ASK}' END || coalesce('~- **Fecha de inicio publicada en listado**: ' || start_date, '')
  || '~~## Plan de estudios / Contenidos~~' || CASE WHEN page_id % 2 = 0 THEN items || '~* módulo final~' || '- ' || replace(title, chr(10), '~- ') ELSE '{_ASK}' END || '~~## Objetivos~~{_ASK}~~## Destinatarios~~{_ASK}'
  || '~~## Cuerpo docente~~' || CASE WHEN page_id % 3 = 0 THEN items ELSE '{_ASK}' END || '~~## Requisitos de admisión~~{_ASK}'
  || '~~## Metodología y evaluación~~' || CASE WHEN page_id % 3 = 1 THEN '- **Evaluación**:~  - ' || replace(title, chr(10), '~  - ') || CASE WHEN page_id % 6 = 1 THEN '~- **Certificación**:~  - Certificado' ELSE '' END ELSE '{_ASK}' END
  || '~~## Aranceles e inscripción~~- **Costo**:~  - ' || CASE WHEN page_id % 7 = 0 THEN 'Sin cargo' ELSE 'Consultar a {MAIL}.' END || '~- **Estado (al {TODAY})**: Inscripción abierta según listado oficial.'
  || coalesce('~- **Sistema de inscripción**: ' || signup_url, '') || coalesce('~- **Formulario de consultas**: ' || query_url, '')
  || '~~## Contacto~~- **Email**: cursos@example.org~- **Teléfono**: +54 000 0000~~## Información adicional relevante~~' || CASE WHEN page_id % 4 = 0 THEN '- **Fundamentación**:~' || below ELSE '- No publicado en fuentes oficiales.' END
  || '~~## Fuentes consultadas~~- Listado oficial de inscripciones abiertas: {SITE}lista.php~- Página oficial del curso: ' || detail_url || coalesce('~- Sistema de inscripción: ' || signup_url, '')
  || '~~---~~**Última revisión automática**: {TODAY} (candidato generado por scraper determinístico de cursos)~**Revisión humana**: pendiente~', '~', chr(10)) AS md FROM l)
SELECT page_id, detail_id, length(md) AS length, sha256(md) AS hash FROM m""",
    "postgraduate_documents": f"""
WITH {_T}, r AS (SELECT p, {s.squeeze(s.decode("(t || chr(10) || ' 2026.')"))} AS raw FROM t WHERE p % 3 < 2),
w AS (SELECT p, CAST(CASE WHEN p % 3 = 0 THEN p ELSE p + 1 END AS VARCHAR) AS id, {s.trim(s.rr(s.rr('raw', chr(92) + '.' + chr(92) + 's*$'), f'{s.WS}+20[0-9]{{2}}{s.WS}*$'))} AS title FROM r),
m AS (SELECT p, id, replace('# ' || title || '~~Curso de posgrado de la Facultad. Información extraída del catálogo oficial de cursos de posgrado y de la ficha publicada por la facultad.~~## Identificación~~- **Nombre oficial**: ' || title
  || '~- **Tipo**: Curso de posgrado~- **Unidad académica**: Facultad~- **Acreditación**: no aplica~- **ID de inscripción**: ' || id || '~~## Modalidad y duración~~- **Fecha de inicio publicada**: ' || CASE WHEN p % 2 = 0 THEN '05/03/2026' ELSE '5/3/2026' END
  || '~- **Modalidad y carga horaria**: ver detalle del programa más abajo (según la ficha oficial).~~## Programa (según ficha oficial)~~'
  || CASE WHEN p % 2 = 0 THEN '> El siguiente contenido fue extraído del documento oficial del curso. Para el detalle formal, consultá la ficha publicada y la Secretaría de Posgrado.~~' || title || '~Docente: X, DNI [omitido]'
     ELSE 'Detalle del programa no disponible en el documento al momento de la extracción. Consultá la ficha oficial o escribí a {MAIL}.' END
  || '~~## Aranceles e inscripción~~- **Aranceles**: A consultar con la Secretaría de Posgrado la Facultad.~- **Estado de inscripción (al {TODAY})**: Curso publicado en el catálogo oficial de cursos de posgrado. Confirmá la apertura de inscripción con la Secretaría de Posgrado.~- **Pre-inscripción**: /login?id=' || (p + 1)
  || '~~## Contacto~~- **Email de Secretaría de Posgrado la Facultad**: {MAIL}~- **Email**: cursos@example.org~- **Teléfono**: +54 000 0000~~## Fuentes consultadas~~- Catálogo oficial de cursos de posgrado: {SITE}posgrado' || CASE WHEN p % 3 = 0 THEN '~- Ficha oficial del curso: /media/' || p || '.pdf' ELSE '' END
  || '~~---~~**Última revisión automática**: {TODAY} (candidato generado por scraper determinístico de cursos de posgrado)~**Revisión humana**: pendiente~', '~', chr(10)) AS md FROM w)
SELECT p AS page_id, id, length(md) AS length, sha256(md) AS hash FROM m""",
    "course_plan": f"""
WITH {_CARDS}, f AS (SELECT page_id, CAST(pos AS INTEGER) AS pos, detail_id, EXISTS (SELECT 1 FROM pages g WHERE g.page_id % 2 = 0 AND '{SITE}index.php?act=showSubcategoria&id=' || g.page_id = c.detail_url) AS landed,
  CASE WHEN page_id % 3 <> 0 THEN 'new' WHEN page_id % 9 = 0 THEN 'changed' ELSE 'unchanged' END AS status, CASE WHEN page_id % 5 <> 0 OR page_id % 10 = 0 THEN 'indexed' ELSE 'new_unindexed' END AS catalog FROM c WHERE detail_id IS NOT NULL)
SELECT page_id, pos, detail_id, status, catalog, CASE WHEN catalog = 'indexed' THEN 'cursos/' || page_id || '-' || pos || '.md' END AS index_path,
  CASE WHEN NOT landed THEN 'requires_review' WHEN status = 'unchanged' THEN 'no_change' WHEN catalog = 'new_unindexed' THEN 'create' WHEN status = 'new' THEN 'restore' ELSE 'update' END AS decision FROM f""",
    "source_dispatch": f"""
WITH {_T}, h AS (SELECT *, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)) AS host, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)) AS origin FROM t),
k AS (SELECT *, CASE WHEN starts_with(host, 'www.') THEN 'homepage' WHEN starts_with(host, 'blog.') THEN 'single_page' WHEN starts_with(host, 'm.') THEN 'tbd' ELSE 'microsite' END AS strategy FROM h)
SELECT p AS page_id, strategy, CASE strategy WHEN 'single_page' THEN t WHEN 'microsite' THEN origin
  ELSE CASE WHEN origin = '' THEN url ELSE origin || coalesce(nullif(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), '/+$', ''), ''), '/') END END AS result FROM k WHERE strategy <> 'tbd'""",
    "longer_texts": f"WITH x AS (SELECT page_id, {s.title('html')} AS a, coalesce({s.section_title('html')}, '') AS b FROM pages) SELECT page_id, CASE WHEN length(a) >= length(b) THEN a ELSE b END AS text FROM x",
    "apply_phase": """
WITH d AS (SELECT *, doc_id % 7 <> 0 AS known, doc_id % 3 = 0 AS scraped, doc_id % 11 = 0 AS gone FROM documents),
a AS (SELECT 'kb/' || doc_id || '.md' AS path, CASE WHEN scraped AND doc_id % 6 = 0 THEN text || chr(10) || 'nuevo' ELSE text END AS md,
  CASE WHEN scraped AND NOT known THEN 'added' WHEN scraped AND doc_id % 6 <> 0 THEN 'unchanged' WHEN scraped THEN 'replaced' WHEN gone THEN 'deleted' ELSE 'kept' END AS action FROM d WHERE known OR scraped)
SELECT path, action, CASE WHEN action <> 'deleted' THEN sha256(md) END AS content_hash FROM a""",
    "index_version": f"""
WITH n AS (SELECT count(*) AS n FROM documents WHERE (doc_id % 3 = 0 AND (doc_id % 6 = 0 OR doc_id % 7 = 0)) OR (doc_id % 11 = 0 AND doc_id % 7 <> 0))
SELECT 41 + CASE WHEN n > 0 THEN 1 ELSE 0 END AS version, CASE WHEN n > 0 THEN '{TODAY}' END AS last_updated, n AS n_changed FROM n""",
    "catalog_json": f"WITH {_CARDS} SELECT page_id, title, start_date, detail_id, detail_url FROM c",
}
