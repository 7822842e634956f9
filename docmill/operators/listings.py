"""Course listings: cards cut from pages, details joined to them, documents made of both (EXP-06, EXP-07, SRC-17, RND-04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions import keys, text, urls
from docmill.functions.charset import WS, squeeze, trim
from docmill.functions.dates import iso_date, start_date
from docmill.operators import reports, sync

CARD = r"(?i)<div class='curso'>"
POSTGRADUATE = rf"(?s)<div class='curso'>(.*?)</div>{WS}*</div>"


def _found(c: Column, pattern: str) -> Column:
    """First group of a pattern, null if it is not found or empty."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def _link(block: Column, act: str, base: str) -> Column:
    """The card's link to an action, absolute."""
    href = _found(block, rf"""(?i)href=['"]([^'"]*act={act}[^'"]*)['"]""")
    return urls.absolute(text.decode_entities(href), F.lit(base))


def course_cards(pages: DataFrame, key: str, html: str, base: str) -> DataFrame:
    """(key, pos, title, title_key, slug, start_date, detail_id, course_id, detail_url, query_url, signup_url) of every card with a title and a link to its details (EXP-06).

    Of cards of one page with equal detail ids the first stays; those without an id all do.
    """
    cards = F.split(html, CARD, -1)
    blocks = pages.select(key, F.posexplode(F.slice(cards, 2, F.size(cards))).alias("pos", "block"))
    read = blocks.select(
        key, "pos",
        text.normalize_spaces(text.html_to_text(F.regexp_extract("block", r"(?is)<b>(.*?)</b>", 1))).alias("title"),
        start_date(F.col("block")).alias("start_date"),
        F.coalesce(_found(F.col("block"), r"(?i)encabezados/(\d+)\.jpg"), _found(F.col("block"), r"(?i)id_?curso=(\d+)")).alias("course_id"),
        _link(F.col("block"), "showSubcategoria", base).alias("detail_url"),
        _link(F.col("block"), "showConsulta", base).alias("query_url"),
        _link(F.col("block"), "showLogin", base).alias("signup_url"),
    )
    good = read.where("detail_url IS NOT NULL AND title <> ''").withColumn("detail_id", _found(F.col("detail_url"), r"[?&]id=([^&#]*)"))
    first = F.row_number().over(Window.partitionBy(key, F.coalesce("detail_id", F.concat(F.lit("card "), "pos"))).orderBy("pos"))
    once = good.withColumn("_n", first).where("_n = 1")
    return once.select(key, "pos", "title", keys.title_key(F.col("title")).alias("title_key"), keys.course_slug(F.col("title")).alias("slug"), "start_date", "detail_id", "course_id", "detail_url", "query_url", "signup_url")


def postgraduate_cards(pages: DataFrame, key: str, html: str, media: str, signup: str) -> DataFrame:
    """(key, pos, id, title, raw_title, slug, start_raw, start_date, pdf_url, signup_url) of every card with an id, which its PDF or else its signup link names (EXP-07)."""
    blocks = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(POSTGRADUATE), F.lit(1))).alias("pos", "block"))
    b = F.col("block")
    pdf, pre = _found(b, r"(?i)href='[^']*media/cursos-posgrado/(\d+)\.pdf'"), _found(b, r"id_posgrado=(\d+)")
    raw = F.regexp_replace(squeeze(text.decode_entities(F.regexp_extract(b, r"(?s)<b>(.*?)</b>", 1))), rf"\.{WS}*$", "")
    start = _found(b, rf"Inicio:{WS}*<b>{WS}*([0-9/]+){WS}*</b>")
    read = blocks.where(b.rlike(r"(?s)<b>.*?</b>")).select(key, "pos", F.coalesce(pdf, pre).alias("id"), keys.without_year(raw).alias("title"), raw.alias("raw_title"), keys.dated_slug(raw).alias("slug"), start.alias("start_raw"), iso_date(start).alias("start_date"), F.concat(F.lit(media), pdf, F.lit(".pdf")).alias("pdf_url"), F.concat(F.lit(signup), pre).alias("signup_url"))
    return read.where("id IS NOT NULL")


def lines(*parts: Column) -> Column:
    """Parts that aren't null, one a line."""
    return F.concat_ws("\n", *parts)


def item(name: str, value: Column) -> Column:
    """A list item with its name; null if the value is."""
    return F.concat(F.lit(f"- **{name}**: "), value)


def block(value: Column) -> Column:
    """The lines of a section's text as list items; null if there are none."""
    rows = F.filter(F.transform(F.split(text.normalize_spaces(F.coalesce(value, F.lit(""))), "\n", -1), text.normalize_spaces), lambda x: x != "")
    items = F.transform(rows, lambda x: F.when(x.rlike(rf"^[-*]{WS}+"), x).otherwise(F.concat(F.lit("- "), x)))
    return F.nullif(F.array_join(items, "\n"), F.lit(""))


def named_block(name: str, value: Column) -> Column:
    """An item with a section's name, and its lines as items below it; null if there are none."""
    rows = F.filter(F.transform(F.split(text.normalize_spaces(F.coalesce(value, F.lit(""))), "\n", -1), text.normalize_spaces), lambda x: x != "")
    items = F.transform(rows, lambda x: F.concat(F.lit("  - "), F.regexp_replace(x, rf"^[-*]{WS}+", "")))
    return F.when(F.size(items) > 0, F.concat(F.lit(f"- **{name}**:\n"), F.array_join(items, "\n")))


def course_document(sections: dict[str, Column], today: str, listing: str, facts: dict[str, str] | None = None, contact: dict[str, str] | None = None, mail: str = "") -> Column:
    """The document of a course card, all twelve sections in their order (RND-04): columns of course_cards(), and sections, texts by the name of their heading (text.COURSE_HEADINGS).

    facts are further items of the identification, contact the items of that section, mail is whom to ask
    where nothing is published.
    """
    c = F.col
    of = lambda name: F.nullif(sections.get(name, F.lit(None).cast("string")), F.lit(""))
    missing = F.lit("- No publicado en fuentes oficiales" + (f" — consultar con {mail}." if mail else "."))
    named = lambda *names: F.nullif(lines(*[named_block(n, of(n)) for n in names]), F.lit(""))
    parts = {
        "Identificación": lines(item("Nombre oficial", c("title")), item("Tipo", F.lit("Curso de formación profesional")), *[item(k, F.lit(v)) for k, v in (facts or {}).items()], item("ID página detalle", F.nullif("detail_id", F.lit(""))), item("ID inscripción", F.nullif("course_id", F.lit("")))),
        "Modalidad y duración": lines(F.coalesce(block(of("Datos clave del cursado")), missing), item("Fecha de inicio publicada en listado", c("start_date"))),
        "Plan de estudios / Contenidos": F.coalesce(block(of("Contenidos")), missing),
        "Objetivos": F.coalesce(block(of("Objetivos")), missing),
        "Destinatarios": F.coalesce(block(of("Destinatarios")), missing),
        "Cuerpo docente": F.coalesce(block(of("Docentes")), missing),
        "Requisitos de admisión": F.coalesce(block(of("Requisitos")), missing),
        "Metodología y evaluación": F.coalesce(named("Modalidad de cursado", "Evaluación", "Certificación"), missing),
        "Aranceles e inscripción": lines(named_block("Costo", F.coalesce(of("Costo"), F.lit(f"Consultar a {mail}." if mail else "Consultar."))), F.lit(f"- **Estado (al {today})**: Inscripción abierta según listado oficial."), item("Sistema de inscripción", c("signup_url")), item("Formulario de consultas", c("query_url"))),
        **({"Contacto": lines(*[item(k, F.lit(v)) for k, v in contact.items()])} if contact else {}),
        "Información adicional relevante": F.coalesce(named("Fundamentación", "Perfil de egreso"), F.lit("- No publicado en fuentes oficiales.")),
        "Fuentes consultadas": lines(F.lit(f"- Listado oficial de inscripciones abiertas: {listing}"), F.concat(F.lit("- Página oficial del curso: "), c("detail_url")), F.concat(F.lit("- Sistema de inscripción: "), c("signup_url"))),
    }
    return reports.document(text.title_case(c("title")), parts, _closing(today, "cursos"))


def _closing(today: str, what: str) -> Column:
    return F.lit(f"---\n\n**Última revisión automática**: {today} (candidato generado por scraper determinístico de {what})\n**Revisión humana**: pendiente\n")


def postgraduate_document(program: Column, today: str, catalog: str, unit: str, mail: str, facts: dict[str, str] | None = None, contact: dict[str, str] | None = None) -> Column:
    """The document of a postgraduate card (RND-04): columns of postgraduate_cards(), and the text of its programme, without identity numbers; a remark stands in where there is none."""
    c = F.col
    quote = "> El siguiente contenido fue extraído del documento oficial del curso. Para el detalle formal, consultá la ficha publicada y la Secretaría de Posgrado.\n\n"
    none = f"Detalle del programa no disponible en el documento al momento de la extracción. Consultá la ficha oficial o escribí a {mail}."
    parts = {
        "Identificación": lines(item("Nombre oficial", c("title")), item("Tipo", F.lit("Curso de posgrado")), *[item(k, F.lit(v)) for k, v in (facts or {}).items()], item("ID de inscripción", c("id"))),
        "Modalidad y duración": lines(item("Fecha de inicio publicada", F.coalesce(F.nullif("start_raw", F.lit("")), F.lit("A confirmar"))), item("Modalidad y carga horaria", F.lit("ver detalle del programa más abajo (según la ficha oficial)."))),
        "Programa (según ficha oficial)": F.coalesce(F.concat(F.lit(quote), F.nullif(trim(text.scrub_ids(program)), F.lit(""))), F.lit(none)),
        "Aranceles e inscripción": lines(item("Aranceles", F.lit(f"A consultar con la Secretaría de Posgrado {unit}.")), item(f"Estado de inscripción (al {today})", F.lit("Curso publicado en el catálogo oficial de cursos de posgrado. Confirmá la apertura de inscripción con la Secretaría de Posgrado.")), item("Pre-inscripción", c("signup_url"))),
        **({"Contacto": lines(item(f"Email de Secretaría de Posgrado {unit}", F.lit(mail)), *[item(k, F.lit(v)) for k, v in contact.items()])} if contact else {}),
        "Fuentes consultadas": lines(F.lit(f"- Catálogo oficial de cursos de posgrado: {catalog}"), F.concat(F.lit("- Ficha oficial del curso: "), c("pdf_url"))),
    }
    head = F.concat(c("title"), F.lit(f"\n\nCurso de posgrado de {unit}. Información extraída del catálogo oficial de cursos de posgrado y de la ficha publicada por la facultad."))
    return reports.document(head, parts, _closing(today, "cursos de posgrado"))


def decision() -> Column:
    """What is done with a scraped course (RUL-05, RUL-07), of detail_error, status (new, changed, unchanged) and catalog (indexed, new_unindexed): the first step that holds decides."""
    return sync.ladder(
        (F.col("detail_error").isNotNull(), "requires_review"),
        (F.col("status") == "unchanged", "no_change"),
        (F.col("catalog") == "new_unindexed", "create"),
        (F.col("status") == "new", "restore"),
        (F.lit(True), "update"),
    )
