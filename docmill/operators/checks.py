"""Validators (VAL-01 to VAL-11): each returns violations, or arrays of errors and warnings per document."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions import keys, urls
from docmill.functions.charset import WS, bind
from docmill.functions.dates import dates_in
from docmill.operators.sections import headings, in_order, section_text
from docmill.operators.unique import repeats

# Headings that a programme or a complement must have, in this order.
REQUIRED = (
    "Identificación",
    "Modalidad y duración",
    "Plan de estudios",
    "Cuerpo docente",
    "Requisitos de admisión",
    "Aranceles e inscripción",
    "Próxima cohorte",
    "Contacto",
    "Información adicional relevante",
    "Fuentes consultadas",
)
REQUIRED_COMPLEMENT = ("Contenido", "Metadatos del Documento", "Fuentes consultadas")
# Phrases of letters, which don't belong into a document.
PROHIBITED = (
    "Muchas gracias por tu interés",
    "Muchas gracias por su interés",
    "Quedamos a disposición",
    "Esperamos contar con su participación",
    "Es un placer informarle",
    "Es un placer informarte",
    "Reciba un cordial saludo",
)
DATED = ("Próxima cohorte", "Aranceles e inscripción")
# Fixed value: what says that a date isn't settled.
OPEN_DATE = r"(?iu)no publicado|consultar|cerrada|a confirmar|por confirmar"
# Names of documents that list courses, of which each should have one of its own.
AGGREGATES = ("cursos-de-formacion", "cursos-de-formacion-activos", "cursos-activos", "listado-de-cursos", "listado-cursos", "overview", "cursos-overview")


def is_complement(md: Column) -> Column:
    """FLT-06."""
    return md.contains("## Contenido")


def structure(md: Column) -> Column:
    """Names of what is missing: H1 in front, and required headings that are absent or out of order (VAL-01)."""
    no_title = F.when(md.rlike(rf"\A(?:{WS}*\n)?# "), F.array().cast("array<string>")).otherwise(F.array(F.lit("H1")))
    found = headings(md, tuple(dict.fromkeys((*REQUIRED, *REQUIRED_COMPLEMENT))))
    missing = bind(F.struct(md.alias("md"), found.alias("found")), lambda x: F.when(is_complement(x["md"]), in_order(x["found"], REQUIRED_COMPLEMENT)).otherwise(in_order(x["found"], REQUIRED)))
    return F.concat(no_title, missing)


def prohibited(md: Column, phrases: tuple[str, ...] = PROHIBITED) -> Column:
    """Prohibited phrases that occur, and ``code`` if there is a fence (VAL-02)."""
    return F.concat(F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(md, p)), F.when(md.rlike(r"(?m)^```"), F.array(F.lit("code"))).otherwise(F.array().cast("array<string>")))


def placeholders(md: Column, shown: int = 5) -> Column:
    """The first placeholders in braces, and how many more there are (VAL-03, ORD-04)."""
    found = F.filter(F.regexp_extract_all(md, F.lit(r"\{[A-ZÁÉÍÓÚÑa-záéíóúñ][^{}\n]{2,80}\}"), F.lit(0)), lambda x: ~x.contains("/") & ~x.contains("@"))
    more = F.size(found) - shown
    return F.concat(F.slice(found, 1, shown), F.when(more > 0, F.array(F.concat(more.cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>")))


def no_closing(md: Column) -> Column:
    """Whether a programme lacks its closing line (VAL-04)."""
    return ~is_complement(md) & ~md.contains("**Última revisión humana**")


def stale_dates(sections: DataFrame, key: str, today: str, names: tuple[str, ...] = DATED) -> DataFrame:
    """(key, name, found) of past dates in dated sections that don't say that the date is open (VAL-05)."""
    rows = sections.where(F.col("name").isin(*names) & ~F.col("body").rlike(OPEN_DATE))
    return rows.select(key, "name", F.explode(dates_in(F.col("body"))).alias("d")).where(F.col("d.day") < F.lit(today).cast("date")).select(key, "name", F.col("d.found").alias("found"))


def past_dates(md: Column, today: str, names: tuple[str, ...] = DATED) -> Column:
    """Past dates of the dated sections of a text (VAL-05), each with its section; those of a section that says that the date is open don't count."""

    def one(name: str) -> Column:
        found = lambda t: F.transform(F.filter(dates_in(t), lambda d: d["day"] < F.lit(today).cast("date")), lambda d: F.concat(F.lit(f"{name}: "), d["found"]))
        return bind(section_text(md, name), lambda t: F.when(t.rlike(OPEN_DATE), F.array().cast("array<string>")).otherwise(found(t)))

    return F.concat(*[one(n) for n in names])


def source_urls(md: Column) -> Column:
    """Distinct URLs from the section of sources on, without closing punctuation (EXP-10)."""
    at = F.regexp_instr(md, F.lit(rf"(?m)^##{WS}+Fuentes consultadas{WS}*$"))
    section = F.when(at > 0, F.substr(md, at)).otherwise("")
    return F.array_distinct(F.regexp_extract_all(section, F.lit(r"https?://[^\s)<>\"'`]+[^\s)<>\"'`.,;:]"), F.lit(0)))


def size_gate(candidate: Column, current: Column, low: float = 0.3, high: float = 3.0) -> Column:
    """error, warning, ok, or null without a current text (VAL-06)."""
    ratio = F.length(candidate) / F.nullif(F.length(current), F.lit(0))
    return F.when(ratio.isNull(), F.lit(None).cast("string")).when(ratio < low, "error").when(ratio > high, "warning").otherwise("ok")


def validate(docs: DataFrame, key: str, md: str, current: str, today: str) -> DataFrame:
    """(key, ok, errors, warnings, urls): all checks of one text together (VAL-08), and the sources whose URLs are to be probed (VAL-07)."""
    m = F.col(md)
    gate = size_gate(m, F.col(current))
    tag = lambda kind, a: F.transform(a, lambda x: F.concat(F.lit(f"{kind}: "), x))
    none = F.array().cast("array<string>")
    errors = F.concat(tag("missing", structure(m)), tag("prohibited", prohibited(m)), tag("placeholder", placeholders(m)), F.when(no_closing(m), F.array(F.lit("closing"))).otherwise(none), F.when(gate == "error", F.array(F.lit("too small"))).otherwise(none))
    warnings = F.concat(F.when(m.rlike("(?iu)PENDIENTE — draft autogenerado"), F.array(F.lit("draft"))).otherwise(none), tag("past", past_dates(m, today)), F.when(gate == "warning", F.array(F.lit("too large"))).otherwise(none))
    return docs.select(key, errors.alias("errors"), warnings.alias("warnings"), source_urls(m).alias("urls")).select(key, (F.size("errors") == 0).alias("ok"), "errors", "warnings", "urls")


def violations(df: DataFrame, key: Column, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """(severity, key, rule): one row for each rule that a row breaks, from one pass over df."""
    broken = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(s).alias("severity"), F.lit(r).alias("rule"))) for s, r, c in rules]), lambda x: x.isNotNull())
    return df.select(key.alias("key"), F.explode(broken).alias("v")).select("v.severity", "key", "v.rule")


def index_violations(index: DataFrame, sectors: tuple[str, ...], folders: tuple[str, ...], files: DataFrame, routing: DataFrame, version: int | None, last_updated: str | None, forbidden: tuple[str, ...] = ()) -> DataFrame:
    """Violations of an index (VAL-09, JOI-12, FLT-05): (severity, key, rule).

    index: pos, path, title, category, url. files: path, is_file. routing: path, sector. A row without a path breaks
    no other rule. Titles are compared as keys, and blank ones not at all. Of the files below the known folders those that
    no row names are warnings, as are rows below other folders.
    """
    spark = index.sparkSession
    rows = index.where(F.coalesce("path", F.lit("")) != "")
    nameless = index.where(F.coalesce("path", F.lit("")) == "").select(F.lit("error").alias("severity"), F.format_string("items[%d]", "pos").alias("key"), F.lit("no_path").alias("rule"))
    whole = {"version": not isinstance(version, int) or version < 1, "last_updated": not re.fullmatch(r"\d{4}-\d{2}-\d{2}", last_updated or "")}
    about = spark.range(1).select(F.explode(F.array(*(F.lit(k) for k, bad in whole.items() if bad)).cast("array<string>")).alias("rule")).select(F.lit("error").alias("severity"), F.lit("index").alias("key"), "rule")
    marked = rows.join(files.select("path", "is_file"), "path", "left").join(routing.select("path", F.col("sector").alias("routed")), "path", "left")
    path = F.col("path")
    name = F.lower(F.regexp_replace(F.regexp_replace("path", "^cursos/", ""), r"(?i)\.md$", ""))
    rules = [
        ("error", "no_title", F.coalesce("title", F.lit("")) == ""),
        ("error", "no_category", F.coalesce("category", F.lit("")) == ""),
        ("error", "not_markdown", ~F.endswith("path", F.lit(".md"))),
        ("error", "unsafe_path", F.startswith("path", F.lit("/")) | path.contains("..") | path.contains("\\")),
        ("error", "forbidden", path.isin(*forbidden) if forbidden else F.lit(False)),
        ("warning", "unknown_folder", ~F.substring_index("path", "/", 1).isin(*folders)),
        ("error", "no_file", F.col("is_file").isNull()),
        ("error", "not_a_file", ~F.col("is_file")),
        ("error", "bad_url", F.col("url").isNotNull() & ~urls.is_http(F.col("url"))),
        ("error", "not_routed", F.col("routed").isNull()),
        ("error", "bad_sector", ~F.col("routed").isin(*sectors)),
        ("error", "aggregate", F.startswith("path", F.lit("cursos/")) & F.endswith("path", F.lit(".md")) & name.isin(*AGGREGATES)),
    ]
    again = repeats(rows, {"path_repeated": path, "title_repeated": keys.title_key(F.col("title"))}, "pos", ("path",))
    again = again.select(F.when(F.col("kind") == "path_repeated", "error").otherwise("warning").alias("severity"), F.col("path").alias("key"), F.col("kind").alias("rule"))
    # files right below a known folder only
    near = files.where("is_file AND endswith(path, '.md')").where(F.substring_index("path", "/", 1).isin(*folders) & (F.size(F.split("path", "/")) == 2))
    alone = near.join(rows.select("path"), "path", "left_anti").select(F.lit("warning").alias("severity"), F.col("path").alias("key"), F.lit("not_indexed").alias("rule"))
    return reduce(DataFrame.unionByName, (about, nameless, violations(marked, path, rules), again, alone))


def catalog_violations(catalog: DataFrame, counts: DataFrame) -> DataFrame:
    """Violations of a course catalog (VAL-11, AGG-13): (severity, key, rule).

    catalog: pos, slug, title, title_key, detail_url, signup_url, query_url, start_date. counts: one row with active,
    matched, new and missing, as catalog.counters() makes it. Rows are named by their place.
    """
    bad = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    rules = [
        ("error", "no_title", ~bad("title")),
        ("error", "no_slug", ~bad("slug")),
        ("error", "bad_detail_url", ~urls.is_http(F.coalesce("detail_url", F.lit("")))),
        ("error", "bad_signup_url", bad("signup_url") & ~urls.is_http(F.col("signup_url"))),
        ("error", "bad_query_url", bad("query_url") & ~urls.is_http(F.col("query_url"))),
        ("error", "bad_date", bad("start_date") & ~F.col("start_date").rlike(r"^\d{4}-\d{2}-\d{2}\z")),
    ]
    place = F.format_string("active[%d]", F.col("pos"))
    again = repeats(catalog, {"slug_repeated": F.col("slug"), "title_repeated": F.col("title_key")}, "pos")
    again = again.select(F.when(F.col("kind") == "slug_repeated", "error").otherwise("warning").alias("severity"), F.format_string("active[%d]", "place").alias("key"), F.col("kind").alias("rule"))
    n = counts.crossJoin(catalog.agg(F.count("*").alias("n")))  # one row each
    below = lambda c, least: F.coalesce(F.col(c) < least, F.lit(True))
    about = violations(n, F.lit("catalog"), [("error", "active_count", below("active", 1)), *(("error", f"{c}_count", below(c, 0)) for c in ("matched", "new", "missing")), ("error", "rows", F.col("active").isNull() | (F.col("active") != F.col("n"))), ("warning", "new_rows", F.col("new") > 0), ("warning", "missing_rows", F.col("missing") > 0)])
    return reduce(DataFrame.unionByName, (violations(catalog, place, rules), again, about))


__all__ = ["WS", "catalog_violations", "index_violations", "no_closing", "past_dates", "placeholders", "prohibited", "size_gate", "source_urls", "stale_dates", "structure", "validate", "violations"]
