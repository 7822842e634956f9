"""Topics: a fixed list of topics and their pages, rolled up to one row and one document each (SRC-18, AGG-05, RND-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions import text
from docmill.functions.charset import END_WORD, WS
from docmill.operators import links, reports

# What hints at lists of people, one alone or two together.
NAMED, DOCUMENT, LISTED = rf"nombre{WS}+y{WS}+apellido", r"dni|documento", r"listado|lista|alumnos|estudiantes"
# Reasons for a review, in their order.
REASONS = ("iframe detectado", "links a planillas detectados", "posibles datos personales", "links a sistemas externos", "una o más subpáginas no pudieron descargarse")


def personal(t: Column) -> Column:
    """Whether a text may list people (FLT-03, the topics' variant)."""
    low = F.lower(t)
    return low.rlike(NAMED) | (low.rlike(DOCUMENT) & low.rlike(LISTED))


def rollup(topics: DataFrame, pages: DataFrame, system_hosts: tuple[str, ...], internal_suffixes: tuple[str, ...], system_words: tuple[str, ...] = ()) -> DataFrame:
    """One row per topic: topics (topic, page_id) joined with landed pages (page_id, url, html); pages that weren't landed count as failed.

    Links are counted per page, spreadsheets and systems once per topic. Everything is aggregated before it
    is joined, so a topic's pages and links are never held together.
    """
    read = pages.select("page_id", F.col("html").rlike(rf"(?i)<iframe{END_WORD}").alias("iframe"), text.normalize_spaces(text.html_to_text(F.col("html"))).alias("text"), F.lit(True).alias("landed"))
    per_page = topics.join(read, "page_id", "left").groupBy("topic").agg(
        F.count("*").alias("pages"),
        F.count_if(F.col("landed").isNull()).alias("failed"),
        F.count_if(F.length("text") >= 80).alias("pages_with_content"),
        F.coalesce(F.bool_or("iframe"), F.lit(False)).alias("has_iframe"),
        F.coalesce(F.bool_or(personal(F.col("text"))), F.lit(False)).alias("personal_data"),
    )
    found = links.anchors(pages, system_hosts, internal_suffixes, system_words).join(topics, "page_id").groupBy("topic", "url", "kind").agg(F.count("*").alias("n"))
    once = lambda kind: F.count_if(F.col("kind") == kind)
    per_link = found.groupBy("topic").agg(F.sum("n").alias("links"), F.sum(F.when(F.col("kind") == "pdf", F.col("n")).otherwise(0)).alias("pdf_links"), once("google_sheet").alias("sheet_links"), once("system").alias("system_links"))
    both = per_page.join(per_link, "topic", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("links", "pdf_links", "sheet_links", "system_links")})
    signs = (F.col("has_iframe"), F.col("sheet_links") > 0, F.col("personal_data"), F.col("system_links") > 0, F.col("failed") > 0)
    reasons = F.filter(F.array(*[F.when(c, r) for c, r in zip(signs, REASONS, strict=True)]), lambda r: r.isNotNull())
    return both.withColumn("reasons", reasons).withColumn("requires_review", F.size("reasons") > 0)


def document(today: str) -> Column:
    """The Markdown document of a topic (RND-03), of rollup()'s columns and title."""
    n = lambda name, c: F.concat(F.lit(f"- **{name}**: "), F.col(c).cast("string"))
    parts = {
        "Resumen": F.concat_ws("\n", n("Páginas", "pages"), n("Con contenido", "pages_with_content"), n("Links", "links"), n("PDF", "pdf_links")),
        "Motivos de revisión": F.array_join(F.transform("reasons", lambda r: F.concat(F.lit("- "), r)), "\n"),
    }
    return reports.document(F.col("title"), parts, F.lit(f"**Última revisión automática**: {today}"))


def link_appendix(anchors: DataFrame, by: list[str]) -> DataFrame:
    """(by, md): the links of anchors() as a list in order, one appendix per page or whatever else by names (RND-05)."""
    line = F.concat(F.lit("- ["), "text", F.lit("]("), "url", F.lit(")"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("ord", line.alias("line")))), lambda x: x.line)
    return anchors.groupBy(*by).agg(F.concat(F.lit("## Enlaces\n\n"), F.array_join(lines, "\n")).alias("md"))


def complement(name: Column, table: Column, modified: Column, link: Column, origin: str) -> Column:
    """A spreadsheet's document around its table (RND-07): title without extension, contents, metadata, source."""
    title = F.regexp_replace(F.regexp_replace(name, r"(?i)\.csv$", ""), r"(?i)\.xlsx?$", "")
    meta = F.concat(F.lit(f"- **Origen**: {origin} (`"), name, F.lit("`)\n- **Fecha de modificación**: `"), modified, F.lit("`\n- **Categoría**: Complemento Institucional"))
    return reports.document(title, {"Contenido": table, "Metadatos del Documento": meta}, F.concat(F.lit("## Fuentes consultadas\n\n- ["), name, F.lit("]("), link, F.lit(")")))
