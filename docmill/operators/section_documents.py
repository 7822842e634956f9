"""Crawled sections of sites as candidate documents, with landing rows and appendices of links (RUL-04, RND-05, KEY-08, FLT-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions import keys, text, urls
from docmill.functions.charset import END_WORD, START_WORD, squeeze
from docmill.operators.listings import lines
from docmill.operators.unique import repeats
from docmill.session import cut

# What tells of lists of persons.
NAMED = r"(?iu)nombre y apellido"
PERSON = rf"(?iu){START_WORD}(?:dni|documento){END_WORD}"
LISTED = r"(?iu)listado|lista|nómina|nomina|alumnos|estudiantes|inscriptos"


def personal(c: Column) -> Column:
    """Whether a text may hold personal data or lists of names (FLT-03)."""
    flat = squeeze(F.coalesce(c, F.lit("")))
    return flat.rlike(NAMED) | (flat.rlike(PERSON) & flat.rlike(LISTED))


def _steps(c: dict[str, Column]) -> Column:
    """Segments of a page's path below its section's prefix."""
    path, prefix = F.regexp_replace(urls.path(c["url"]), "/+$", ""), F.regexp_replace(c["prefix"], "/+$", "")
    below = F.when(F.startswith(F.lower(path), F.lower(prefix)), F.substr(path, F.length(prefix) + 1)).otherwise(path)
    return F.filter(F.split(below, "/"), lambda s: s != "")


def _base(steps: Column, section_id: Column) -> Column:
    kept = F.filter(steps, lambda s: F.lower(s) != "categorias")
    return F.when(F.size(kept) == 0, section_id).otherwise(keys.slug(F.array_join(kept, "-")))


def _listed(rows: DataFrame, which: str, line: Column, name: str) -> DataFrame:
    """(section, name): the lines of one kind of link in their order; a section has as many as its crawl's budget lets in."""
    return rows.where(which).groupBy("section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("line")))), lambda x: x.line), "\n").alias(name))


def candidates(pages: DataFrame, links: DataFrame, sections: DataFrame, today: str, source: str, reader: str, least: int = 200) -> DataFrame:
    """(section, slug, path, title, url, is_root, review_reasons, md): a document for each important page, and landing rows.

    pages: section, ord, url, title, text, error; the first page of a section is its root. links: section, ord, kind
    (document or pending), url. sections: section, section_id, name, folder, prefix, truncated.

    A page with an error, an archive of a category, and one with less than ``least`` characters of text make no document. Of important
    pages with one path the later ones are to be reviewed, as are those with signs of personal data. What isn't taken in
    (documents, thin and failed pages, and pending links if the crawl was cut short) is appended to the root's document;
    where the root made none, a landing row holds it. Sections without pages but with links get a landing row at their prefix.
    """
    rows = pages.join(sections, "section")
    c = {k: F.col(k) for k in ("url", "prefix", "section_id")}
    rows = rows.withColumn("steps", _steps(c))
    kind = F.when(F.col("error").isNotNull(), "errored").when(F.exists("steps", lambda s: F.lower(s) == "categorias"), "archive").when(text.clean_length(F.col("text")) >= least, "important").otherwise("low")
    known = cut(rows.select("section", "section_id", "name", "ord", "url", "title", "error", F.when(kind == "important", F.col("text")).alias("text"), kind.alias("kind"), _base(F.col("steps"), F.col("section_id")).alias("base"), F.concat("folder", F.lit("/"), _base(F.col("steps"), F.col("section_id")), F.lit(".md")).alias("path")))
    roots = known.groupBy("section").agg(F.min_by("url", "ord").alias("root"))

    titled = F.coalesce(F.nullif("title", F.lit("")), F.lit("(sin título)"))
    about = sections.join(roots, "section", "left")
    about = about.join(_listed(links, "kind = 'document'", F.concat(F.lit("  - "), "url"), "documents"), "section", "left")
    about = about.join(_listed(known, "kind = 'low'", F.concat(F.lit("  - "), titled, F.lit(": "), "url"), "low"), "section", "left")
    about = about.join(_listed(known, "kind = 'errored'", F.concat(F.lit("  - "), "url", F.lit(" ("), "error", F.lit(")")), "failed"), "section", "left")
    about = about.join(_listed(links, "kind = 'pending'", F.concat(F.lit("  - "), "url"), "pending"), "section", "left")
    group = lambda head, c: F.concat(F.lit(head + "\n"), c)
    grouped = lines(
        group("- **Documentos (PDF / planillas / ofimática)** — link-only, pueden contener datos personales:", F.col("documents")),
        group("- **Subpáginas sin contenido textual suficiente** (revisar si conviene incluirlas):", F.col("low")),
        group("- **Subpáginas que no se pudieron descargar** durante la revisión automática:", F.col("failed")),
        group("- ⚠️ **Crawl truncado**: se alcanzó el tope de páginas o profundidad. Estas URLs quedaron sin bajar y deben revisarse (ampliar maxPages/maxDepth si hay contenido útil):", F.when(F.col("truncated"), F.col("pending"))),
    )
    head = f"## Enlaces relacionados (no ingeridos)\n\n{reader} debe entregar estos enlaces para que el usuario los abra; no se incorporó su contenido al documento.\n"
    any_link = F.coalesce("documents", "low", "failed", "pending").isNotNull()
    material = F.coalesce("documents", "low", "failed", F.when(F.col("truncated"), F.col("pending"))).isNotNull()
    about = about.select("section", "section_id", "name", "folder", "prefix", F.col("root"), material.alias("material"), F.when(any_link, F.concat_ws("\n", F.lit(head), F.nullif(grouped, F.lit("")))).alias("appendix"))

    important = known.where("kind = 'important'").withColumn("at", F.struct("section", "ord"))
    again = repeats(important, {"path": F.to_json(F.struct("section", "path"))}, "at").select(F.col("place.section").alias("section"), F.col("place.ord").alias("ord"), F.lit(True).alias("again"))
    pages_of = important.join(again, ["section", "ord"], "left").join(about.select("section", "root", "appendix"), "section")
    reasons = F.array_compact(F.array(F.when(personal(F.col("text")), "posibles datos personales/listados nominales"), F.when(F.col("again"), F.concat(F.lit("colisión de ruta: "), "path", F.lit(" ya fue derivado de otra subpágina")))))
    docs = pages_of.withColumn("is_root", urls.normalized(F.col("url")) == urls.normalized(F.col("root"))).withColumn("review_reasons", reasons)
    named = F.coalesce(F.nullif("title", F.lit("")), F.col("name"))
    body = F.coalesce(F.nullif(F.array_join(text.bullets(F.col("text")), "\n"), F.lit("")), F.lit("- No se pudo extraer texto suficiente de la fuente."))
    warned = F.when(F.size("review_reasons") > 0, F.array_join(F.transform("review_reasons", lambda r: F.concat(F.lit("- Requiere revisión humana: "), r, F.lit("."))), "\n")).otherwise("- No se detectaron señales automáticas de datos personales; la revisión humana sigue siendo obligatoria.")
    md = F.concat_ws(
        "\n\n",
        F.concat(F.lit("# "), named),
        F.concat(F.lit("## Para qué sirve\n\n- Documento del sector **"), "name", F.lit(f"** generado automáticamente desde {source}.\n- Es un candidato automático: debe pasar por revisión humana antes de mergearse a `indice.json`.")),
        F.concat(F.lit("## Información publicada\n\n"), body),
        F.when(F.col("is_root"), F.col("appendix")),
        F.concat(F.lit(f"## Advertencias para {reader}\n\n"), warned, F.lit("\n- No responder con datos personalizados ni detrás de login; derivar al sistema o enlace oficial correspondiente.")),
        F.concat(F.lit("## Fuentes consultadas\n\n- "), named, F.lit(": "), "url"),
        F.lit(f"---\n\n**Última revisión automática**: {today} (candidato generado por el scraper de secciones WordPress)\n**Revisión humana**: pendiente\n"),
    )
    made = docs.select("section", F.concat("section_id", F.lit("-"), "base").alias("slug"), "path", "title", "url", "is_root", "review_reasons", md.alias("md"))

    landed = about.where("material").join(made.where("is_root").select("section"), "section", "left_anti")
    at = F.coalesce(urls.normalized(F.col("root")), F.col("prefix"))
    base = _base(_steps({"url": F.when(F.col("root").isNull(), F.concat(F.lit("http://x"), "prefix")).otherwise(F.col("root")), "prefix": F.col("prefix")}), F.col("section_id"))
    landing = F.concat_ws(
        "\n\n",
        F.concat(F.lit("# "), "name"),
        F.concat(F.lit("## Para qué sirve\n\n- Índice de enlaces del sector **"), "name", F.lit("**. La página principal no tenía contenido textual propio suficiente.\n- Candidato automático: requiere revisión humana antes de mergearse.")),
        F.col("appendix"),
        F.lit(f"## Advertencias para {reader}\n\n- Entregar los enlaces de arriba para que el usuario los abra; no se ingirió su contenido."),
        F.lit(f"---\n\n**Última revisión automática**: {today} (landing de sección)\n**Revisión humana**: pendiente\n"),
    )
    return made.unionByName(landed.select("section", F.concat("section_id", F.lit("-"), base).alias("slug"), F.concat("folder", F.lit("/"), base, F.lit(".md")).alias("path"), F.col("name").alias("title"), at.alias("url"), F.lit(True).alias("is_root"), F.array().cast("array<string>").alias("review_reasons"), landing.alias("md")))
