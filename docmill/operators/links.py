"""Pages and their links: extraction, menus, sections, anchors, risk signals."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions import keys, text, urls
from docmill.functions.charset import END_WORD, squeeze
from docmill.operators.unique import repeats
from docmill.session import cut

HREF = rf"""(?i)<a{END_WORD}[^>]*href\s*=\s*["']([^"']+)["']"""
ANCHOR = rf"""(?is)<a{END_WORD}[^>]*href\s*=\s*["']([^"']+)["'][^>]*>(.*?)</a>"""


def process_pages(pages: DataFrame, crop: Callable[[Column], Column]) -> DataFrame:
    """Title, text, length and content hash of each page's main content (TXT-07)."""
    cut = pages.select("page_id", "url", text.title(F.col("html")).alias("page_title"), crop(F.col("html")).alias("main"))
    read = cut.select("page_id", "url", F.coalesce(F.nullif(text.section_title(F.col("main")), F.lit("")), "page_title").alias("title"), text.html_to_text(F.col("main")).alias("text"))
    return read.withColumn("length", F.length("text")).withColumn("content_hash", keys.content_hash(F.col("text")))


def _first(found: DataFrame, by: list[str], link: str) -> DataFrame:
    """First occurrences by position, renumbered from 0 (WIN-03)."""
    once = found.groupBy(*by, link).agg(F.min(F.struct("pos", *[c for c in found.columns if c not in {*by, link, "pos"}])).alias("first"))
    flat = once.select(*by, link, "first.*")
    return flat.withColumn("ord", F.row_number().over(Window.partitionBy(*by).orderBy("pos")) - 1).drop("pos")


def menu_links(pages: DataFrame, pattern: str) -> DataFrame:
    """Menu links in order, distinct (EXP-01). pattern has one group, the reference."""
    refs = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("pos", "href"))
    found = refs.select("page_id", "pos", urls.absolute(F.replace("href", F.lit("&amp;"), F.lit("&")), F.col("url")).alias("link")).where("link IS NOT NULL")
    return _first(found, ["page_id"], "link")


def section_links(pages: DataFrame, prefix: Column) -> DataFrame:
    """Links to the same host below prefix, pages (normalized) and documents apart, media dropped (EXP-02)."""
    refs = pages.select("page_id", F.col("url").alias("base"), F.posexplode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("pos", "href"))
    refs = refs.withColumn("href", F.trim(F.replace("href", F.lit("&amp;"), F.lit("&")))).where("href <> ''").where(~F.col("href").rlike(r"(?i)^(#|mailto:|tel:|javascript:)"))
    full = refs.withColumn("url", urls.absolute(F.col("href"), F.col("base"))).where("url IS NOT NULL").where(urls.host("url") == urls.host("base"))
    low, top = F.lower(urls.path("url")), F.regexp_replace(F.lower(prefix), "/+$", "")
    inside = full.where((low == top) | F.startswith(low, F.concat(top, F.lit("/"))))
    kinds = inside.withColumn("kind", urls.target_kind(F.col("url"))).where("kind <> 'media'")
    found = kinds.select("page_id", "kind", "pos", F.when(F.col("kind") == "page", urls.normalized(F.col("url"))).otherwise(F.col("url")).alias("link"))
    return _first(found, ["page_id", "kind"], "link")


def anchors(pages: DataFrame, system_hosts: tuple[str, ...], internal_suffixes: tuple[str, ...], system_words: tuple[str, ...] = ()) -> DataFrame:
    """Anchor texts and absolute urls with their kind, distinct by url (EXP-03)."""
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("inner"))
    refs = pages.select("page_id", F.col("url").alias("base"), F.posexplode(both).alias("pos", "a"))
    refs = refs.select("page_id", "base", "pos", F.trim(text.decode_entities(F.col("a.href"))).alias("href"), F.col("a.inner").alias("inner"))
    refs = refs.where("href <> ''").where(~F.col("href").rlike("^(#|mailto:|tel:)"))
    full = refs.withColumn("url", urls.absolute(F.col("href"), F.col("base"))).where("url IS NOT NULL")
    found = full.select("page_id", "pos", "url", text.normalize_spaces(text.html_to_text(F.col("inner"))).alias("text"))
    out = _first(found, ["page_id"], "url")
    return out.select("page_id", "ord", "url", F.coalesce(F.nullif("text", F.lit("")), "url").alias("text"), urls.link_kind(F.col("url"), system_hosts, internal_suffixes, system_words).alias("kind"))


def host_signals(pages: DataFrame, word: str, second: str) -> DataFrame:
    """Per host: any frame, any page that names both kinds of words of a personal list, useful pages (FLT-03, FLT-04, AGG-05)."""
    t = pages.select(urls.host("url").alias("host"), "html", F.lower(squeeze(text.html_to_text(F.col("html")))).alias("text"))
    return t.groupBy("host").agg(
        F.bool_or(F.col("html").rlike(rf"(?i)<iframe{END_WORD}")).alias("has_iframe"),
        F.bool_or(F.col("text").rlike(word) & F.col("text").rlike(second)).alias("personal_data"),
        F.count("*").alias("n_pages"),
        F.count_if(F.length("text") >= 80).alias("n_useful"),
    )


def section_candidates(pages: DataFrame, prefix: str, section_id: str, folder: str, least: int = 200) -> DataFrame:
    """Slug, path, class and path collision of each page of a section (RUL-04); of important pages, which become documents, later ones of a path collide (WIN-04)."""
    path = F.regexp_replace(urls.path("url"), "/+$", "")
    base = keys.section_slug(path, prefix, section_id)
    archive = F.array_contains(F.transform(F.split(path, "/"), F.lower), "categorias")
    t = pages.select("page_id", urls.host("url").alias("host"), base.alias("base"), archive.alias("archive"), text.html_to_text(text.crop_main(F.col("html"))).alias("text"))
    kind = F.when(F.col("text") == "", "errored").when(F.col("archive"), "archive").when(text.clean_length(F.col("text")) >= least, "important").otherwise("low")
    # the class costs a page's whole text, so it is worked out once
    known = cut(t.select("page_id", "host", F.concat(F.lit(f"{section_id}-"), "base").alias("slug"), F.concat(F.lit(f"{folder}/"), "base", F.lit(".md")).alias("path"), kind.alias("class")))
    again = repeats(known.where("class = 'important'"), {"path": F.col("path")}, "page_id").select(F.col("place").alias("page_id"), F.lit(True).alias("again"))
    return known.join(again, "page_id", "left").withColumn("collision", F.coalesce("again", F.lit(False))).drop("again")


def check_urls(parts: list[DataFrame]) -> DataFrame:
    """Union of (url, place), distinct, with validity (VAL-10); probing them is left to an injected table."""
    return reduce(DataFrame.unionByName, parts).distinct().withColumn("valid", urls.is_http(F.col("url")))
