"""Landed files and registries behind DataFrames; nothing here fetches (SRC)."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.functions import keys
from docmill.functions.charset import trim
from docmill.operators.grid import csv_cells
from docmill.operators.routing import Match, Taxonomy
from docmill.sources import tree

SOURCE = T.StructType([T.StructField(c, T.StringType()) for c in ("slug", "indice_path", "url", "strategy", "sectionId", "sectionPrefix")] + [T.StructField(c, T.IntegerType()) for c in ("maxPages", "maxDepth")])
ITEM = T.StructType([T.StructField(c, T.StringType()) for c in ("path", "title", "category", "sector", "canonicalUrl")])


def _numbered(files: DataFrame, field: str, kind: T.StructType) -> DataFrame:
    """Rows of an array in a JSON document, with their position."""
    one = F.from_json("value", T.StructType([T.StructField(field, T.ArrayType(kind))]))
    return files.select(F.posexplode(one[field]).alias("pos", "x")).select("pos", "x.*")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Sources of a registry file, with their place (SRC-07, SRC-21)."""
    return _numbered(spark.read.text(path, wholetext=True), "sources", SOURCE).withColumn("place", F.format_string("sources[%d]", "pos"))


def index(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an index file, with title key and slug (SRC-15)."""
    items = _numbered(spark.read.text(path, wholetext=True), "items", ITEM)
    return items.withColumn("title_key", keys.title_key(F.col("title"))).withColumn("slug", F.regexp_replace(F.regexp_replace("path", r"\.md$", ""), "^.*/", ""))


def taxonomy(spark: SparkSession, path: str) -> Taxonomy:
    """The rules of a taxonomy file (SRC-19), in its order: sectors with what they match and their folder names, a fallback, overrides.

    A file of rules is small by nature; its rules become one expression (RUL-01).
    """
    spec = json.loads(spark.read.text(path, wholetext=True).first()[0])

    def match(rules: dict | None) -> Match:
        rules = rules or {}
        return Match(*[tuple(rules.get(k, ())) for k in ("pathPrefix", "pathIncludes", "titleIncludes", "categoryIncludes", "categoryEquals")])

    sectors = {name: match(one.get("match")) for name, one in spec["sectors"].items()}
    overrides = tuple((o["sector"], match(o.get("match")), bool(o.get("force"))) for o in spec.get("overrides", ()))
    aliases = {name: tuple(one["aliases"]) for name, one in spec["sectors"].items() if one.get("aliases")}
    return Taxonomy(sectors, spec["fallback"], overrides, aliases)


def markdown(spark: SparkSession, *folders: str) -> DataFrame:
    """(path, markdown) of the Markdown files of some folders, not of those below them (SRC-16)."""
    files = spark.read.option("pathGlobFilter", "*.md").text(list(folders), wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("markdown"))


def drive(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified, length, content) of all files of a tree, without what is marked as not to be indexed (SRC-11)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    hidden = F.lower("path").contains("no_indexar") | F.lower("path").contains("no-indexar")
    return files.where(~hidden).select("path", F.col("modificationTime").alias("modified"), "length", "content")


def extract(files: DataFrame, readers: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """files with text by file extension (SRC-12, SRC-14): text as UTF-8, old word files without what doesn't print; others by injected readers, else an error."""
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    utf8 = F.decode("content", "UTF-8")
    out = F.when(ext.isin("txt", "md", "csv", "html"), utf8).when(ext == "doc", trim(F.regexp_replace(F.regexp_replace(F.decode("content", "ISO-8859-1"), r"[^\x20-\x7E\xA0-\xFF\n]+", " "), " {2,}", " ")))
    known = ["txt", "md", "csv", "html", "doc"]
    for kind, read in (readers or {}).items():
        out = out.when(ext == kind, read(F.col("content")))
        known.append(kind)
    return files.select("*", out.alias("text"), F.when(~ext.isin(*known), F.concat(F.lit("no reader for "), ext)).alias("error"))


def longer(layer: Column, model: Column) -> Column:
    """The longer of two extractions, the first of equal ones (SRC-13); null counts as empty."""
    a, b = F.coalesce(layer, F.lit("")), F.coalesce(model, F.lit(""))
    return F.when(F.length(a) >= F.length(b), a).otherwise(b)


def sheets(spark: SparkSession, folder: str) -> DataFrame:
    """(sheet, r, c, v) of the CSV files of a folder (SRC-08, SRC-09, SRC-10)."""
    files = spark.read.option("pathGlobFilter", "*.csv").text(folder, wholetext=True)
    return csv_cells(files.select(F.regexp_extract("_metadata.file_path", r"([^/]+)\.csv$", 1).alias("sheet"), "value"), "sheet", "value")


def tabs(spark: SparkSession, folder: str) -> DataFrame:
    """(tab, ok, error, value) of every CSV file of a tree, at any depth (SRC-08, SRC-09): a tab that can't be read is a row that isn't ok."""
    files = tree.read(spark, folder).where(F.endswith("path", F.lit(".csv")))
    return files.select(F.regexp_extract("path", r"([^/]+)\.csv$", 1).alias("tab"), F.col("error").isNull().alias("ok"), "error", F.col("text").alias("value"))


def tree_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """(sheet, r, c, v) of the tabs of a tree that can be read (SRC-08, SRC-09, SRC-10)."""
    return csv_cells(tabs(spark, folder).where("ok").select(F.col("tab").alias("sheet"), "value"), "sheet", "value")


def hydrate(rows: DataFrame, pages: DataFrame, url: str) -> DataFrame:
    """rows with the text of the page at url, empty and with an error if it was not landed (SRC-17)."""
    texts = pages.select(F.col("url").alias(url), F.col("text").alias("detail_text"))
    joined = rows.join(texts, url, "left")
    return joined.withColumn("detail_error", F.when(F.col("detail_text").isNull(), "not landed")).withColumn("detail_text", F.coalesce("detail_text", F.lit("")))


def by_strategy(sources: DataFrame, plans: dict[str, Callable[[DataFrame], DataFrame]], skipped: tuple[str, ...] = ("tbd", "students")) -> DataFrame:
    """The rows of one plan per strategy over its own sources (SRC-06); a strategy without a plan that isn't skipped is an error."""
    others = sources.where(~F.coalesce("strategy", F.lit("")).isin(*plans, *skipped))
    unknown = [r.strategy for r in others.select("strategy").distinct().orderBy("strategy").limit(20).collect()]
    if unknown:  # the first twenty are named, any one is an error
        raise ValueError(f"unknown strategies: {unknown}")
    return reduce(DataFrame.unionByName, [plan(sources.where(F.col("strategy") == name)) for name, plan in plans.items()])


__all__ = ["by_strategy", "drive", "extract", "hydrate", "index", "longer", "markdown", "registry", "sheets", "tabs", "taxonomy", "tree_sheets"]
