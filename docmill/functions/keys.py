"""Canonical keys (KEY-01 to KEY-11): slugs, titles, names as token sets, folders, hashes."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.charset import WS, WS_CHARS, fold, trim

# Titles before names, which are no part of a name.
HONORIFICS = ("dr", "dra", "dres", "lic", "mg", "mgtr", "esp", "cr", "cra", "cp", "cpn", "c", "p", "n", "prof", "ing", "arq", "ph", "phd", "msc")
# Words that say nothing about a document's subject.
STOP_WORDS = (
    "el", "la", "los", "las", "un", "una", "unos", "unas",
    "de", "del", "y", "e", "o", "u", "en", "para", "por", "con",
    "sin", "sobre", "bajo", "entre", "hacia", "desde", "hasta",
    "a", "al", "doc", "docx", "pdf", "txt", "csv", "xls", "xlsx",
    "que", "se", "su", "sus", "este", "esta", "estos", "estas",
    "como", "mas", "pero",
)


def _dashed(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug(c: Column, empty: str | None = "index") -> Column:
    """KEY-01 (an empty slug becomes ``index``) and KEY-02 (empty=None: it stays empty)."""
    out = _dashed(F.coalesce(c, F.lit("")))
    return out if empty is None else F.when(out == "", F.lit(empty)).otherwise(out)


def title_key(c: Column) -> Column:
    """Lower-case words without accents or signs (KEY-05); white space needs no step of its own, being one of the signs."""
    return F.trim(F.regexp_replace(fold(F.coalesce(c, F.lit(""))), "[^a-z0-9 ][^a-z0-9]*| [^a-z0-9]+", " "))


def title_key_of(s: str) -> str:
    """title_key() of a fixed value."""
    return " ".join(re.findall("[a-z0-9]+", "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))))


def course_slug(c: Column) -> Column:
    """Slug of a title key, at most 120 characters (KEY-03)."""
    return F.substr(F.replace(title_key(c), F.lit(" "), F.lit("-")), F.lit(1), F.lit(120))


def without_year(c: Column) -> Column:
    return trim(F.regexp_replace(c, rf"{WS}+20\d{{2}}{WS}*$", ""))


def dated_slug(c: Column) -> Column:
    """Slug without a year at the end (KEY-04)."""
    return _dashed(without_year(F.coalesce(c, F.lit(""))))


def name_key(c: Column) -> Column:
    """A person's name as a sorted set of its words, without honorifics (KEY-06)."""
    words = F.split(trim(F.regexp_replace(F.regexp_replace(fold(F.coalesce(c, F.lit(""))), "[.,/]", " "), f"{WS}+", " ")), " ")
    return F.array_join(F.array_sort(F.array_distinct(F.filter(words, lambda w: (w != "") & ~w.isin(*HONORIFICS)))), " ")


def split_names(c: Column) -> Column:
    """Names that stand in one cell, by line breaks, semicolons, and hyphens between spaces (EXP-08); hyphens at their ends go, N/D and empty names too."""
    parts = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?i)<br{WS}*/?>", "\n"), rf"[\n;]+|(?<!{WS}){WS}+-{WS}+")
    bare = F.transform(parts, lambda x: trim(F.regexp_replace(x, rf"^[-{WS_CHARS}]+|(?<![-{WS_CHARS}])[-{WS_CHARS}]+$", "")))
    return F.filter(bare, lambda x: (x != "") & (F.upper(x) != "N/D"))


def folder_key(c: Column) -> Column:
    """Folder name with one kind of separator (KEY-07)."""
    return F.regexp_replace(trim(fold(F.coalesce(c, F.lit("")))), f"[{WS_CHARS}_-]+", "-")


def without_number(c: Column) -> Column:
    """Name without its ordinal prefix (KEY-07)."""
    return F.regexp_replace(c, rf"^\d+{WS}*[-_]{WS}*", "")


def section_slug(path: Column, prefix: str, section_id: str) -> Column:
    """Slug of a page below a section's prefix (KEY-08): archive segments dropped, the root named by the section."""
    path = F.regexp_replace(path, "/+$", "")
    below = F.when(F.startswith(F.lower(path), F.lit(prefix.lower())), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)
    parts = F.filter(F.split(below, "/"), lambda s: (s != "") & (F.lower(s) != "categorias"))
    return F.when(F.size(parts) == 0, F.lit(section_id)).otherwise(slug(F.array_join(parts, "-")))


def keywords(c: Column) -> Column:
    """Words of three letters or more that are no stop words; repeated ones stay (KEY-09)."""
    words = F.split(F.regexp_replace(fold(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "), " ")
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*STOP_WORDS))


def content_hash(c: Column) -> Column:
    """KEY-10."""
    return F.sha2(c.cast("binary"), 256)


def fields_hash(*columns: Column) -> Column:
    """Hash of a fixed list of fields in order; null and empty differ (KEY-11)."""
    return content_hash(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~")) for c in columns]))
