"""Markdown sections: splitting, comparing two versions, deciding what a difference means."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions import keys, text
from docmill.functions.charset import WS, bind, trim

PREFACE = "__preface__"
HEADING = rf"^##{WS}+(.+?){WS}*$"


def md_sections(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, ord, name, body) of each ``##`` section (EXP-04), preface first; of equal names the last body at the first place.

    Lines stay in an array and are cut at the places of its headings, each slice taken once, so a text costs
    its length, and nothing is shuffled but what repeated names need.
    """
    lines = F.split(F.concat(F.lit(f"## {PREFACE}\n"), F.coalesce(F.col(body), F.lit(""))), "\n", -1)
    heads = F.transform(lines, lambda x, i: F.struct(i.alias("at"), F.regexp_extract(x, HEADING, 1).alias("name")))
    found = docs.select(key, lines.alias("lines"), F.filter(heads, lambda h: h["name"] != "").alias("heads"))
    rows = found.select(key, F.posexplode(_between("heads", "lines")).alias("pos", "s")).select(key, "pos", trim(F.col("s.name")).alias("name"), trim(F.col("s.body")).alias("body"))
    once = rows.groupBy(key, "name").agg(F.min("pos").alias("first"), F.max_by("body", "pos").alias("body"))
    return once.withColumn("ord", (F.row_number().over(Window.partitionBy(key).orderBy("first")) - 1)).select(key, "ord", "name", "body")


def named_sections(docs: DataFrame, key: str, body: str, headings: tuple[str, ...] = text.COURSE_HEADINGS, other: str = "Información adicional") -> DataFrame:
    """(key, name, body) of a text whose lines are headings if they match a known name (EXP-05); empty sections are dropped, the last of equal names wins.

    Each row is cut by itself, as in md_sections(), and as known names are few, nothing is shuffled.
    """
    lines = F.filter(F.transform(F.split(F.coalesce(F.col(body), F.lit("")), "\n", -1), text.normalize_spaces), lambda x: x != "")
    known = F.create_map(*[F.lit(x) for h in headings for x in (keys.title_key_of(h), h)])
    named = F.transform("lines", lambda x, i: F.struct(i.alias("at"), F.try_element_at(known, keys.title_key(x)).alias("name")))
    start = F.array(F.struct(F.lit(-1).alias("at"), F.lit(other).alias("name")))
    found = docs.select(key, lines.alias("lines")).select(key, "lines", F.concat(start, F.filter(named, lambda h: h["name"].isNotNull())).alias("heads"))
    parts = found.select(key, F.filter(_between("heads", "lines"), lambda p: p["body"] != "").alias("parts"))
    names = F.array(*[F.lit(n) for n in dict.fromkeys((*headings, other))])
    last = F.transform(names, lambda n: F.try_element_at(F.filter("parts", lambda p: p["name"] == n), F.lit(-1)))
    return parts.select(key, F.explode(F.filter(last, lambda p: p.isNotNull())).alias("p")).select(key, "p.name", "p.body")


def _between(heads: str, lines: str) -> Column:
    """array<struct<name, body>>: the lines between each heading (at, name) and the next one, joined; a text costs its length."""
    ends = F.concat(F.transform(F.slice(heads, 2, F.size(heads)), lambda h: h["at"]), F.array(F.size(lines)))
    return F.transform(F.arrays_zip(F.col(heads).alias("h"), ends.alias("end")), lambda p: F.struct(p.h["name"].alias("name"), F.array_join(F.slice(lines, p.h["at"] + 2, p.end - p.h["at"] - 1), "\n").alias("body")))


def diff_sections(candidate: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, name, change) of added, removed and changed sections (JOI-05, SET-04); review and update dates count as no change."""
    a = candidate.select(key, "name", text.for_diff(F.col("body")).alias("new"))
    b = current.select(key, "name", text.for_diff(F.col("body")).alias("old"))
    both = a.join(b, [key, "name"], "full_outer")
    preface = F.col("name") == PREFACE
    change = (
        F.when(preface & (F.coalesce("new", F.lit("")) != F.coalesce("old", F.lit(""))), "changed")
        .when(preface, F.lit(None))
        .when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("new") != F.col("old"), "changed")
    )
    return both.select(key, "name", change.alias("change")).where("change IS NOT NULL")


def decide(documents: DataFrame, changes: DataFrame, key: str, sensitive: tuple[str, ...]) -> DataFrame:
    """One decision per document (RUL-03): documents has key and has_current; changes comes from diff_sections()."""
    counts = changes.groupBy(key).agg(
        F.count_if(F.col("change") == "changed").alias("changed"),
        F.count_if(F.col("change") == "added").alias("added"),
        F.count_if(F.col("change") == "removed").alias("removed"),
        F.count_if((F.col("change") == "changed") & F.col("name").isin(*sensitive)).alias("sensitive"),
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("changed", "added", "removed", "sensitive")}
    d = documents.join(counts, key, "left").withColumns(zero)
    structural = (F.col("added") > 0) | (F.col("removed") > 0)
    nothing = (F.col("changed") == 0) & ~structural
    reason = F.when(~F.col("has_current"), "no_existing_md").when(nothing, "sections_match").when(structural, "structural_change").when(F.col("sensitive") > 0, "sensitive_section_changed").otherwise("only_non_sensitive_changes")
    decision = F.when(~F.col("has_current"), "requires_review").when(nothing, "no_change").when(structural | (F.col("sensitive") > 0), "requires_review").otherwise("auto_merge")
    return d.select(key, decision.alias("decision"), reason.alias("reason"), *zero)


def with_headings(docs: DataFrame, every: int = 3) -> DataFrame:
    """Markdown made of a text's lines, with a heading before every third line; tables without headings become documents with sections."""
    lines = F.split("text", "\n", -1)
    marked = F.transform(lines, lambda x, i: F.when(i % every == every - 1, F.concat(F.lit("## Part "), F.floor(i / every).cast("string"), F.lit("\n"), x)).otherwise(x))
    return docs.withColumn("md", F.array_join(marked, "\n"))


def headings(md: Column, names: tuple[str, ...]) -> Column:
    """The headings of a text that are among names, in order: one scan of the text."""
    listed = "|".join(re.escape(n) for n in names)
    return F.regexp_extract_all(md, F.lit(rf"(?m)^##{WS}+({listed}){WS}*$"), F.lit(1))


def in_order(found: Column, required: tuple[str, ...]) -> Column:
    """Required headings that are missing from headings() or out of order (VAL-01): a missing one leaves the place where the search goes on."""

    def step(state: Column, name: Column) -> Column:
        at = F.array_position(F.slice(found, state.at, F.size(found)), name)
        return F.struct((state.at + at).alias("at"), F.when(at > 0, state.missing).otherwise(F.concat(state.missing, F.array(name))).alias("missing"))

    start = F.struct(F.lit(1).cast("long").alias("at"), F.expr("CAST(array() AS array<string>)").alias("missing"))
    return F.aggregate(F.array(*[F.lit(r) for r in required]), start, step, lambda s: s.missing)


def section_text(md: Column, name: str) -> Column:
    """What stands below the first heading of a name, up to the next heading; empty if there is none."""
    heading = F.lit(rf"(?m)^##{WS}+{re.escape(name)}{WS}*?$")
    below = bind(F.regexp_instr(md, heading), lambda at: F.when(at > 0, F.substr(md, at + F.length(F.regexp_substr(md, heading)))).otherwise(""))

    def cut(rest: Column) -> Column:
        end = F.regexp_instr(rest, F.lit(rf"(?m)^##{WS}"))
        return bind(end, lambda at: F.when(at > 0, F.substr(rest, F.lit(1), at - 1)).otherwise(rest))

    return bind(below, cut)
