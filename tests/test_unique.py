"""Uniqueness, validators of indexes and catalogs, and the heading index."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from docmill.operators import checks, sections, unique


def test_repeats_equal_a_loop(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, "", "a", "b", f"k{i % 70}"]), f"s{rnd.randrange(90)}") for i in range(300)]
    seen, want = {}, []
    for i, t, s in rows:
        for kind, value in (("t", t), ("s", s)):
            if value:
                if (kind, value) in seen:
                    want.append((kind, value, i, seen[kind, value]))
                else:
                    seen[kind, value] = i
    df = spark.createDataFrame(rows, "pos long, t string, s string").repartition(5)
    got = unique.repeats(df, {"t": F.col("t"), "s": F.col("s")}, "pos")
    assert sorted((r.kind, r.value, r.place, r.first) for r in got.collect()) == sorted(want)
    flags = {r.pos: (r.t_repeated, r.t_first) for r in unique.flags(df, {"t": "t", "s": "s"}, "pos").collect()}
    assert flags == {i: (("t", t) in seen and bool(t) and seen["t", t] < i, seen.get(("t", t), i) if t else i) for i, t, _ in rows}


def test_a_hot_value_goes_through_no_window(spark):
    df = spark.range(5000).select(F.col("id").alias("pos"), F.lit("same").alias("t"))
    out = unique.repeats(df, {"t": F.col("t")}, "pos")
    assert out.count() == 4999 and "Window" not in out._jdf.queryExecution().executedPlan().toString()


def index(spark, *rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "pos long, path string, title string, category string, url string")


def broken(spark, rows, files=(), routing=(), version=3, updated="2026-01-01", **more):
    found = spark.createDataFrame(list(files), "path string, is_file boolean")
    routed = spark.createDataFrame(list(routing), "path string, sector string")
    got = checks.index_violations(index(spark, *rows), ("a",), ("docs", "cursos"), found, routed, version, updated, **more)
    return sorted((r.severity, r.key, r.rule) for r in got.collect())


def good(*paths):
    return {"files": [(p, True) for p in paths], "routing": [(p, "a") for p in paths]}


def test_a_sound_index(spark):
    assert broken(spark, [("docs/a.md", "A", "c", None), ("cursos/b.md", " ", "c", "https://x.org")], **good("docs/a.md", "cursos/b.md")) == []


@pytest.mark.parametrize(
    "path, want",
    [
        ("/docs/a.md", [("error", "unsafe_path"), ("warning", "unknown_folder")]),
        ("docs/../a.md", [("error", "unsafe_path")]),
        ("docs\\a.md", [("error", "unsafe_path"), ("warning", "unknown_folder")]),
        ("docs/a.txt", [("error", "not_markdown")]),
        ("cursos/Overview.md", [("error", "aggregate")]),
        ("docs/overview.md", []),
        ("docs/bad.md", [("error", "forbidden")]),
        ("else/a.md", [("warning", "unknown_folder")]),
    ],
)
def test_paths(spark, path, want):
    assert broken(spark, [(path, "A", "c", None)], **good(path), forbidden=("docs/bad.md",)) == [(s, path, r) for s, r in want]


def test_rows_of_an_index(spark):
    rows = [("docs/a.md", "Ética", "c", None), ("docs/b.md", "ETICA!", None, ""), (None, None, None, None), ("docs/a.md", "", "c", "x"), ("docs/d", "D", "c", None)]
    got = broken(spark, rows, [("docs/a.md", True), ("docs/b.md", False), ("docs/z.md", True), ("docs/y/z.md", True), ("else/z.md", True)], [("docs/a.md", "nowhere"), ("docs/b.md", "a")], version=0, updated="1/1/2026")
    assert got == sorted(
        [("error", "docs/a.md", "bad_sector")] * 2
        + [("error", "docs/a.md", x) for x in ("no_title", "path_repeated", "bad_url")]
        + [("error", "docs/b.md", x) for x in ("no_category", "not_a_file", "bad_url")]
        + [("error", "docs/d", x) for x in ("no_file", "not_routed", "not_markdown")]
        + [("warning", "docs/b.md", "title_repeated"), ("warning", "docs/z.md", "not_indexed"), ("error", "items[2]", "no_path"), ("error", "index", "version"), ("error", "index", "last_updated")]
    )


def test_a_catalog(spark):
    rows = [(0, "a", "A", "a", "https://x.org", None, None, "2026-01-01"), (1, "a", "", "a", None, "x", "", ""), (2, None, "C", "", "http://x.org", "", "q", "1/1/2026")]
    df = spark.createDataFrame(rows, "pos long, slug string, title string, title_key string, detail_url string, signup_url string, query_url string, start_date string")
    counts = spark.createDataFrame([(4, 1, 2, None)], "active int, matched int, new int, missing int")
    got = sorted((r.severity, r.key, r.rule) for r in checks.catalog_violations(df, counts).collect())
    assert got == sorted(
        [("error", "active[1]", x) for x in ("no_title", "slug_repeated", "bad_detail_url", "bad_signup_url")]
        + [("error", "active[2]", x) for x in ("no_slug", "bad_query_url", "bad_date")]
        + [("warning", "active[1]", "title_repeated"), ("error", "catalog", "rows"), ("error", "catalog", "missing_count"), ("warning", "catalog", "new_rows")]
    )


def test_headings_past_dates_and_sources(spark):
    md = "# T\n## Contacto \nx\n##  Identificación\n2020-01\n## Próxima cohorte\n2020-03-01 y 01/02/2019, 2099-01-01\n### no\n05/05/2020\n## Otra\n2001-01-01\n## Aranceles e inscripción\n2020-01-01 a confirmar\n## Fuentes consultadas\n(https://x.org/a). https://x.org/a, http://y.org/b;\n"
    row = spark.createDataFrame([(md,)], "md string").select(sections.headings(F.col("md"), ("Identificación", "Contacto")).alias("h"), checks.past_dates(F.col("md"), "2026-01-01").alias("d"), checks.source_urls(F.col("md")).alias("u"), sections.section_text(F.col("md"), "Contacto").alias("t"), sections.section_text(F.col("md"), "None").alias("n")).first()
    assert row.h == ["Contacto", "Identificación"] and row.u == ["https://x.org/a", "http://y.org/b"]
    assert row.d == [f"Próxima cohorte: {x}" for x in ("2020-03-01", "01/02/2019", "05/05/2020")] and row.t.strip() == "x" and row.n == ""


def test_long_texts_have_sections(spark):
    md = "## Contacto\n" + "- a\n" * 200_000 + "## Próxima cohorte\n2020-01-01"
    row = spark.createDataFrame([(md,)], "md string").select(F.length(sections.section_text(F.col("md"), "Contacto")).alias("n"), checks.past_dates(F.col("md"), "2026-01-01").alias("d")).first()
    assert row.n == 800_001 and row.d == ["Próxima cohorte: 2020-01-01"]
