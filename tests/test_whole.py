"""Queries over whole texts and tables: what stands far behind in a text, or in a row that another query leaves out, counts too."""

from __future__ import annotations

import hashlib
import re

import pytest
from helpers import SF
from pyspark.sql import functions as F

from docmill.jobs import registry
from docmill.operators import catalog, sync

FILLER = "palabra " * 60


@pytest.fixture
def documents(spark, tmp_path):
    """A function that lands (doc_id, text, lang, source) rows as the table documents and returns its folder."""

    def land(rows):
        full = [(*r, len(r[1])) for r in rows]
        spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return land


def test_scrub_ids_late_in_the_text(spark, documents):
    sf = documents([(7, f"{FILLER}DNI 30.111.222 fin", "es", "a")])
    got = registry.QUERIES["scrub_ids"](spark, sf).first()
    want = f"DNI [omitido] {FILLER}DNI [omitido] fin DNI [omitido] y (DNI [omitido]) fin"
    assert (got.length, got.hash) == (len(want), hashlib.sha256(want.encode()).hexdigest())


def test_title_case_and_slug_of_a_long_line(spark, documents):
    sf = documents([(7, f"{FILLER}final\nnext", "es", "a")])
    assert registry.QUERIES["title_case"](spark, sf).first().titled == f"{'Palabra ' * 60}Final IVA PYME"
    assert registry.QUERIES["slugify_docs"](spark, sf).first().dated_slug == f"{'palabra-' * 60}final"


def test_checks_see_the_end_of_a_text(spark, documents):
    # ids divisible by 28 get a late phrase, 28k + 7 a placeholder, 28k + 14 a fence and a heading, 28k + 21 a date
    sf = documents([(28, FILLER, "es", "a"), (35, FILLER, "es", "a"), (14, FILLER, "es", "a"), (21, FILLER, "es", "a"), (1, f"{FILLER}{{Nombre del alumno}}\n```\nReciba un cordial saludo", "es", "a")])
    stale = {(r.doc_id, r.name, r.found) for r in registry.QUERIES["stale_dates"](spark, sf).collect()}
    rows = {name: {r.doc_id: r for r in registry.QUERIES[name](spark, sf).collect()} for name in ("structure_check", "prohibited_check", "placeholder_check", "document_check")}
    assert rows["prohibited_check"][28].prohibited == "Es un placer informarle"
    assert rows["prohibited_check"][1].prohibited == "Reciba un cordial saludo;code"
    assert rows["prohibited_check"][14].prohibited == "code"
    assert "{Fecha de inicio}" in rows["placeholder_check"][35].placeholders and "{Nombre del alumno}" in rows["placeholder_check"][1].placeholders
    assert rows["structure_check"][14].missing == "Metadatos del Documento"
    assert (21, "Aranceles e inscripción", "10/11/2024") in stale
    assert rows["document_check"][1].n_errors > 2


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_hashes_hold_no_group(spark):
    d = spark.createDataFrame([("a", i, None if i == 5 else i * 7) for i in range(30, 0, -1)] + [(None, 1, 2), ("b", 3, None)], "g string, k long, v long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        sets, lists = sync.set_hash(d, ["g"], "k", "v"), sync.list_hash(d, ["g"], "k", "v")
        assert "collect_list" not in plan(sets) + plan(lists) + plan(registry.QUERIES["raw_envelope"](spark, SF))
        got = {r.g: (r.set_hash, r.list_hash) for r in sets.join(lists, sets.g.eqNullSafe(lists.g)).select(sets.g, "set_hash", "list_hash").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    a = "|".join(sorted("5" if i == 5 else f"{i}:{i * 7}" for i in range(1, 31))), "\n".join(str(i * 7) for i in range(1, 31) if i != 5)
    assert got == {"a": tuple(map(sha, a)), None: (sha("1:2"), sha("2")), "b": (sha("3"), sha(""))}


def test_insert_positions_without_a_window_over_all_places(spark):
    index = [(f"{'abc'[i % 3]}/{i}", p) for i, p in enumerate([-5, 0, 1, 2, 10**9, 10**9 + 1, 7, 3_000_000])]
    new = ["a/x", "a/y", "b/x", "z/x"]
    got = catalog.insert_positions(spark.createDataFrame(index, "path string, pos long"), spark.createDataFrame([(x,) for x in new], "path string"), F.substring_index("path", "/", 1))
    assert not re.search(r"windowspecdefinition\(place#\d+ ASC", plan(got))
    last = {f: max(p for x, p in index if x[0] == f) for f in "abc"}
    want = sorted([(p, 0, x) for x, p in index] + [(last.get(x[0], float("inf")), 1, x) for x in new])
    assert sorted((r.ord, r.path) for r in got.collect()) == [(k + 1, x) for k, (_, _, x) in enumerate(want)]


def test_counts_and_flags_take_every_row(spark, documents):
    sf = documents([(7, "Same title", "de", "a"), (14, "Same title", "de", "a"), (8, "Other", "de", "a"), (1, "Third", "en", "b")])
    assert {tuple(r) for r in registry.QUERIES["sector_counts_zero"](spark, sf).select("source", "n").collect()} == {("a", 3), ("b", 0)}
    assert {tuple(r) for r in registry.QUERIES["category_counts"](spark, sf).select("category", "n").collect()} == {("de", 3), ("en", 1)}
    assert {r.pos: (r.title_repeated, r.title_first) for r in registry.QUERIES["dup_flags"](spark, sf).collect()} == {1: (False, 1), 7: (False, 7), 8: (False, 8), 14: (True, 7)}
