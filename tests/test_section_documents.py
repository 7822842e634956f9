"""Sections as documents: landing rows, grouped appendices, review reasons."""

from __future__ import annotations

import pytest

from docmill.operators import section_documents as s

PAGE, LINK = "section string, ord int, url string, title string, text string, error string", "section string, ord int, kind string, url string"
LONG = "Texto útil de la página. " * 20


def run(spark, pages, links=(), truncated=False):
    rows = spark.createDataFrame([("a", k, *p) for k, p in enumerate(pages)], PAGE)
    found = spark.createDataFrame([("a", k, *x) for k, x in enumerate(links)], LINK)
    about = spark.createDataFrame([("a", "acad", "Académica", "kb", "/academica/", truncated)], "section string, section_id string, name string, folder string, prefix string, truncated boolean")
    return {(r.path, r.url): r for r in s.candidates(rows, found, about, "2026-05-21", "el sitio", "el asistente").collect()}


ROOT = "https://x.org/academica"


def test_root_holds_the_appendix(spark):
    got = run(spark, [(ROOT, "Inicio", LONG, None), (f"{ROOT}/thin/", "Corta", "poco", None), (f"{ROOT}/bad", None, None, "HTTP 500"), (f"{ROOT}/categorias/x", "C", LONG, None)], [("document", "https://x.org/a.pdf"), ("pending", "https://x.org/p")])
    (row,) = got.values()
    assert (row.slug, row.path, row.is_root, row.review_reasons) == ("acad-acad", "kb/acad.md", True, [])
    part = row.md[row.md.index("## Enlaces") : row.md.index("## Advertencias")]
    assert part.index("a.pdf") < part.index("Corta: https://x.org/academica/thin/") < part.index("bad (HTTP 500)") and "pending" not in part and "x.org/p" not in part
    assert row.md.startswith("# Inicio\n\n## Para qué sirve\n\n- Documento del sector **Académica**") and row.md.endswith("**Revisión humana**: pendiente\n")


def test_pending_links_count_only_in_a_cut_crawl(spark):
    thin = [(ROOT, "Inicio", "poco", None)]
    assert "Crawl truncado" in next(iter(run(spark, thin, [("pending", "https://x.org/p")], True).values())).md
    assert "Crawl truncado" not in next(iter(run(spark, thin, [("pending", "https://x.org/p")]).values())).md


def test_landing_where_the_root_has_no_text(spark):
    got = run(spark, [(f"{ROOT}/", "Inicio", "poco", None), (f"{ROOT}/Uno", "Uno", LONG, None)], [("document", "https://x.org/a.pdf")])
    assert sorted(got) == [("kb/acad.md", ROOT), ("kb/uno.md", f"{ROOT}/Uno")]
    landing, page = got["kb/acad.md", ROOT], got["kb/uno.md", f"{ROOT}/Uno"]
    assert landing.is_root and landing.title == "Académica" and "landing de sección" in landing.md and "a.pdf" in landing.md and "Inicio: " in landing.md
    assert not page.is_root and "Enlaces relacionados" not in page.md


def test_no_landing_without_links(spark):
    assert run(spark, [(f"{ROOT}/categorias/a", "C", LONG, None)]) == {}


def test_landing_of_a_section_without_pages(spark):
    got = run(spark, [], [("document", "https://x.org/a.pdf")])
    assert list(got) == [("kb/acad.md", "/academica/")]


def test_collisions_among_important_pages_only(spark):
    got = run(spark, [(ROOT, "I", LONG, None), (f"{ROOT}/b", "B", "poco", None), (f"{ROOT}/B/", "B2", LONG, None), (f"{ROOT}//b", "B3", LONG, None)])
    reasons = {u: r.review_reasons for (_, u), r in got.items()}
    assert reasons[f"{ROOT}/B/"] == [] and reasons[f"{ROOT}//b"] == ["colisión de ruta: kb/b.md ya fue derivado de otra subpágina"]
    assert "Requiere revisión humana: colisión" in got["kb/b.md", f"{ROOT}//b"].md


@pytest.mark.parametrize(("words", "found"), [("Nombre  y\nApellido", True), ("Documento y lista de alumnos", True), ("DNI: 1. Nómina", True), ("documentos y listas", False), ("el documento oficial", False)])
def test_personal_data(spark, words, found):
    (row,) = run(spark, [(ROOT, "I", f"{LONG}\n{words}", None)]).values()
    assert bool(row.review_reasons) == found
