from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from docmill.functions import charset, dates, keys, text, urls


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("&amp;lt; &lt;b&gt; &nbsp;|&unknown; &aacute;", "&lt; <b>  |&unknown; á"),
        ("&#38;lt;", "<"),
        ("&#x41;&#66;&#128512;", "AB😀"),
        ("&#99999999999; &#55296; &#0;", "&#99999999999; &#55296; &#0;"),
        ("no entities", "no entities"),
        ("", ""),
    ],
)
def test_entities(spark, html, want):
    assert one(spark, text.decode_entities(F.col("h")), h=html) == want


def test_html_to_text(spark):
    html = "<!-- x --><nav><a>menu</a></nav><script>var a='</p>'</script><h1>T&iacute;tulo</h1><p>one<br/>two  \t three</p><ul><li>-</li><li class='x'>item</li></ul><FOOTER>gone</FOOTER>"
    assert one(spark, text.html_to_text(F.col("h")), h=html) == "Título\none\ntwo three\n- -\n- item"
    assert one(spark, text.html_to_text(F.col("h")), h=None) is None


def test_titles(spark):
    assert one(spark, text.section_title(F.col("h")), h="<h1><b></b></h1><h1>no</h1><h2>sub &amp; x</h2>") == "sub & x"
    assert one(spark, text.title(F.col("h")), h="<TITLE lang='x'> a\nb </TITLE>") == "a\nb"
    assert one(spark, text.title(F.col("h")), h="none") == ""


def test_crops(spark):
    assert one(spark, text.crop_main(F.col("h")), h='a<div class="big footer x">b</div><footer>c') == "a"
    assert one(spark, text.crop_main(F.col("h")), h="<footers>all") == "<footers>all"
    assert one(spark, text.blog_content(F.col("h")), h='x<div class="post blog-content">in<div class="sidebar">out') == "in"
    assert one(spark, text.blog_content(F.col("h")), h="whole") == "whole"


def test_runs(spark):
    given = "|:" + "-" * 214000 + "|\n====\n_____\na" + " " * 90 + "b---"
    assert one(spark, text.sanitize_runs(F.col("t")), t=given) == "|:---|\n===\n___\na b---"


def test_identity_numbers(spark):
    f = lambda t: one(spark, text.scrub_ids(F.col("t")), t=t)
    assert f("DNI N° 23.701.072 y") == "DNI [omitido] y"
    assert f("D.N.I. Nº 34299166") == "DNI [omitido]"
    assert f("x (D.N.I. N° 38.898.177) y") == "x (DNI [omitido]) y"
    assert f("ñdni: 22.215.589") == "ñDNI [omitido]"
    assert f("resolution 123.456") == "resolution 123.456"


def test_noise(spark):
    assert one(spark, text.cut_noise(F.col("t")), t="menu\nRequisitos\nb\nFundamentación\nc\nCONSULTAS\nd\nCopyright ©") == "Fundamentación\nc"
    assert one(spark, text.cut_noise(F.col("t")), t="plain") == "plain"


def test_fence_and_headings(spark):
    assert one(spark, text.strip_fence(F.col("t")), t="```markdown\n# A\nb\n```\n") == "# A\nb"
    assert one(spark, text.strip_fence(F.col("t")), t="a ```x``` b") == "a ```x``` b"
    assert one(spark, text.h1_title(F.col("t"), F.lit("f")), t="x\n# One \n# Two") == "One"
    assert one(spark, text.h1_title(F.col("t"), F.lit("f")), t="## no") == "f"


def test_for_diff(spark):
    assert one(spark, text.for_diff(F.col("t")), t="a\n**ÚLTIMA revisión humana**: 2026\n  b  **Última revisión automática** c") == "a b **Última revisión automática** c"


def test_accents_agree_with_unicode():
    old, new = charset.accents()
    assert len(old) == len(new) == len(set(old))
    assert all(unicodedata.normalize("NFD", o)[0] == n for o, n in zip(old, new, strict=True))


def test_keys(spark):
    assert one(spark, keys.slug(F.col("t")), t=" ¡Ñandú & Cía! 2026 ") == "nandu-cia-2026"
    assert one(spark, keys.slug(F.col("t")), t="¡!") == "index"
    assert one(spark, keys.slug(F.col("t"), None), t=None) == ""
    assert one(spark, keys.dated_slug(F.col("t")), t="Curso de IVA 2026 ") == "curso-de-iva"
    assert len(one(spark, keys.course_slug(F.col("t")), t="palabra " * 40)) == 120
    assert one(spark, keys.name_key(F.col("t")), t="Dra. PÉREZ, Ana María") == one(spark, keys.name_key(F.col("t")), t="ana maria  Perez")
    assert one(spark, keys.name_key(F.col("t")), t="Dr. C.P.N.") == ""
    assert one(spark, keys.without_number(keys.folder_key(F.col("t"))), t="07_AULAS VIRTUALES") == "aulas-virtuales"
    assert one(spark, keys.section_slug(F.col("p"), "/academica", "academica"), p="/academica/categorias/Ingreso/2026/") == "ingreso-2026"
    assert one(spark, keys.section_slug(F.col("p"), "/academica", "academica"), p="/academica/") == "academica"
    assert one(spark, keys.keywords(F.col("t")), t="La Gestión de la gestión al PDF") == ["gestion", "gestion"]


def test_dates(spark):
    assert one(spark, dates.start_date(F.col("t")), t="x Inicio : <b> 3/11/2026</b>") == "2026-11-03"
    assert one(spark, dates.iso_date(F.col("t")), t=" 05/06/2026 ") == "2026-06-05"
    assert one(spark, dates.iso_date(F.col("t")), t="5/6/2026") is None
    found = one(spark, dates.dates_in(F.col("t")), t="2024-02 y 2023-13-01, 31/02/2024, 1999-01-01")
    assert [(d.found, str(d.day)) for d in found] == [("2024-02", "2024-02-28"), ("2023-13-01", "2024-01-01"), ("31/02/2024", "2024-03-02")]
    assert one(spark, dates.whole_days(F.lit("2026-05-21"), F.col("t")), t="2026-05-20 12:00:00") == 0
    assert one(spark, dates.whole_days(F.lit("2026-05-21"), F.col("t")), t="2026-05-21 01:00:00") == -1
    day = one(spark, dates.split_weekday(F.col("t")), t=" Lunes  8 hs ")
    assert (day.day, day.hours) == ("Lunes", "8 hs")
    assert one(spark, dates.join_weekday(F.col("a"), F.col("b")), a="Ver horarios", b="8 hs") == "8 hs"
    assert one(spark, dates.join_weekday(F.col("a"), F.col("b")), a="Lunes", b="8 hs") == "Lunes — 8 hs"
    assert one(spark, dates.join_weekday(F.col("a"), F.col("b")), a=None, b="n/d") == "N/D"


@pytest.mark.parametrize(
    ("href", "want"),
    [
        ("/x?y=1", "https://a.org/x?y=1"),
        ("z.html", "https://a.org/b/z.html"),
        ("../z", "https://a.org/z"),
        ("./z/../w", "https://a.org/b/w"),
        ("//c.org/d", "https://c.org/d"),
        ("HTTPS://C.org/D", "https://c.org/D"),
        ("?q", "https://a.org/b/c?q"),
        ("#top", "https://a.org/b/c#top"),
        ("../../../../../../z", "https://a.org/z"),
        ("d/e/f/g/h/i/../../../../../j", "https://a.org/b/d/j"),
        ("d/..", "https://a.org/b/"),
        ("x?y=/../z", "https://a.org/b/x?y=/../z"),
        ("mailto:x@y", None),
        ("", None),
    ],
)
def test_absolute(spark, href, want):
    assert one(spark, urls.absolute(F.col("h"), F.col("b")), h=href, b="https://a.org/b/c") == want


def test_urls(spark):
    assert one(spark, urls.normalized(F.col("u")), u="https://A.org/b//?x#y") == "https://a.org/b"
    assert one(spark, urls.normalized(F.col("u")), u="https://a.org") == "https://a.org/"
    assert one(spark, urls.normalized(F.col("u")), u="nothing") == "nothing"
    assert [one(spark, urls.is_http(F.col("u")), u=u) for u in ("http://x", "ftp://x", None, "https://")] == [True, False, False, False]
    kind = lambda u: one(spark, urls.link_kind(F.col("u"), ("s.org",), ("i.org",), ("guarani",)), u=u)
    assert [kind(u) for u in ("https://docs.google.com/spreadsheets/d/1", "https://x.org/a.PDF?x", "https://s.org/", "https://x.org/guarani", "https://w.i.org/", "https://x.org/")] == ["google_sheet", "pdf", "system", "system", "internal", "external"]
    assert [one(spark, urls.target_kind(F.col("u")), u=u) for u in ("https://x/wp-content/uploads/a.pdf", "https://x/a.png", "https://x/wp-content/uploads/a", "https://x/a")] == ["document", "media", "media", "page"]
    assert [one(spark, urls.safe_path(F.col("p"), ("cursos/",)), p=p) for p in ("cursos/a.md", "cursos/../a.md", "x/a.md", "cursos//a.md", "cursos/a.txt")] == ["cursos/a.md", None, None, None, None]


@pytest.mark.parametrize(
    "given, want",
    [
        ("curso: ética-fiscal", "Curso: Ética-Fiscal"),
        ("ßVER  el\nÑANDÚ", "ßver El\nÑandú"),
        ("IMPUESTOS — iVA e ia", "Impuestos — Iva E IA"),
        ("éclair  über ÿes", "Éclair Über ÿes"),
        ("", ""),
    ],
)
def test_title_case(spark, given, want):
    assert one(spark, text.title_case(F.col("t")), t=given) == want


LONG = 214_000


@pytest.mark.parametrize(
    "column, given, want",
    [
        (lambda: text.scrub_ids(F.col("t")), "DNI 1" + ".2 " * LONG + "9", "DNI [omitido]"),
        (lambda: text.clean_subject(F.col("t")), "- " * LONG + "tema", "tema"),
        (lambda: keys.folder_key(F.col("t")), "a" + "- _" * LONG + "b", "a-b"),
        (lambda: text.sanitize_runs(F.col("t")), "a" + "-" * LONG, "a---"),
        (lambda: text.title_case(F.col("t")), "-a" * LONG, "-A" * LONG),
        (lambda: text.clean_cell(F.col("t")), "|" * LONG, "/" * LONG),
        (lambda: text.normalize_spaces(F.col("t")), "a" + "\n " * LONG + "b", "a\n\nb"),
        (lambda: text.html_to_text(F.col("t")), "<b>" * LONG + "a" + "<li>" * 9, "a- - - - - - - - -"),
        (lambda: text.decode_entities(F.col("t")), "&amp;" * LONG, "&" * LONG),
        (lambda: keys.slug(F.col("t")), "a" + "/." * LONG + "b", "a-b"),
        (lambda: keys.name_key(F.col("t")), "b," * LONG + "a", "a b"),
        (lambda: keys.without_number(F.col("t")), "1" * LONG + " - b", "b"),
        (lambda: text.cut_noise(F.col("t")), "Requisitos" + "-\n" * LONG, ("Requisitos" + "-\n" * LONG).strip()),
        (lambda: text.for_diff(F.col("t")), "a\n" * LONG, ("a " * LONG).strip()),
        (lambda: F.size(keys.keywords(F.col("t"))), "abc def " * LONG, 2 * LONG),
    ],
)
def test_long_runs(spark, column, given, want):
    """Java takes a stack frame for each repetition of a group of alternatives; none of these may."""
    assert one(spark, column(), t=given) == want
