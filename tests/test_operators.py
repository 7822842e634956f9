from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from docmill.operators import catalog, checks, crawl, grid, reports, routing, sections, sync
from docmill.sources import landed


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def cells(spark, text, sheet="s"):
    return grid.csv_cells(spark.createDataFrame([(sheet, text)], "k string, t string"), "k", "t")


def test_split_csv():
    assert grid.split_csv('a,"b ""q"", c"\r\n,\n"x\ny"') == [["a", 'b "q", c'], ["", ""], ["x\ny"]]
    assert grid.split_csv("") == [] and grid.split_csv("a\n") == [["a"]] and grid.split_csv('a"b,c"d') == [["ab,cd"]]


def test_exams(spark):
    text = "Fecha Examen,,,,,,\nMiércoles,29/4/2026,,,99,left out,\nDesde el,22/4/2026,al,27/4/2026,3160,Sociedades,09:00 Hs\n,,,,,,\n,,,,1015, Costos ,\n,,,,1016,,10:00\n"
    got = rows(grid.exams(cells(spark, text)), "code", "subject", "day", "date", "enrolment", "hour")
    assert got == [("1015", "Costos", "Miércoles", "29/4/2026", "Desde el 22/4/2026 al 27/4/2026", ""), ("3160", "Sociedades", "Miércoles", "29/4/2026", "Desde el 22/4/2026 al 27/4/2026", "09:00 Hs")]


def test_schedule_stacked(spark):
    text = "- First -,,,\nComisiones,Días,Horario,Docente\nCom. N° 1,Lunes,8 hs,Roe\n,Martes,,\n- Anual -,Jueves,9 hs,Nobody\n,Viernes,10 hs,\nSecond,,,\ncomisiones,Días,Horario,Docente\nCom N° 2,,7 hs,\n"
    got = rows(grid.schedule(cells(spark, text)), "r", "subject", "commission", "day", "hours", "teacher")
    assert got == [(2, "First -", "Com. N° 1", "Lunes", "8 hs", "Roe"), (3, "First -", "Com. N° 1", "Martes", "N/D", "Roe"), (5, "First -", "Com. N° 1", "Viernes", "10 hs", "Roe"), (8, "Second", "Com N° 2", "N/D", "7 hs", "N/D")]


def test_schedule_side_by_side(spark):
    text = ",A,,,,,B\nComisiones,Días,Horario,Docente,,Comisiones,Días,Horario,Docente\nCom 1,Lunes,,X,,Com 2,,9 hs,Y\n"
    got = rows(grid.schedule(cells(spark, text)), "start", "subject", "commission", "teacher")
    assert got == [(0, "A", "Com 1", "X"), (5, "B", "Com 2", "Y")]


def test_schedule_without_header(spark):
    text = "Inglés técnico,,,\nCom. N° 1,Lunes,8 hs,Roe\nnote,,,\nother,Martes,,\n"
    got = rows(grid.schedule_without_header(cells(spark, text)), "r", "subject", "commission", "day", "teacher")
    assert got == [(1, "Inglés técnico", "Com. N° 1", "Lunes", "Roe"), (3, "Inglés técnico", "other", "Martes", "Roe")]


def test_electives(spark):
    text = 'Nombre de materia,Docente,Horario\nOne,Roe,"C1: Lunes 8 hs Prof. Ana Paz. C2: Martes 9 hs"\nTwo,,\n,x,y\n'
    got = rows(grid.electives(cells(spark, text)), "subject", "commission", "day", "hours", "teacher")
    assert got == [("One", "C1", "Lunes", "8 hs", "Ana Paz"), ("One", "C2", "Martes", "9 hs", "Roe"), ("Two", "Única", "Ver horarios", "", "")]


def test_sections_and_diff(spark):
    d = spark.createDataFrame([(1, "intro\n## A\nx\n## B \ny\n## A\nz"), (2, None)], "k int, md string")
    got = rows(sections.md_sections(d, "k", "md"), "k", "ord", "name", "body")
    assert got == [(1, 0, "__preface__", "intro"), (1, 1, "A", "z"), (1, 2, "B", "y"), (2, 0, "__preface__", "")]
    old = spark.createDataFrame([(1, "intro\n## A\nz\n\n**Última revisión humana**: 2020\n## C\nq")], "k int, md string")
    diff = sections.diff_sections(sections.md_sections(d.where("k = 1"), "k", "md"), sections.md_sections(old, "k", "md"), "k")
    assert rows(diff, "name", "change") == [("B", "added"), ("C", "removed")]
    docs = spark.createDataFrame([(1, True), (2, False), (3, True)], "k int, has_current boolean")
    assert rows(sections.decide(docs, diff, "k", ("A",)), "k", "decision", "reason") == [(1, "requires_review", "structural_change"), (2, "requires_review", "no_existing_md"), (3, "no_change", "sections_match")]


def test_structure(spark):
    good = "# T\n" + "".join(f"## {n}\nx\n" for n in checks.REQUIRED)
    swapped = good.replace("## Contacto\n", "## TMP\n").replace("## Plan de estudios\n", "## Contacto\n").replace("## TMP\n", "## Plan de estudios\n")
    d = spark.createDataFrame([(0, good), (1, swapped), (2, "# T\n## Contenido\n## Fuentes consultadas\n"), (3, ""), (4, "\n\n## x")], "k int, md string")
    got = {r.k: r.m for r in d.select("k", checks.structure(F.col("md")).alias("m")).collect()}
    assert got[0] == [] and got[2] == ["Metadatos del Documento"]
    # Plan de estudios is found late, and what stands before it is out of order from there on
    assert got[1][:1] == ["Cuerpo docente"] and "Contacto" in got[1] and "Plan de estudios" not in got[1]
    assert got[3] == ["H1", *checks.REQUIRED] and got[4][0] == "H1"


def test_stale_dates(spark):
    s = spark.createDataFrame([(1, "Próxima cohorte", "2020-03 y 01/01/2030"), (2, "Próxima cohorte", "2020-03-01, a confirmar"), (3, "Contacto", "2020-01-01")], "k int, name string, body string")
    assert rows(checks.stale_dates(s, "k", "2026-05-21"), "k", "found") == [(1, "2020-03")]


def test_catalog(spark):
    index = spark.createDataFrame([("a.md", "A", "key a", "sa", 1), ("b.md", "B", "key a", "sb", 2), ("c.md", "C", "key c", "sc", 3)], "path string, title string, title_key string, slug string, pos int")
    active = spark.createDataFrame([(1, "key a", "zz"), (2, "other", "sc"), (3, None, "nope")], "id int, title_key string, slug string")
    m = catalog.match(active, index)
    assert rows(m, "id", "status", "index_path") == [(1, "indexed", "b.md"), (2, "indexed", "c.md"), (3, "new_unindexed", None)]
    gone = catalog.missing(index, m)
    assert rows(gone, "path") == [("a.md",)]
    assert rows(catalog.retire(active, gone), "path", "action") == [("a.md", "retire")]
    assert rows(catalog.retire(active.limit(0), gone), "path", "action") == [("a.md", "rejected")]
    assert rows(catalog.retire(active.limit(1), index), "action") == [("keep_for_review",)] * 3


def test_insert_positions(spark):
    index = spark.createDataFrame([("x/1", 1), ("y/1", 2), ("x/2", 3)], "path string, pos int")
    new = spark.createDataFrame([("y/0",), ("z/9",), ("x/0",)], "path string")
    got = catalog.insert_positions(index, new, F.substring_index("path", "/", 1)).orderBy("ord").collect()
    assert [r.path for r in got] == ["x/1", "y/1", "y/0", "x/2", "x/0", "z/9"] and [r.ord for r in got] == list(range(1, 7))


def test_file_status(spark):
    state = spark.createDataFrame([(1, 1, "a", "h1"), (2, 1, "a", "h2"), (3, 1, "a", "h3"), (9, 1, "a", "h9")], "id int, modified int, slug string, hash string")
    now = spark.createDataFrame([(1, 1, "a", "zz", None, None), (2, 2, "a", "h2", None, None), (3, 2, "a", None, None, "boom"), (4, 1, "a", "h4", True, None), (5, 1, "a", "h5", False, None)], "id int, modified int, slug string, hash string, duplicate boolean, error string")
    assert rows(sync.file_status(now, state), "id", "status") == [(1, "unchanged"), (2, "synchronized"), (3, "error"), (4, "skipped (duplicate)"), (5, "candidate"), (9, "deleted")]


def test_worst_and_ladder(spark):
    d = spark.createDataFrame([("a", "auto_merge"), ("a", "rejected"), ("b", "no_change")], "g string, decision string")
    assert rows(sync.worst(d, ["g"]), "g", "decision", "n_documents") == [("a", "rejected", 2), ("b", "no_change", 1)]
    one = d.select(sync.ladder((F.col("g") == "x", "error"), (F.col("g") == "a", "skipped"), (F.lit(True), "no_change")).alias("x"))
    assert rows(one, "x") == [("no_change",), ("skipped",), ("skipped",)]


def test_routing(spark):
    t = routing.Taxonomy({"a": routing.Match(path_prefix=("a/",)), "b": routing.Match(title_includes=("Norma",), category_equals=("x",))}, "z", (("b", routing.Match(path_includes=("-res-",)), True), ("a", routing.Match(title_includes=("tecnicatura",)), False)), {"a": ("Aulas Virtuales",), "b": ("03-normas",)})
    d = spark.createDataFrame([("a/-res-1.md", "T", "c", "a"), ("q.md", "T", "c", "b"), ("q.md", "Tecnicatura", "c", "nope"), ("A/x", None, None, None), ("q", "la norma", "", None), ("q", "", "X", None), ("q", "", "xx", None)], "path string, title string, category string, sector string")
    assert [r.s for r in d.select(t.route().alias("s")).collect()] == ["b", "b", "a", "a", "b", "b", "z"]
    f = spark.createDataFrame([("07_AULAS_VIRTUALES",), ("Normas",), ("03 - normas",), ("other",), (None,)], "folder string")
    assert sorted(map(str, (r.sector for r in t.by_folder(f, "folder").collect()))) == ["None", "None", "a", "b", "b"]


def test_overlap(spark):
    left = spark.createDataFrame([(1, ["x", "x", "y"])], "id int, words array<string>")
    right = spark.createDataFrame([(1, ["x"]), (2, ["x", "x"]), (3, ["y"]), (4, ["y"]), (5, ["z"]), (6, ["y"])], "id int, words array<string>")
    assert rows(routing.overlap(left, right), "rank", "right_id", "score") == [(1, 2, 2), (2, 3, 1), (3, 4, 1)]


def test_crawl_budget(spark):
    edges = spark.createDataFrame([(0, 1), (0, 2), (1, 3), (2, 3), (3, 0), (3, 4)], "src long, dst long")
    root = spark.createDataFrame([(0,)], "node long")
    assert rows(crawl.reach(edges, root), "node", "depth") == [(0, 0), (1, 1), (2, 1), (3, 2), (4, 3)]
    assert rows(crawl.capped(edges, root, 3, 2), "node", "status") == [(0, "fetched"), (1, "fetched"), (2, "pending"), (3, "pending")]


def test_reports(spark):
    d = spark.createDataFrame([("azul",), ("árbol",), ("ñandu",), ("nube",)], "n string")
    assert [r.n for r in reports.by_name(d, "n").collect()] == ["árbol", "azul", "nube", "ñandu"]
    t = spark.createDataFrame([("g", 2, "b", ""), ("g", 1, "a", None)], "g string, o int, x string, y string")
    assert reports.md_table(t, ["g"], ["o"], {"X": F.col("x"), "Y": F.col("y")}).first().md == "| X | Y |\n| :--- | :--- |\n| a | - |\n| b | - |"
    assert reports.summary(spark.createDataFrame([("b", 1), ("a", 2)], "k string, n int"), "k", "n").first().md == "- **a**: 2\n- **b**: 1"


def test_landed(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.md").write_text("# A\nx")
    (tmp_path / "sub" / "b.md").write_text("# B")
    (tmp_path / "s.csv").write_text('a,"b\nc"\nd\n')
    (tmp_path / "reg.json").write_text('{"sources": [{"slug": "x", "strategy": "one", "maxPages": 3}, {"slug": "y", "strategy": "tbd"}]}')
    (tmp_path / "index.json").write_text('{"version": 1, "items": [{"path": "cursos/a-b.md", "title": "Á B"}]}')
    assert [r.markdown for r in landed.markdown(spark, str(tmp_path)).collect()] == ["# A\nx"]
    assert rows(landed.sheets(spark, str(tmp_path)), "sheet", "r", "c", "v") == [("s", 0, 0, "a"), ("s", 0, 1, "b\nc"), ("s", 1, 0, "d")]
    r = landed.registry(spark, str(tmp_path / "reg.json"))
    assert rows(r, "slug", "maxPages", "place") == [("x", 3, "sources[0]"), ("y", None, "sources[1]")]
    assert rows(landed.by_strategy(r, {"one": lambda s: s.select("slug")}), "slug") == [("x",)]
    with pytest.raises(ValueError, match="tbd"):
        landed.by_strategy(r, {"one": lambda s: s.select("slug")}, skipped=())
    (tmp_path / "tax.json").write_text('{"fallback": "z", "sectors": {"a": {"match": {"pathPrefix": ["X/"]}, "aliases": ["Uno"]}, "b": {"match": {"titleIncludes": ["t"]}}}, "overrides": [{"sector": "b", "match": {"categoryEquals": ["c"]}, "force": true}]}')
    t = landed.taxonomy(spark, str(tmp_path / "tax.json"))
    d = spark.createDataFrame([("x/1", "t", "c", None), ("x/1", "t", "d", None), ("y", "T", "d", None), ("y", "", "d", "a"), ("y", "", "d", "q")], "path string, title string, category string, sector string")
    assert [r.r for r in d.select(t.route().alias("r")).collect()] == ["b", "a", "b", "a", "z"] and t.aliases == {"a": ("Uno",)}
    i = landed.index(spark, str(tmp_path / "index.json")).first()
    assert (i.title_key, i.slug) == ("a b", "a-b")
    hidden = tmp_path / "No_Indexar"
    hidden.mkdir()
    (hidden / "x.txt").write_text("x")
    (tmp_path / "w.doc").write_bytes(b"\x00\x01Hola\x07 mundo")
    files = landed.extract(landed.drive(spark, str(tmp_path)))
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.error) for r in files.collect()}
    assert got["w.doc"] == ("Hola mundo", None) and "x.txt" not in got and got["reg.json"] == (None, "no reader for json")


def test_watch(spark, tmp_path):
    from docmill.streaming.changes import watch

    src = tmp_path / "src"
    paths = [str(tmp_path / x) for x in ("out", "state", "check")]
    for part in ([(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, "d")], [(4, "e")]):
        spark.createDataFrame(part, "k int, t string").coalesce(1).write.mode("append").parquet(str(src))
        stream = spark.readStream.schema("k int, t string").parquet(str(src))
        watch(stream, "k", "t", *paths).awaitTermination(60)
    got = rows(spark.read.parquet(paths[0]), "batch", "k", "status")
    assert got == [(0, 1, "new"), (0, 2, "new"), (1, 1, "unchanged"), (1, 2, "changed"), (1, 3, "new"), (2, 4, "new")]
    state = spark.read.parquet(paths[1])
    assert [(r.batch, r.k) for r in state.where("batch > 0").orderBy("batch", "k").collect()] == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (2, 4)]
