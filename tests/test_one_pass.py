"""White space at the ends, sections and sheets: each row is gone through once, and right at the edges."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from docmill.functions import keys, text
from docmill.functions.charset import WS_TEXT, squeeze, trim
from docmill.operators import grid, sections

ODD = ["", " ", "a \x85", " \x85 b ", "a　　b", "﻿Á́ b  c\td", "x \n \n\n\n y", "Ñandú\xa0\xa0KK —  ß", "a \nb", "\n\n", "iframe \n Image\n z", "a​b", "İ̇ 1"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def column(spark, values, use):
    return [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, t string").orderBy("k").select(use(F.col("t"))).collect()]


def plain_squeeze(s):
    return re.sub(f"[{WS_TEXT}]+", " ", s).strip(WS_TEXT)


def random_texts():
    rnd = random.Random(5)
    return ["".join(rnd.choice("ab é \xa0\t\n \x85Z") for _ in range(rnd.randrange(30))) for _ in range(200)]


def test_white_space_is_taken_as_listed(spark):
    """A next-line character is none, and what stands before one at the end stays, which a pattern's end would not see."""
    values = ODD + random_texts()
    assert column(spark, values, trim) == [v.strip(WS_TEXT) for v in values]
    assert column(spark, values, squeeze) == [plain_squeeze(v) for v in values]
    assert column(spark, values, text.clean_length) == [len(plain_squeeze(v)) for v in values]
    assert column(spark, values, text.for_diff) == [plain_squeeze(v) for v in values]


def test_title_key_of_odd_texts(spark):
    values = ODD + random_texts()
    assert column(spark, values, keys.title_key) == [keys.title_key_of(v) for v in values]
    assert "(?<!" not in plan(spark.createDataFrame([("a",)], "t string").select(keys.title_key(F.col("t"))))


def test_named_sections_are_cut_row_by_row(spark):
    docs = spark.createDataFrame([(1, "x\nCosto\n1\nOBJETIVOS\n\na\n b\ncosto:\n2\nCosto"), (2, None), (3, "Docentes")], "k int, t string")
    out = sections.named_sections(docs, "k", "t")
    assert "Exchange" not in plan(out) and sorted(map(tuple, out.collect())) == [(1, "Costo", "2"), (1, "Información adicional", "x"), (1, "Objetivos", "a\nb")]


@pytest.mark.parametrize("use", [lambda t: grid.schedule_of(grid.csv_rows(t, "k", "t")), lambda t: grid.electives_of(grid.csv_rows(t, "k", "t"))])
def test_a_csv_text_is_read_once(spark, use):
    out = use(spark.createDataFrame([("s", "Materia,Docente,Horarios\r\nA,Roe,C1: Lunes 8 hs C2: Martes 9 hs\r\n")], "k string, t string"))
    got = plan(out)
    assert got.count("MapInArrow") == 1 and "Join" not in got and got.count("Exchange hashpartitioning") <= 1


def test_a_sheet_is_dealt_once(spark):
    """Two blocks, a subject three rows up and four columns right, a gap between rows, and rows above every header."""
    rows = [("s", r, [(c, v) for c, v in row]) for r, row in ((0, [(0, "Com. 9"), (1, "Lunes")]), (2, [(4, " Álgebra")]), (5, [(0, "Comision"), (6, "COMISION")]), (7, [(0, "Com 1"), (1, "Lunes"), (6, "otra"), (7, "Martes")]), (9, [(2, "8 hs"), (7, "Jueves"), (9, "Roe")]))]
    out = grid.schedule_of(spark.createDataFrame(rows, "sheet string, r int, cells array<struct<c: int, v: string>>"))
    assert plan(out).count("Exchange hashpartitioning") == 1 and "Join" not in plan(out)
    assert sorted(map(tuple, out.collect())) == [("s", 0, 7, "Álgebra", "Com 1", "Lunes", "N/D", "N/D"), ("s", 0, 9, "Álgebra", "Com 1", "N/D", "8 hs", "N/D"), ("s", 6, 9, "Materia sin nombre", "N/D", "Jueves", "N/D", "Roe")]
