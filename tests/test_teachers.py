"""Names in cells, and the teachers' table in blocks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docmill.functions import keys
from docmill.functions.charset import trim
from docmill.operators import routing


@pytest.mark.parametrize(
    ("cell", "names"),
    [
        ("Ana Roe<br> Luis Paz", ["Ana Roe", "Luis Paz"]),
        ("Roe, Ana; Paz, Luis\nSaz - Luz", ["Roe, Ana", "Paz, Luis", "Saz", "Luz"]),
        ("- Etchev -", ["Etchev"]),
        ("Sánchez-Rossi, M", ["Sánchez-Rossi, M"]),
        ("n/d; N/D", []),
        (None, []),
        ("a \n - b", ["a", "b"]),
        ("a" + " " * 200_000 + "b-" + "-" * 200_000, ["a" + " " * 200_000 + "b"]),
    ],
)
def test_split_names(spark, cell, names):
    assert spark.createDataFrame([(cell,)], "c string").select(keys.split_names(F.col("c")).alias("n")).first().n == names


def test_trim_of_a_long_run_inside(spark):
    text = "a" + " " * 300_000 + "b" + " " * 300_000
    assert spark.createDataFrame([(text,)], "c string").select(F.length(trim(F.col("c"))).alias("n")).first().n == 300_002


def test_table_in_blocks(spark):
    rows = [
        ("Dra. PAZ, Ana<br>Ñu Roe", "Álgebra |1", "A", "Lunes", "8", 0),
        ("Ana Paz", "Álgebra |1", "A", "Lunes", "8", 1),
        ("Ana Paz", "Zeta\n x", None, "Ver horarios", "9", 2),
        ("Zu Om", "B", "", "N/D", "", 3),
        ("N/D", "B", "", "", "", 4),
    ]
    df = spark.createDataFrame(rows, "teacher string, subject string, commission string, day string, hours string, ord int")
    got = routing.teacher_table(df, size=2).orderBy("block").collect()
    assert [(r.block, r.n_lines) for r in got] == [(0, 4), (1, 2), (2, 2)]
    assert "\n".join(r.md for r in got) == "\n".join([
        routing.TEACHERS, "| Dra. PAZ, Ana | Álgebra /1 | A | Lunes — 8 |", "| Dra. PAZ, Ana | Zeta x | N/D | 9 |", "| Ñu Roe | Álgebra /1 | A | Lunes — 8 |", "| Zu Om | B | N/D | N/D |",
    ])
    none = routing.teacher_table(df.where("ord = 4")).collect()
    assert [(r.block, r.n_lines, r.md[:8]) for r in none] == [(0, 0, "_No hay ")]
