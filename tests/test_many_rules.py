"""Routing by many rules: the automaton decides as the CASE expression does."""

from __future__ import annotations

import random

from docmill.jobs.sheets import TAXONOMY
from docmill.operators.routing import Match, Taxonomy

ROWS = "path string, title string, category string, sector string"


def plain(tax: Taxonomy, path, title, category, sector) -> str:
    path, title, category = ((x or "").lower() for x in (path, title, category))

    def holds(m: Match) -> bool:
        return any(path.startswith(x) for x in m.path_prefix) or any(x in path for x in m.path_includes) or any(x in title for x in m.title_includes) or any(x in category for x in m.category_includes) or category in m.category_equals

    steps = [(s, m) for s, m, force in tax.overrides if force and holds(m)]
    if steps:
        return steps[0][0]
    if sector in {*tax.sectors, tax.fallback}:
        return sector
    return next((s for s, m in [*((s, m) for s, m, _ in tax.overrides), *tax.sectors.items()] if holds(m)), tax.fallback)


def test_automaton_equals_expression(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/part.parquet").selectExpr("p_partkey", "p_brand AS path", "p_name AS title", "p_type AS category", "CASE p_partkey % 10 WHEN 0 THEN 'exact' WHEN 1 THEN 'nowhere' END AS sector")
    by_case, by_machine = (sorted(map(tuple, TAXONOMY.assign(p, "routed", most=most).select("p_partkey", "routed").collect())) for most in (200, 0))
    assert by_case == by_machine and len({s for _, s in by_case}) > 3


def test_ten_thousand_rules(spark):
    rnd = random.Random(5)
    text = lambda n: "".join(rnd.choices("abcde/", k=n))
    some = lambda n, k: tuple({text(k) for _ in range(n)})
    sectors = {f"s{k}": Match(some(20, 5), some(20, 6), some(20, 6), some(20, 6), some(20, 3)) for k in range(110)}
    tax = Taxonomy(sectors, "rest", ((("s3"), Match(path_includes=some(3, 3)), True), ("s4", Match(title_includes=some(3, 3)), False)))
    assert len(tax.rules()) > 10_000
    rows = [(text(rnd.randrange(12)), text(rnd.randrange(12)), rnd.choice([None, text(3)]), rnd.choice([None, None, "s9", "nowhere"])) for _ in range(1500)]
    got = [(r.path, r.title, r.category, r.sector, r.routed) for r in tax.assign(spark.createDataFrame(rows, ROWS), "routed").collect()]
    assert sorted(map(str, got)) == sorted(str((*r, plain(tax, *r))) for r in rows) and len({r[4] for r in got}) > 50


def test_empty_needles_nulls_and_an_empty_table(spark):
    tax = Taxonomy({"a": Match(category_equals=("",)), "b": Match(path_prefix=("",))}, "rest", (("c", Match(title_includes=("x",)), True),))
    rows = [(None, None, None, None), ("p", "X", "k", "a"), ("p", "t", "k", "a"), ("p", "t", "k", None)]
    df = spark.createDataFrame(rows, ROWS)
    assert [r.routed for r in tax.assign(df, "routed", most=0).collect()] == [r.routed for r in tax.assign(df, "routed").collect()] == ["a", "c", "a", "b"]
    assert tax.assign(df.limit(0), "routed", most=0).collect() == []
