"""License scans: signatures one by one, suppression, odd rows."""

from __future__ import annotations

import re

import pytest
from llm_helpers import write_tables

from docmill.llm import licenses, license_rules
from docmill.llm.license_rules import Rule, rules


def plain(text: str | None, listed: list[Rule]) -> tuple:
    """The result of one text by loops over words."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    spaced = "".join(f" {w} " for w in words)
    found = []
    for r in listed:
        for m in re.finditer(r.regex, spaced) if r.keyword in spaced else ():
            found.append((spaced.count(" ", 0, m.start()) // 2, spaced.count(" ", 0, m.end()) // 2, r))
    inside = lambda d, e: e is not d and e[0] <= d[0] and e[1] >= d[1] and (e[2].priority, d[1] - d[0] - e[1] + e[0], e[2].rule) < (d[2].priority, 0, d[2].rule)
    kept = [d for d in found if d[2].priority == 0 or not any(inside(d, e) for e in found)]
    base = [d for d in kept if d[2].priority == 0]
    names = lambda ds: ",".join(sorted({d[2].label for d in ds}))
    return len(words), len(base), min((d[0] for d in base), default=None), max((d[0] for d in base), default=None), names(base), names(kept), max((licenses.SURE[d[2].priority] for d in kept), default=0.0)


def rows_of(df) -> dict:
    return {x.doc_id: (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels, x.score) for x in df.collect()}


TEXTS = [
    "Licensed under CC BY-NC 4.0.",
    "Released under the MIT License. Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0.\nPermission is hereby granted, free of charge, to any person.",
    "a Cc By nC, cc by-nc-sa 3.0 and cc by",
    "SPDX-License-Identifier: GPL-2.0-or-later; see https://www.gnu.org/licenses/gpl-3.0.html",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "Ubuntu mit Lizenz, mit viel Text und ohne alles",
    "the LGPL license, the agpl license and gnu gpl v3",
    "under the mıt license; under the MİT license; under theKmit license",
    "Kelvin K licence ouverte ſ licenſe",
    "public domain work " * 40,
    "x" * 5000 + " cc0 1.0 universal " + "y " * 3000 + "cc by nc",
    "" ,
    None,
    " \n\t--- ",
]


def test_texts_equal_plain_loops(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert rows_of(licenses.scan(docs)) == {k: plain(x, rules()) for k, x in enumerate(TEXTS)}


def test_suppression_by_strength_length_and_order(spark):
    made = [("long", 2, "b c d e"), ("weak", 4, "b c d e f"), ("inner", 3, "c d"), ("strong", 1, "c d"), ("same", 2, "b c d e"), ("across", 2, "d e f")]
    listed = [Rule(k, label, p, "b", "b", f" {x.replace(' ', '  ')} ") for k, (label, p, x) in enumerate(made)]
    listed = [r._replace(needle="d") for r in listed]
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    got = rows_of(licenses.scan(docs, listed))[1]
    assert got == plain("a b c d e f g", listed) and got[5] == "across,long,strong,weak"


def test_rules_are_many_and_each_has_a_needle():
    got = rules()
    assert len(got) > 200 and [r.rule for r in got] == list(range(len(got)))
    assert all(len(r.needle) >= 3 for r in got)


@pytest.mark.parametrize("pattern, needle", [(" ab  (?:cd  )?licen[cs]e ", "  licen"), (" a{1,2}bcd ", "bcd "), (" (?:x|y)  abc(?:  d)? ", "  abc"), (" abcs?de ", " abc")])
def test_needles(pattern, needle):
    assert license_rules._needle(pattern) == needle


def test_odd_rows(spark, messy, tmp_path):
    got = licenses.op12_license_scan(spark, write_tables(tmp_path, documents=messy))
    want = sorted(((x.doc_id, *plain(x.text, rules())) for x in messy.collect()), key=str)
    assert sorted((tuple(x[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) for x in got.collect()), key=str) == want


def test_many_matches_in_a_long_text(spark):
    text = "released under the mit license and " * 30_000
    got = rows_of(licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    assert got[1][:4] == (180_000, 30_000, 1, 6 * 29_999 + 1)


def test_empty_table(spark, empty):
    assert licenses.scan(empty).collect() == []
