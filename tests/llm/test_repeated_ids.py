"""Rows that share a doc_id, in the near-duplicate join."""

from __future__ import annotations

import pytest

from docmill.llm import set_join

BASE = [f"w{k}" for k in range(200)]
A, B, OTHER = " ".join(BASE), " ".join([*BASE[:199], "x"]), " ".join(f"o{k}" for k in range(50))


def by_pairs(rows):
    """(doc_id, class_id, links) of each row, by comparing all pairs of rows."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().encode().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    n = len(rows)
    linked = [[i != j and bool(sets[i]) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        for i in range(n):
            label[i] = min(label[j] for j in range(n) if i == j or linked[i][j])
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        out.append((rows[i][0], min(ids, default=None), sum(linked[i])))
    return sorted(out, key=str)


@pytest.mark.parametrize(
    "rows",
    [
        [(1, A), (1, A), (2, B)],
        [(1, A), (1, OTHER), (2, B)],
        [(1, A), (1, A.upper()), (1, OTHER), (2, B)],
        [(None, A), (3, B), (None, A), (None, OTHER), (3, OTHER), (None, None), (None, ""), (4, None)],
        [(None, A), (None, B), (5, "a b"), (5, "A  b"), (6, "a")],
    ],
)
def test_every_row_counts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = set_join.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == by_pairs(rows)
    assert all(r.is_representative == (r.class_id == r.doc_id) for r in got)


def test_no_other_text_is_dropped(spark):
    rows = [(1, A, "p"), (1, A, "q"), (1, OTHER, "r"), (2, B, "s"), (None, B, "t"), (None, None, "u"), (None, None, "v"), (9, "", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = set_join.keep_representatives(docs)
    assert kept.columns == ["doc_id", "text", "row"]
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, A), (1, OTHER), (None, None), (None, None), (9, "")], key=str)


def test_smallest_hash_represents(spark):
    texts = [f"{k} {OTHER[k:]}" for k in range(40)]
    docs = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string").repartition(7)
    want = docs.selectExpr("min_by(text, xxhash64(text)) AS t").first().t
    assert [r.text for r in set_join.keep_representatives(docs).collect()] == [want]
