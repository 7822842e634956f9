from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from docmill.llm import set_join
from docmill.llm.components import components


def brute(rows):
    """(class, links) of each doc_id by comparing all pairs that share a shingle."""
    sets, at, links, up = {}, defaultdict(list), Counter(), {}
    for i, t in rows:
        w = (t or "").lower().encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        up[i] = i
        for s in sets[i]:
            at[s].append(i)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for e in s for j in at[e] if j < i).items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in sets}


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.class_id, r.n_links) for r in set_join.near_duplicates(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.fixture
def small_blocks(monkeypatch):
    """Nodes and families split into many blocks, as they are where groups are large."""
    for name, value in (("SMALL", 8), ("BLOCK", 16), ("EXACT", 16)):
        monkeypatch.setattr(set_join, name, value)


def test_large_groups_of_copies(spark, small_blocks):
    rng = random.Random(5)
    base, passage = [f"w{k}" for k in range(120)], [f"p{k}" for k in range(60)]
    rows = []
    for k in range(70):  # near copies, a chain of them, and other texts that share a long passage
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(120)] = f"x{rng.random()}"
        rows.append(" ".join(w))
    rows += [" ".join(base[: 120 - 4 * k]) for k in range(10)]
    rows += [" ".join(passage + [f"o{k}.{j}" for j in range(40)]) for k in range(60)]
    rows += ["short text", "Short  text", "short", "", None]
    data = list(enumerate(rows))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in set_join.near_duplicates(docs).collect()}
    assert got == brute(data)


def test_edges(spark, messy, empty):
    rows = set_join.near_duplicates(messy).collect()
    got = {(r.doc_id, r.class_id, r.n_links) for r in rows}
    # 7 shares no link with 6: one line of four differs, of seven shingles they share three
    assert got == {(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0), (6, 6, 1), (7, 7, 0), (None, None, 0)} and len(rows) == 9
    assert set_join.near_duplicates(empty).collect() == []
    kept = set_join.keep_representatives(messy)
    assert kept.columns == messy.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, None, 6, 7]))


def test_intersections():
    rng = np.random.default_rng(4)
    make = lambda n: [np.unique(rng.zipf(1.2, 80) % 500).astype(np.uint64) for _ in range(n)]
    a, b = make(40), make(30)
    want = [[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a]
    assert set_join.intersections(a, b).astype(int).tolist() == want


def test_runs_follow_recall():
    assert set_join.runs_for(0.99, 1) == 5 and set_join.runs_for(0.999, 3) > set_join.runs_for(0.9, 3)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1040)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in up if find(x) != x}
