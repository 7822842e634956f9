from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import functions as F

from docmill.llm import quality

SF = "/root/testdata/sf0.01"


def brute(text):
    """The statistics word by word."""
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = list(zip(words, words[1:], words[2:], strict=False))
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {g for g, n in __import__("collections").Counter(grams).items() if n > 1}
    covered = {k + d for k, g in enumerate(grams) if g in twice for d in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_statistics_equal_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    texts += [None, "", "    x", "a a a a", "a b c a b c", "é\u0085ß #|<\n\nx\nx", "x\x1cy z", "😀 ok"]
    counts, values = quality.statistics(texts, quality.WordIds())
    assert [tuple(c) for c in counts.tolist()] == [brute(t) for t in texts]
    assert np.isfinite(values).all()


def test_many_distinct_words_take_the_other_way(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [[str(w).encode() for w in rng.integers(0, 12, n)] for n in (3, 4, 50, 400)]
    narrow = [quality.repeat_words(t, quality.WordIds()) for t in texts]
    monkeypatch.setattr(quality, "NARROW", 2)
    assert [quality.repeat_words(t, quality.WordIds()) for t in texts] == narrow and narrow[-1][0] > 0
    assert quality.repeat_words([b"a", b"b", b"c", b"a", b"b", b"c"], quality.WordIds())[0] == 6


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(1)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (rng.random(600) < 0.1)).astype(float)
    forest = quality.train(x, y, [-1, 1, 0], trees=20)
    grid = np.linspace(0, 1, 41)
    for a, b in itertools.product((0.1, 0.5, 0.9), repeat=2):
        assert (np.diff(forest.score(np.stack([grid, np.full(41, a), np.full(41, b)], 1))) <= 1e-12).all()
        assert (np.diff(forest.score(np.stack([np.full(41, a), grid, np.full(41, b)], 1))) >= -1e-12).all()
    # the true sign is free in the third tree set, so it must be found
    free = quality.train(x, y, [0, 0, 0], trees=20)
    assert ((free.score(x) > 0.5) == (y > 0.5)).mean() > 0.88


def test_flattened_scoring_equals_walking():
    rng = np.random.default_rng(2)
    x = rng.random((50, 3))
    f = quality.train(rng.random((300, 3)), (rng.random(300) < 0.4).astype(float), [0, 0, 0], trees=5)

    def walk(row, at):
        while f.left[at] != at:
            at = f.left[at] if row[f.feature[at]] <= f.threshold[at] else f.right[at]
        return f.value[at]

    want = [1 / (1 + np.exp(-(f.base + sum(walk(r, k) for k in f.roots)))) for r in x]
    assert np.allclose(f.score(x), want)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").dropDuplicates(["doc_id"])
    forest = quality.fit(docs, labels.where("doc_id % 3 <> 0"))
    out = quality.judge(docs, forest).join(labels.where("doc_id % 3 = 0"), "doc_id").where("NOT base_failed")
    n, right, clean_lost = out.agg(F.count("*"), F.count_if(F.col("kept") == (F.col("quality") == 1)), F.count_if(~F.col("kept") & (F.col("quality") == 1))).first()
    assert n > 50 and right / n > 0.93 and clean_lost / n < 0.05


def test_edges(spark, messy, empty, labels):
    assert quality.fit(messy, labels) is None
    rows = quality.judge(messy, None).collect()
    assert len(rows) == 9 and rows[0].score == "x" and rows[0]["_score"] is None
    assert all(r.base_failed and not r.kept for r in rows if not r.text or r.n_words < 50)
    assert quality.judge(empty, None).collect() == []
    kept = quality.judge(messy, None, keep_only=True)
    assert kept.columns == messy.columns and kept.count() == sum(r.kept for r in rows)
