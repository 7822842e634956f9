"""Importance resampling: against a plain loop, and odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import write_tables

from docmill.llm import resampling as r

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def plain_features(text: str | None) -> list[bytes]:
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return words + [a + b" " + b for a, b in zip(words, words[1:], strict=False)]


def plain(docs: list[tuple], target: list[str], percent: int = 25) -> list[tuple]:
    counts = lambda texts: Counter(zlib.crc32(f) % 10_000 for x in texts for f in plain_features(x))
    s, t = counts(x for _, x in docs), counts(target)
    big, small = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big + 10_000) / ((s[b] + 1) * (small + 10_000))))
    rows = []
    for doc, text in docs:
        f = plain_features(text)
        weight = sum(gain(zlib.crc32(x) % 10_000) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in rows if (x[1] + 1) // 2 >= 20), key=lambda x: (-x[3], x[0] is not None, x[0]))
    drawn = len(able) * percent // 100
    return sorted([(*x, k + 1 if k < drawn else None) for k, x in enumerate(able)] + [(*x, None) for x in rows if (x[1] + 1) // 2 < 20], key=str)


def rows_of(df) -> list[tuple]:
    return sorted([(x.doc_id, x.n_features, x.weight, x.score, x["rank"]) for x in df.collect()], key=str)


def test_query_equals_plain_loop(spark):
    docs = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [x.text for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows_of(r.op13_importance_resampling(spark, SF)) == plain(docs, target)


def test_odd_rows(spark, messy, tmp_path):
    target = spark.createDataFrame([("one two three",), (None,)], "text string")
    got = rows_of(r.op13_importance_resampling(spark, write_tables(tmp_path, documents=messy, benchmark=target)))
    assert got == plain([(x.doc_id, x.text) for x in messy.collect()], ["one two three", None])


def test_repeated_rows_are_drawn_one_by_one(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(3, text)] * 8 + [(4, "short")], "doc_id long, text string")
    assert sorted((x.doc_id, x["rank"] or 0) for x in r.resample(docs, docs.limit(0)).collect()) == [(3, 0)] * 6 + [(3, 1), (3, 2), (4, 0)]


def test_empty_table(spark, empty):
    assert r.resample(empty, empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=300), min_size=1, max_size=40))
def test_matrices_hold_crc32(words):
    data = np.frombuffer(b"".join(words), np.uint8)
    n = np.array([len(w) for w in words])
    start = np.cumsum(n) - n
    follow = np.roll(np.arange(len(n)), 1)
    got = r.crcs(data, start, n, start[follow], n[follow])
    assert got.tolist() == [zlib.crc32(w + words[f]) for w, f in zip(words, follow, strict=True)]


@pytest.mark.parametrize("piece", [8, 40, 1000])
def test_long_texts_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(r, "PIECE", piece)
    texts = [b"Some words that go ON and on, some words.", b"", None, b"x" * 50 + b" some words", "ñandú são".encode()]
    want = [Counter(zlib.crc32(f) % 99 for f in plain_features((x or b"").decode())) for x in texts]
    got = [Counter() for _ in texts]
    for p in r.pieces(texts):
        doc, words, doc2, pairs = r.features(p, 99)
        for k, b in [*zip(doc, words, strict=True), *zip(doc2, pairs, strict=True)]:
            got[k][int(b)] += 1
    assert got == want
