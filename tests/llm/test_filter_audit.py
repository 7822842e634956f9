"""The filter audit: against a plain loop, over files that arrive one after the other, and with odd rows."""

from __future__ import annotations

import re
from itertools import permutations

import pytest
from llm_helpers import write_tables

from docmill.llm import filter_audit as f

DOCS = "doc_id long, text string, source string"


def plain(docs: list[tuple], labels: list[tuple]) -> dict:
    """(part, order, step) to the seven counts, by running every order over every row."""
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    first: dict = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    rows = []
    for d, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": d is not None and d > first[text],
        }
        rows.append((source or "", {k for k, v in fails.items() if v}, d in good, d in toxic))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                redundant = sum(letter in r[1] for r in mine) - len(gone)
                out[part, "".join(order), step + 1] = [len(left), len(gone), redundant, sum(r[1] == {letter} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def told(df) -> dict:
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


LONG = " ".join(f"word{k}" for k in range(60))
ROWS = [
    (9, LONG, "a"), (4, LONG, "b"), (2, LONG, None), (2, LONG, "a"), (2, LONG, "a"), (None, LONG, "a"), (7, "SHOUT # now", "b"), (8, "SHOUT # now", "b"),
    (1, None, "a"), (3, "", "b"), (None, None, "a"), (5, "a b " * 40, "c"), (6, "a b " * 40, ""), (10, LONG + "\x0b É", "a"), (11, "ÀÉ " * 60, "a"),
]
LABELS = [(2, 1, 0), (2, 0, 1), (9, 1, None), (4, None, 1), (1, 1, 1), (None, 1, 1), (77, 1, 1)]


@pytest.fixture
def labels_table(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_files_one_after_the_other(spark, labels_table, tmp_path):
    """Ever smaller ids arrive, in one update with several batches and in later updates, and earlier holders are put back."""
    path = f"{tmp_path}/documents.parquet"
    audit = f.Audit(spark, f"{tmp_path}/audit")
    done = []
    for rows, batches in ((ROWS[:2], 1), (ROWS[2:9], 3), (ROWS[9:], 2)):
        for row in rows:
            spark.createDataFrame([row], DOCS).coalesce(1).write.mode("append").parquet(path)
        done += rows
        audit.update(path, labels_table, batches)
        assert told(f.report(audit.counters())) == plain(done, LABELS)
    assert sum(r.n for r in audit.counters().collect()) == len(ROWS)


def test_texts_share_buckets(spark, labels_table, tmp_path, monkeypatch):
    monkeypatch.setattr(f, "TEXTS", 1 << 20)
    path = f"{tmp_path}/documents.parquet"
    for k in range(3):
        spark.createDataFrame(ROWS[k::3], DOCS).coalesce(1).write.mode("append").parquet(path)
    assert told(f.report(f.Audit(spark).update(path, labels_table, 3).counters())) == plain(ROWS, LABELS)


def test_odd_rows_and_a_clashing_column(spark, messy, labels, tmp_path):
    docs = [(r.doc_id, r.text, r.source) for r in messy.collect()]
    root = write_tables(tmp_path, documents=messy.withColumn("mask", messy.doc_id), labels=labels)
    assert told(f.op11_filter_audit(spark, root)) == plain(docs, [])


def test_empty_table(spark, empty, labels, tmp_path):
    assert f.op11_filter_audit(spark, write_tables(tmp_path, documents=empty, labels=labels)).collect() == []


def test_settings_are_put_back(spark, labels_table, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(ROWS, DOCS).write.parquet(path)
    f.Audit(spark).update(path, labels_table)
    assert spark.conf.get(key, None) == before
