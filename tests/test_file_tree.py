"""A tree's state from run to run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docmill.operators import file_tree

LISTING = "id string, name string, modified string, path string, slug string, sector string, hash string, duplicate boolean, explanation string, error string, link string"
STATE = "id string, name string, modified string, path string, slug string, sector string, status string, hash string, explanation string, error string, link string, last_processed string"


def run(spark, listing, state, **more):
    now = spark.createDataFrame([(i, f"n{i}", m, p, s, "sec", h, d, "why" if d else None, e, "link") for i, m, p, s, h, d, e in listing], LISTING)
    old = spark.createDataFrame(state, STATE)
    return {r.id: r for r in file_tree.next_state(now, old, "NOW", **more).drop("mime").collect()}


def known(i, status="candidate", **more):
    row = {"id": i, "name": "old", "modified": "1", "path": "p", "slug": "s", "sector": "was", "status": status, "hash": "h", "explanation": None, "error": None, "link": "was", "last_processed": "BEFORE"} | more
    return tuple(row.values())


@pytest.mark.parametrize("status", ["candidate", "skipped (duplicate)", "deleted", "error"])
def test_what_is_unchanged_stays_whole(spark, status):
    row = run(spark, [("a", "1", "other", "s", "new", True, "boom")], [known("a", status)])["a"]
    assert row.outcome == "unchanged" and tuple(row)[:-1] == known("a", status)


def test_an_error_keeps_what_was_known(spark):
    got = run(spark, [("a", "2", "q", "t", None, False, "boom"), ("b", "2", "q", "t", None, False, "boom")], [known("a")])
    assert got["a"].outcome == "failed" and tuple(got["a"])[:-1] == known("a")
    assert tuple(got["b"]) == ("b", "nb", "2", "q", "t", None, "error", None, None, "boom", None, "NOW", "failed")


@pytest.mark.parametrize("status", ["candidate", "skipped (duplicate)", "pending-write"])
def test_the_same_text_keeps_its_status(spark, status):
    row = run(spark, [("a", "2", "q", "t", "h", True, None)], [known("a", status, explanation="x")])["a"]
    assert row.outcome == "same" and tuple(row)[:-1] == known("a", status, explanation="x", modified="2", path="q", slug="t", last_processed="NOW")


def test_force_reads_all_again(spark):
    row = run(spark, [("a", "1", "p", "s", "h", False, None)], [known("a")], force=True)["a"]
    assert tuple(row) == ("a", "na", "1", "p", "s", "sec", "candidate", "h", None, None, "link", "NOW", "processed")


def test_duplicates_and_pending_rows(spark):
    got = run(spark, [("a", "2", "q", "t", "z", True, None), ("b", "2", "q", "t", "z", None, None)], [known("a")], write=False)
    assert tuple(got["a"]) == ("a", "na", "2", "q", "t", None, "skipped (duplicate)", "z", "why", None, None, "NOW", "duplicate")
    assert got["b"].status == "pending-write"


def test_tombstones(spark):
    got = run(spark, [], [known("a"), known("b", "deleted")])
    assert tuple(got["a"]) == (*known("a", "deleted", last_processed="NOW"), "deleted")
    assert tuple(got["b"]) == (*known("b", "deleted"), "gone")


def test_rows_of_one_id_and_rows_without_one(spark):
    twice = [("a", "1", "p", "s", "x", None, None), ("a", "3", "q", "s", "y", None, None), (None, "1", "p", "s", "z", None, None), (None, "1", "p", "s", "z", None, None)]
    now = spark.createDataFrame([(i, "n", m, p, s, "sec", h, d, None, e, "l") for i, m, p, s, h, d, e in twice], LISTING)
    got = file_tree.next_state(now, spark.createDataFrame([], STATE), "NOW").collect()
    assert sorted((r.id or "", r.path, r.hash) for r in got) == [("", "p", "z"), ("", "p", "z"), ("a", "q", "y")]


def test_only_what_changed_is_read(spark):
    now = spark.createDataFrame([("a", "1", "s"), ("b", "2", "s"), ("c", "1", "t"), ("d", "1", "s")], "id string, modified string, slug string")
    old = spark.createDataFrame([known("a"), known("b"), known("c")], STATE)
    assert sorted(r.id for r in file_tree.changed(now, old).collect()) == ["b", "c", "d"]
    assert file_tree.changed(now, old, force=True).count() == 4


def test_a_hot_id_does_not_explode(spark):
    now = spark.range(2000).select(F.lit("a").alias("id"), F.col("id").cast("string").alias("modified"), F.lit("s").alias("slug"), F.lit("p").alias("path"))
    assert file_tree.next_state(now, spark.createDataFrame([known("a")], STATE), "NOW").count() == 1
