"""Versions that are published as a whole: whatever step fails, the version before it is what is read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docmill.sources.published import Conflict, Published


@pytest.fixture
def out(spark, tmp_path):
    made = Published(spark, str(tmp_path / "tables"))
    assert made.version() == 0
    made.publish({"result": spark.range(3), "state": spark.range(1)}, 0)
    return made


def test_versions_follow_each_other(spark, out):
    assert out.publish({"result": spark.range(5), "state": spark.range(2)}, 1) == 2
    assert (out.version(), out.read("result").count(), out.read("state").count(), out.read("result", 1).count()) == (2, 5, 2, 3)


@pytest.mark.parametrize("broken", ["result", "state"])
def test_a_table_that_cannot_be_written(spark, out, broken):
    bad = spark.range(4).select(F.raise_error(F.lit("boom")).alias("id"))
    tables = {"result": spark.range(9), "state": spark.range(9)} | {broken: bad}
    with pytest.raises(Exception, match="boom"):
        out.publish(tables, out.version())
    assert (out.version(), out.read("result").count(), out.read("state").count()) == (1, 3, 1)


def test_a_pointer_that_does_not_move(spark, out, monkeypatch):
    def stop(*_):
        raise OSError("no more")

    monkeypatch.setattr(out, "_point", stop)
    with pytest.raises(OSError):
        out.publish({"result": spark.range(9), "state": spark.range(9)}, 1)
    monkeypatch.undo()
    assert (out.version(), out.read("result").count()) == (1, 3)
    out.publish({"result": spark.range(7), "state": spark.range(9)}, 1)
    assert out.read("result").count() == 7


def test_two_runs_that_began_alike(spark, out):
    other = Published(spark, out.root)
    base = out.version()
    other.publish({"result": spark.range(6), "state": spark.range(6)}, base)
    with pytest.raises(Conflict):
        out.publish({"result": spark.range(9), "state": spark.range(9)}, base)
    assert (out.version(), out.read("result").count()) == (2, 6)


def test_pruning_keeps_what_counts(spark, out, tmp_path):
    for n in (4, 5):
        out.publish({"result": spark.range(n), "state": spark.range(1)}, out.version())
    with pytest.raises(Exception, match="boom"):
        out.publish({"result": spark.range(1).select(F.raise_error(F.lit("boom")))}, 3)
    out.prune(keep=2)
    assert out.versions() == [2, 3] and out.read("result").count() == 5 and out.read("result", 2).count() == 4
    assert len(list((tmp_path / "tables" / "data").iterdir())) == 2
