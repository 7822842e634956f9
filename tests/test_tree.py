"""Trees of landed files as a data source."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from docmill.sources import landed, tree


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "tree"
    for name, content in {"a/x.csv": b"h,i\n1,2\n", "a/bad.csv": b"\xff\xfe\x00", "b/deep/er/n.md": "ñ".encode(), "empty.txt": b"", "long.bin": b"z" * 5000, ".hidden/q": b"1", "_tmp": b"2"}.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return str(root)


def test_every_file_is_a_row(spark, folder):
    got = {r.path: r for r in tree.read(spark, folder, maxFileBytes=4000).collect()}
    assert sorted(got) == ["a/bad.csv", "a/x.csv", "b/deep/er/n.md", "empty.txt", "long.bin"]
    assert (got["a/x.csv"].text, got["b/deep/er/n.md"].text, got["empty.txt"].text) == ("h,i\n1,2\n", "ñ", "")
    assert got["a/bad.csv"].error.startswith("UnicodeDecodeError") and bytes(got["a/bad.csv"].content) == b"\xff\xfe\x00"
    assert got["long.bin"].error == "ValueError: longer than 4000 bytes" and got["long.bin"].content is None
    assert got["a/x.csv"].error is None and got["a/x.csv"].length == 8 and got["a/x.csv"].modified is not None


def test_a_file_that_goes_away_or_may_not_be_read(folder):
    reader = tree.TreeReader({"path": folder})
    (part,) = reader.partitions()
    os.remove(f"{folder}/a/x.csv")
    rows = {r["path"]: r for b in reader.read(part) for r in b.to_pylist()}
    assert "FileNotFoundError" in rows["a/x.csv"]["error"] and rows["empty.txt"]["error"] is None


def test_partitions_by_bytes():
    files = [(f"f{k:03d}", 1000, None) for k in range(100)] + [("zz-large", 10**9, None)]
    parts = tree.packed(files, 10 * (1000 + tree.OPEN_COST))
    assert [len(p.files) for p in parts] == [10] * 10 + [1] and parts[-1].files[0][0] == "zz-large"
    assert sum((p.files for p in parts), []) == sorted(files)


def test_a_filter_on_the_path_reaches_the_listing(spark, folder):
    before = spark.conf.get(tree.PUSHDOWN)
    try:
        for on in ("true", "false"):
            spark.conf.set(tree.PUSHDOWN, on)
            df = tree.read(spark, folder).where(F.col("path").startswith("a/") & F.col("path").endswith(".csv") & (F.col("length") > 5))
            assert [r.path for r in df.collect()] == ["a/x.csv"]
    finally:
        spark.conf.set(tree.PUSHDOWN, before)
    from pyspark.sql import datasource as d

    reader = tree.PushingReader({"path": folder})
    left = list(reader.pushFilters([d.StringStartsWith(("path",), "a/"), d.GreaterThan(("length",), 5), d.In(("path",), ("a/x.csv", "b"))]))
    assert [type(f) for f in left] == [d.GreaterThan]
    assert [f[0] for p in reader.partitions() for f in p.files] == ["a/x.csv"]


def test_a_bad_tab_does_not_fail_its_sheets(spark, folder):
    tabs = {r.tab: (r.ok, r.error) for r in landed.tabs(spark, folder).select("tab", "ok", "error").collect()}
    assert tabs["x"] == (True, None) and tabs["bad"][0] is False and "Unicode" in tabs["bad"][1]
    assert sorted((r.sheet, r.r, r.c, r.v) for r in landed.tree_sheets(spark, folder).collect()) == [("x", 0, 0, "h"), ("x", 0, 1, "i"), ("x", 1, 0, "1"), ("x", 1, 1, "2")]


def test_rows_become_files(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("a/b/1.md", "eins"), ("2.md", None), ("a/3.md", "x" * 100_000)], "path string, content string").repartition(3)
    tree.write(df, out)
    tree.write(df.where("path = 'a/3.md'").withColumn("content", F.lit("neu")), out)
    assert {r.path: r.text for r in tree.read(spark, out).collect()} == {"a/b/1.md": "eins", "2.md": "", "a/3.md": "neu"}
    with pytest.raises(Exception, match="leads out"):
        tree.write(df.withColumn("path", F.lit("../x")), out)


def test_an_empty_tree(spark, tmp_path):
    assert tree.read(spark, str(tmp_path)).collect() == []
