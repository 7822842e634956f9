from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline as pipeline  # noqa: E402

from docmill.llm import bpe, mixing, quality  # noqa: E402
from docmill.llm.common import stage  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from test_set_join import brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, f in pipeline.STAGES[:4]:
        seen.append(stage(f(spark, seen[-1], SF), name))
        assert seen[-1].columns == columns
    rows = [{r.doc_id: r.text for r in d.collect()} for d in seen]
    # quality: the base rule's texts are gone, and what stays is as it was
    assert all(rows[0][i] == t for i, t in rows[1].items())
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", t)) >= 50 for t in rows[1].values())
    forest = quality.fit(seen[0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(rows[1]) == {r.doc_id for r in quality.judge(seen[0], forest).where("kept").collect()}
    # lines: by brute force
    first, want = {}, {}
    for i, t in sorted(rows[1].items()):
        lines = t.split("\n")
        full = [k for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        gone = {k for w in zip(full, full[1:], full[2:], strict=False) if first.setdefault(tuple(lines[k] for k in w), (i, w[0])) != (i, w[0]) for k in w}
        want[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    assert rows[2] == want and all(r.n_chars == len(r.text) for r in seen[2].collect())
    # near copies: one of each class
    classes = brute(sorted(rows[2].items()))
    assert set(rows[3]) == {c for c, _ in classes.values()}
    # mixing: the rates' own counts
    counts = Counter(r.doc_id for r in seen[4].collect())
    assert counts == {r.doc_id: r.n_copies for r in mixing.mix(seen[3], mixing.tempered(seen[3])).collect()}
    last = pipeline.STAGES[4][1](spark, seen[4], SF).collect()
    own = bpe.load(bpe.default_path())
    assert len(last) == seen[4].count() and all((r.n_tokens, r.ids, r.decoded) == own.text(rows[3][r.doc_id]) for r in last)


def test_run_and_names(spark):
    assert len(pipeline.STAGES) == 5 and pipeline.ORACLE_SQL is None
    assert pipeline.run(spark, SF).count() > 100


def test_stages_take_odd_rows(spark, messy, empty, tmp_path):
    from llm_helpers import write_tables

    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    sf = write_tables(tmp_path / "t", documents=messy.drop("score"), labels=labels)
    for docs in (messy.drop("score"), empty):
        for name, f in pipeline.STAGES:
            assert f(spark, docs, sf).count() >= 0, name
