from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from docmill.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_rows_are_told_apart_and_caught(spark):
    out = toxicity.op2_weak_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").dropDuplicates(["doc_id"]), "doc_id")
    rows = out.select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    own = [r for r in rows if r.held_out]
    bad, good = [r for r in own if r.toxic], [r for r in own if not r.toxic]
    assert sum(r.predicted for r in bad) / len(bad) > 0.8
    assert sum(r.predicted for r in good) / len(good) < 0.03


def test_labels_of_held_out_rows_change_nothing(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.terms == b.terms and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def planted(n: int, seed: int):
    """Hidden classes, voters of several accuracies (one nearly a copy of the first), and an annotator who errs in one of eight and abstains in a third."""
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(float)
    fires = lambda one, zero: (rng.random(n) < np.where(y == 1, one, zero)).astype(float)
    good = fires(0.8, 0.05)
    twin = np.where(rng.random(n) < 0.05, 1 - good, good)
    votes = np.stack([good, twin, fires(0.4, 0.3), fires(0.5, 0.5), *[fires(0.6, 0.1) for _ in range(8)]], axis=1)
    gold = np.where(rng.random(n) < 1 / 8, 1 - y, y)
    gold[rng.random(n) < 1 / 3] = np.nan
    return y, votes, gold


def test_label_model_finds_accuracies_and_correlations():
    y, votes, gold = planted(4000, 3)
    m = toxicity.label_model(votes, gold)
    p = m.posterior(votes, gold)
    assert abs(m.prior - 0.3) < 0.03 and abs(m.annotator[1] - 0.875) < 0.05 and abs(m.annotator[0] - 0.125) < 0.04
    assert {int(m.parent[0]), int(m.parent[1])} & {0, 1} and (m.parent[4:] < 0).sum() >= 7  # twins depend on each other, others on none
    c = m.correlation(votes, p)
    assert c[0, 1] > 0.5 and abs(c[0, 3]) < 0.1
    rate = lambda k, c: (m.rates[c, 0, k] if m.parent[k] < 0 else votes[:, k] @ np.where(c, p, 1 - p) / np.where(c, p, 1 - p).sum())
    assert abs(rate(0, 1) - 0.8) < 0.05 and abs(rate(2, 1) - 0.4) < 0.05 and abs(rate(4, 0) - 0.1) < 0.03


def test_wrong_labels_are_repaired():
    y, votes, gold = planted(4000, 4)
    p = toxicity.label_model(votes, gold).posterior(votes, gold)
    wrong, none = ~np.isnan(gold) & (gold != y), np.isnan(gold)
    assert wrong.sum() > 250 and ((p[wrong] > 0.5) == y[wrong]).mean() > 0.85
    assert ((p[none] > 0.5) == y[none]).mean() > 0.95 and ((p > 0.5) == y).mean() > 0.96


def test_posterior_equals_brute_force():
    _, votes, gold = planted(400, 5)
    m = toxicity.label_model(votes, gold)
    want = []
    for row, g in zip(votes, gold, strict=True):
        both = []
        for c in (0, 1):
            chance = m.prior if c else 1 - m.prior
            for k, v in enumerate(row):
                r = m.rates[c, int(row[m.parent[k]]) if m.parent[k] >= 0 else 0, k]
                chance *= r if v else 1 - r
            both.append(chance * (1 if np.isnan(g) else m.annotator[c] if g else 1 - m.annotator[c]))
        want.append(both[1] / sum(both))
    assert np.allclose(m.posterior(votes, gold), want)


def test_dependencies_equal_brute_force():
    from itertools import combinations, product

    _, votes, _ = planted(500, 6)
    votes, p = votes[:, :5], np.random.default_rng(1).random(500)
    info = {}
    for a, b in combinations(range(5), 2):
        info[a, b] = 0.0
        for q in (p, 1 - p):
            for x, y in product((0, 1), (0, 1)):
                joint = q[(votes[:, a] == x) & (votes[:, b] == y)].sum()
                info[a, b] += joint * np.log(joint * q.sum() / (q[votes[:, a] == x].sum() * q[votes[:, b] == y].sum()))
    up = list(range(5))
    find = lambda k: k if up[k] == k else find(up[k])
    tree = set()
    for a, b in sorted(info, key=info.get, reverse=True):
        if find(a) != find(b):
            up[find(a)] = find(b)
            if 2 * info[a, b] >= toxicity.DEPENDS:
                tree.add((a, b))
    parent = toxicity.dependencies(votes, p)
    assert {tuple(sorted((k, int(u)))) for k, u in enumerate(parent) if u >= 0} == tree and tree


def test_query_scores_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    t = toxicity.training(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    gold = {r.doc_id: r.toxic for r in labels.collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    own = [i for i in gold if i in texts and not held(i)]
    assert len(t.gold) == len(own) and not np.isnan(t.gold).any()
    for term in t.terms[:20]:  # mined where they are much more frequent in toxic rows
        a, c = (sum(term in toxicity.words(texts[i]) for i in own if gold[i] == k) for k in (1, 0))
        assert a >= 3 and (a + 0.5) * sum(gold[i] == 0 for i in own) >= toxicity.ODDS * (c + 0.5) * sum(gold[i] == 1 for i in own)
    model = toxicity.fit(docs, labels)
    for r in toxicity.op2_weak_toxicity(spark, sf).collect():
        z = model.bias + sum(model.weights[k] for w, k in model.terms.items() if w in toxicity.words(texts[r.doc_id]))
        z += sum(model.weights[len(model.terms) + k] for k, p in enumerate(toxicity.PATTERNS) if p.search(texts[r.doc_id]))
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9 and r.predicted == int(r.score >= 0.3) and r.held_out == held(r.doc_id)


def test_em_over_all_rows_equals_em_at_hand(spark):
    """Spark's sums over the counted table are those over every row that isn't held out, labelled or not."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    t = toxicity.training(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    gold = {r.doc_id: r.toxic for r in labels.collect()}
    votes = toxicity.ballots(toxicity.inputs(list(texts.values()), {w: k for k, w in enumerate(t.terms)}), len(t.terms))
    y = np.array([gold.get(i, np.nan) for i in texts], float)
    table = toxicity.vote_table(toxicity.marked(docs.select("doc_id", "text"), t.terms), labels, len(t.terms))
    assert sum(r.n for r in table.collect()) == len(texts) > (~np.isnan(y)).sum()
    tallies, m = toxicity.spread_tallies(table.cache(), votes.shape[1]), votes.shape[1]
    mine, spread = toxicity.label_model(votes, y, rounds=4), toxicity.expect(tallies, m, rounds=4)
    assert np.array_equal(mine.parent, spread.parent) and np.allclose(mine.rates, spread.rates, atol=1e-5) and abs(mine.prior - spread.prior) < 1e-5
    table.unpersist()


def test_posterior_differs_from_the_labels(spark):
    t = toxicity.training(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    p = toxicity.label_model(t.votes(), t.gold).posterior(t.votes(), t.gold)
    assert 0.002 < np.abs(p - t.gold).mean() < 0.1


def test_edges(spark, messy, empty, labels):
    assert toxicity.fit(messy, labels) is None
    rows = toxicity.score(messy, None).collect()
    assert len(rows) == 9 and rows[0].score == "x" and rows[0]["_score"] == 0.0
    c = toxicity.Classifier({"idiot": 0, "^idio": 1}, np.array([5.0, 1.0, *[0.0] * len(toxicity.PATTERNS)]), -4.0)
    got = toxicity.score(messy.drop("score"), c).collect()
    assert {r.score for r in got} and all(r.score < 0.3 for r in got)
    assert c.score(["An IDIOT!", None])[0] > 0.5
    assert toxicity.score(empty, c).collect() == []
