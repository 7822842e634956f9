from __future__ import annotations

import fnmatch
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import write_tables
from pyspark.sql import functions as F

from docmill.llm import line_dedup, mixing, pseudonyms, top_k, url_filter


# --- mixing


def test_mixing_meets_weights_and_poisson(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("small").alias("source"), F.lit("t").alias("text"))
    weights = spark.createDataFrame([("big", 1.0), ("mid", 1.0), ("small", 2.0), ("none", 1.0)], "source string, weight double")
    rows = mixing.mix(docs, weights, seed=3).collect()
    share = Counter(r.source for r in rows)
    assert abs(share["big"] / 1500 - 1) < 0.1 and abs(share["small"] / 3000 - 1) < 0.1
    per = Counter(Counter(r.doc_id for r in rows if r.source == "small").values())
    n, lam = 600, 5.0
    assert all(abs(per[k] - n * math.exp(-lam) * lam**k / math.factorial(k)) < 5 * math.sqrt(n * 0.18) for k in range(1, 10))
    assert all(r.copy <= r.n_copies for r in rows) and len({(r.doc_id, r.copy) for r in rows}) == len(rows)
    again = mixing.mix(docs.repartition(7), weights, seed=3).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert Counter(map(tuple, mixing.mix(docs, weights, seed=4).collect())) != Counter(map(tuple, rows))


def test_mixing_joins_where_sources_are_many(spark, monkeypatch):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 9).cast("string").alias("source"))
    a = mixing.mix(docs, mixing.tempered(docs)).collect()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert Counter(map(tuple, mixing.mix(docs, mixing.tempered(docs)).collect())) == Counter(map(tuple, a))


def test_mixing_edges(spark, messy, empty):
    clash = messy.withColumnRenamed("score", "copy")
    out = mixing.mix(clash, mixing.tempered(clash), total=50.0)
    assert out.columns[: len(clash.columns)] == clash.columns and "_copy" in out.columns
    rows = out.collect()
    assert all(r["copy"] == "x" and r["_copy"] >= 1 for r in rows) and any(r.source is None for r in rows)
    assert mixing.mix(empty, mixing.tempered(empty)).collect() == []


def test_large_rates_are_sums(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    n = [r.n_copies for r in mixing.mix(docs, mixing.tempered(docs), total=300 * 1300.0).where("copy = 1").collect()]
    assert len(n) == 300 and abs(sum(n) / 300 - 1300) < 5 * (1300 / 300) ** 0.5 and 0.75 < np.var(n) / 1300 < 1.3


def test_clashing_names_stay(spark):
    taken = ("_u", "u", "rate", "n_copies", "copy", "shuffle_key", "mixed_source", "parts", "cdf", "who", "mean")
    docs = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("string").alias("source"), *[F.lit(f"own {c}").alias(c) for c in taken])
    rows = mixing.mix(docs, mixing.tempered(docs)).collect()
    assert all(r[c] == f"own {c}" for r in rows for c in taken) and all(1 <= r["_copy"] <= r["_n_copies"] for r in rows)


def test_rows_without_an_id_are_dealt_by_text(spark):
    docs = spark.range(400).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    mixed = mixing.mix(docs, mixing.tempered(docs))
    rows = mixed.collect()
    assert len({r.n_copies for r in rows}) > 2 and len({r.shuffle_key for r in rows}) == len(rows) and 300 < len(rows) < 500


# --- line dedup


def brute_lines(rows):
    first, out = {}, []
    for i, t in rows:
        lines = t.split("\n")
        full = [k for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        gone = set()
        for a, b, c in zip(full, full[1:], full[2:], strict=False):
            if first.setdefault((lines[a], lines[b], lines[c]), (i, a)) != (i, a):
                gone |= {a, b, c}
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c d", "", " ", "e"]) for _ in range(rng.randint(0, 12)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in line_dedup.dedup_lines(docs).select("doc_id", "text", "n_removed").collect()) == brute_lines(rows)


def test_line_dedup_edges(spark, messy, empty):
    clash = messy.withColumnRenamed("score", "lines")
    rows = line_dedup.dedup_lines(clash).collect()
    assert len(rows) == 9 and {r.lines for r in rows} == {"x"}
    by = {r.doc_id: r for r in rows}
    assert by[1].text is None and by[2].text == "" and by[3].text == "  \n\n "
    assert by[6].n_removed == 0 and by[7].text == "else" and by[7].n_removed == 3
    assert line_dedup.dedup_lines(empty).collect() == []


# --- top-k


def brute_top(rows, k=10):
    v = {}
    fine = [(i, [math.floor(1024 * float(x)) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    for i, q in fine:
        if i % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, e, strict=False)), j) for j, e in fine if j != i)[:k]
            v[i] = [(j, -s) for s, j in scores]
    return v


@pytest.mark.parametrize("cell", [16384, 64])
def test_top_k_equals_brute_force(spark, tmp_path, monkeypatch, cell):
    monkeypatch.setattr(top_k, "CELL", cell)
    monkeypatch.setattr(top_k, "ROWS", 32)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.2, 40).tolist()) for i in range(400)]
    rows += [(400 + i, rows[100][1]) for i in range(30)]  # ties
    rows += [(500, None), (501, [None] * 40), (502, [float("nan")] * 40), (600, [float("inf")] * 40), (None, [1.0] * 40), (700, []), (701, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int")
    sf = write_tables(tmp_path / f"t{cell}", embeddings=df)
    got = {}
    for r in sorted(top_k.op6_exact_top_k(spark, sf).collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute_top(rows)


@pytest.mark.parametrize("size", [1e5, 2e6, 1e9, 1e30, 1e300])
def test_top_k_is_exact_for_large_components(spark, tmp_path, size):
    """Scores that differ by one unit in the last place, of both signs, with ties; those beyond a long are null but ranked."""
    rng = np.random.default_rng(11)
    rows = [(i, (rng.choice([-1, 1], 36) * size * (1 + rng.integers(0, 3, 36) / 1024)).tolist()) for i in range(120)]
    rows += [(120 + i, [size] * 35 + [size + d / 1024]) for i, d in enumerate((1, 2, 3, 2, 1, 0))] + [(200, [size] * 36), (201, [1.0 / 1024] * 36), (202, [-size] * 36)]
    want = brute_top(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(top_k.op6_exact_top_k(spark, write_tables(tmp_path / "t", embeddings=df)).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: [(i, s if -(2**63) <= s < 2**63 else None) for i, s in best] for q, best in want.items()}


def test_repeated_query_ids_get_their_own(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), *((i, [float(i), 20.0 - i]) for i in range(1, 15))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.rank, r.vec_id) for r in top_k.op6_exact_top_k(spark, write_tables(tmp_path / "t", embeddings=df)).collect() if r.query_id == 0)
    assert got == sorted([(k + 1, 14 - k) for k in range(10)] + [(k + 1, k + 1) for k in range(10)])


def test_top_k_of_few_rows(spark, tmp_path):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_k.op6_exact_top_k(spark, write_tables(tmp_path / "a", embeddings=df)).collect()] == [(0, 1, 1, 2048 * 1024)]
    assert top_k.op6_exact_top_k(spark, write_tables(tmp_path / "b", embeddings=df.limit(0))).collect() == []


# --- URL filter


def test_automaton_equals_globs():
    rng = random.Random(9)
    patterns = ["".join(rng.choice("ab*/") for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["*", "", "a" * 70]
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["a" * 70, "é"]
    got = url_filter.Automaton(patterns).matches([t.encode() for t in texts])
    assert got.tolist() == [[fnmatch.fnmatchcase(t, p) for p in patterns] for t in texts]


def test_host_wildcard_stays_in_the_host():
    a = url_filter.Automaton(["@.com/*"])
    assert a.matches([b"x.y.com/z", b"x/y.com/z", b"x?y.com/z", b".com/", b"x.com"])[:, 0].tolist() == [True, False, False, True, False]


def test_url_verdicts(spark):
    cases = {
        "http://X.com/a": ("x.com", "/a", "com/", "allow"),
        "https://blog.example.com/en/1?q": ("blog.example.com", "/en/1", "example.com/en/", "block"),
        "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
        "http://x.net/es/1#f": ("x.net", "/es/1", "net/es/", "block"),
        "http://x.net/es": ("x.net", "/es", None, "allow"),
        "http://spam-farm.org": ("spam-farm.org", "", None, "block"),
        "http://x.org?u=casino": ("x.org", "", None, "block"),
        "http://x.org/a.exe": ("x.org", "/a.exe", None, "block"),
        "nothing": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://com/x": ("com", "/x", "com/", "allow"),
        "http://x.org/" + "a" * 20_000: ("x.org", "/" + "a" * 20_000, None, "allow"),
    }
    pages = spark.createDataFrame([(u, "x") for u in cases], "url string, rule string")
    got = {r.url: (r.host, r.path, r["_rule"], r.verdict) for r in url_filter.judge(pages).collect()}
    assert got == cases and url_filter.judge(pages).first().rule == "x"
    assert url_filter.judge(pages.limit(0)).collect() == []


# --- pseudonyms


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(d[0::2]) % 10 + sum((2 * x) // 10 + (2 * x) % 10 for x in d[1::2]) % 10


def rewrite(spark, texts, key="k"):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.n_private) for r in pseudonyms.pseudonymize(d, key).orderBy("doc_id").collect()]


def test_pseudonyms_keep_format_and_link(spark):
    texts = ["card 4111 1111 1111 1111.", "4111111111111111 again", "mail ana.34@mail7.example.com!!", "+1 (017) 555-7713", "ip 10.0.255.1.", "on 2024-02-29, 31/12/1999", 'token = "44d44c79e8bf7c55759c4958dd60ed83d2ef8cd4"']
    got = rewrite(spark, texts)
    assert all(a != b and len(a) == len(b) or "ip" in b for (a, _), b in zip(got, texts, strict=True))
    card, bare = re.sub(r"\D", "", got[0][0]), re.sub(r"\D", "", got[1][0])
    assert card == bare and luhn(card) % 10 == 0
    shape = lambda s: re.sub("[a-z]", "a", re.sub(r"\d", "9", s))
    assert shape(got[2][0]) == shape(texts[2]) and got[2][0].endswith("@mail7.example.com!!")
    assert got[3][0].startswith("+1 (") and shape(got[3][0]) == shape(texts[3])
    assert all(0 <= int(x) <= 255 for x in re.findall(r"\d+", got[4][0]))
    import datetime

    iso, dmy = re.search(r"on (\S+), (\S+)", got[5][0]).groups()
    assert datetime.date.fromisoformat(iso) and datetime.datetime.strptime(dmy, "%d/%m/%Y") and got[5][1] == 2
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[6][0])
    assert rewrite(spark, texts, "other") != got


def test_clean_texts_stay(spark):
    texts = [None, "", "version 2.0 of 12 things, 1.2.3.4.5 and 999.1.1.1 at 12:30", "a@b x@ @y", "2023-02-30 or 45/13/2020", "12345 67890", "x" * 300_000, "deadbeef 0123", "+12 items"]
    got = rewrite(spark, texts)
    assert [t for t, _ in got] == texts


def test_pseudonyms_are_permutations(spark):
    numbers = [f"{n:013d}" for n in range(0, 4000)]
    days = [f"{y}-{m:02d}-{d:02d}" for y in range(1990, 1994) for m in range(1, 13) for d in range(1, 29)]
    mails = [f"{a}{b}{n}@x.org" for a in "abcdefghij" for b in "klmnop" for n in range(10)]
    ips = [f"{a}.{b}.0.{c}" for a in range(10) for b in range(10) for c in range(10)]
    for values in (numbers, days, mails, ips):
        out = [t for t, n in rewrite(spark, values)]
        assert len(set(out)) == len(set(values)) and sum(a == b for a, b in zip(out, values, strict=True)) < 5
    valid = [n for n in numbers if luhn(n) % 10 == 0]
    assert all(luhn(t) % 10 == 0 for t, _ in rewrite(spark, valid))


def test_feistel_equals_brute_force(spark):
    import hashlib

    def word(key, tag, r, other):
        return int(hashlib.sha256(f"{key}:{tag}:{r}:{other}".encode()).hexdigest()[:15], 16)

    day = 81_000
    a, b = divmod(day, pseudonyms.DAYS_RIGHT)
    for r in range(pseudonyms.ROUNDS):
        if r % 2 == 0:
            a = (a + word("k", "date", r, b)) % pseudonyms.DAYS_LEFT
        else:
            b = (b + word("k", "date", r, a)) % pseudonyms.DAYS_RIGHT
    import datetime

    origin = datetime.date(1800, 1, 1)
    given, want = origin + datetime.timedelta(day), origin + datetime.timedelta(a * pseudonyms.DAYS_RIGHT + b)
    assert rewrite(spark, [str(given)])[0][0] == str(want)


def test_pseudonym_edges(spark, messy, empty):
    clash = messy.withColumnRenamed("score", "found")
    rows = pseudonyms.pseudonymize(clash, "k").collect()
    assert len(rows) == 9 and {r.found for r in rows} == {"x"} and all(r.n_private == 0 for r in rows)
    assert pseudonyms.pseudonymize(empty, "k").collect() == []
