from __future__ import annotations

import hashlib
import json
import random
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from docmill.llm import bpe, token_files
from docmill.llm.common import slices
from docmill.llm.memo import Memo

ODD = ["", " ", "  a", "a ", "A<|endoftext|>b <|startoftext|> c", "don't I'LL 's\n't", "ΑΣ ΣΑΣ Σ", "a\x1cb\x1dc \x85 d\xa0e f　g", "é ́x 1234 ½²", "日本語テキスト 한국어", "👍🏽 x", "ﬁ Å Ω", "\n\n x\ny \n", "ª²x 12¼ ñ÷×", "<|ENDOFTEXT|> <|endoftext|", "\x00\x01 \x7f", "x" * 4000, "ab " * 400]


@pytest.fixture(scope="module")
def texts(spark):
    return ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


def test_word_bpe_equals_the_library(texts):
    lib, own = Tokenizer.from_file(bpe.default_path()), bpe.WordBpe(bpe.default_path())
    for t in texts:
        e = lib.encode(t, add_special_tokens=False)
        assert own.text(t) == (len(e.ids), " ".join(map(str, e.ids)), lib.decode(e.ids, skip_special_tokens=False)), t[:60]


def test_word_bpe_equals_the_library_for_every_code_point():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    texts = [f"1{c}1 a {c}." for n in range(0x20, 0x110000) if n < 0x33480 or 0xE0000 <= n < 0xE0200 for c in (chr(n),) if not 0xD800 <= n < 0xE000]
    library.no_truncation()
    library.no_padding()
    for k in range(0, len(texts), 20_000):
        some = texts[k : k + 20_000]
        assert [own.text(x)[1] for x in some] == [" ".join(map(str, e.ids)) for e in library.encode_batch(some, add_special_tokens=False)]


def test_merge_takes_ranks_then_places():
    after = bpe.followers(8, [(2, 2, 3), (1, 1, 2), (2, 1, 4)])
    assert bpe.merge([1, 1, 1, 1], after) == [3]
    assert bpe.merge([1, 1, 1], after) == [4]
    assert bpe.merge([7], after) == [7] and bpe.merge([], after) == []


def test_long_words_merge_alike(monkeypatch):
    own = bpe.WordBpe(bpe.default_path())
    words = [re.sub(r"\W|\d|_", "", t.lower())[:3000] for t in ODD if len(t) > 50] + ["thequickbrownfox" * 40]
    short = [own._word(w) for w in words]
    monkeypatch.setattr(bpe, "LONG", 2)
    assert [own._word(w) for w in words] == short


def test_word_bpe_operator(spark, messy, empty):
    rows = bpe.encode(messy).collect()
    assert len(rows) == 9 and rows[0].ids == "" and rows[0].n_tokens == 0
    again = bpe.decode(bpe.encode(messy)).collect()
    assert all(r.decoded == r.decoded_text for r in again)
    assert bpe.encode(empty).collect() == []
    d = bpe.digests(messy).collect()
    assert d[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.encode(messy, keep=["lang"]).columns == ["lang", "ids", "n_tokens", "decoded"]
    clash = bpe.encode(messy.withColumnRenamed("score", "ids"))
    assert clash.first().ids == "x" and clash.first()["_ids"] == ""


def test_memo_keeps_what_is_asked_for():
    made = []
    m = Memo(lambda k: made.append(k) or k * 2, 3 * 220)
    for k in ("a", "b", "c", "a", "d", "a", "e", "f", "a", "g"):
        assert m[k] == k * 2
    assert made.count("a") == 1 and len(m) <= 4 and len(m.old) <= 4


def held(*memos):
    """Bytes of what memos hold, objects and tables."""
    return sum(sys.getsizeof(d) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in d.items()) for m in memos for d in (m, m.old))


def test_memos_stay_below_their_bytes_on_unspaced_text(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 1 << 16)
    monkeypatch.setattr(bpe, "CHUNKS", 1 << 16)
    own, rng = bpe.WordBpe(bpe.default_path()), random.Random(2)
    for _ in range(40):
        own.text("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000)))
        own.text(" ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 30))) for _ in range(500)))
    assert 0 < held(own.words) < 2 * (1 << 16) + 20_000 and 0 < held(own.chunks) < 2 * (1 << 16) + 20_000


def test_slices_are_bounded_by_bytes():
    sizes = [3, 0, 50, 1, 1, 9, 2, None, 4]
    b = pa.RecordBatch.from_pydict({"k": list(range(9)), "t": [None if n is None else "é" * n for n in sizes]})
    got = list(slices([b, b.slice(0, 0)], 1, 20))
    assert pa.Table.from_batches(got) == pa.Table.from_batches([b])
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 20 for p in got)


def test_byte_bpe_equals_the_library(texts):
    lib, own = Tokenizer.from_file(token_files.default_path()), token_files.ByteBpe(token_files.default_path())
    for t in texts:
        assert np.frombuffer(own.ids(t), own.small).tolist() == lib.encode(t, add_special_tokens=False).ids, t[:60]


def test_other_files_go_to_the_library(tmp_path):
    spec = json.loads(open(token_files.default_path(), encoding="utf-8").read())
    for name, change in (("prefix", {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}}), ("lower", {"normalizer": {"type": "Lowercase"}})):
        path = str(tmp_path / f"{name}.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(spec | change, f)
        lib, own = Tokenizer.from_file(path), token_files.ByteBpe(path)
        for t in ODD:
            assert np.frombuffer(own.ids(t), own.small).tolist() == lib.encode(t, add_special_tokens=False).ids, t[:60]


LARGE = token_files.LANES * token_files.EVERY + 1000


@pytest.mark.parametrize("n", [0, 1, 63, 64, 5000, LARGE])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 5000).astype(np.uint16)
    counts = np.bincount(np.append(ids, [0, 4999]), minlength=5000)
    at = np.flatnonzero(counts)
    t = token_files.Table.of(at, token_files.scale(counts[at]))
    block = token_files.encode_block(ids, t)
    assert np.array_equal(token_files.decode_block(block, t), ids)
    parts = [token_files.decode_part(block, t, k) for k in range(token_files.checkpoints(block))][::-1]
    assert n == 0 or np.array_equal(np.concatenate(parts[::-1]), ids)
    if n == LARGE:
        assert len(parts) == 2 and len(block) < 1.03 * n * (-(counts[at] / counts.sum() * np.log2(counts[at] / counts.sum())).sum()) / 8 + 2 * 8 * token_files.LANES
    if n > 64:
        broken = bytearray(block)
        broken[-3] ^= 1
        with pytest.raises(ValueError):
            token_files.decode_block(bytes(broken), t)


def test_parts_are_checked_by_themselves(monkeypatch):
    monkeypatch.setattr(token_files, "LANES", 8)
    monkeypatch.setattr(token_files, "EVERY", 16)
    ids = np.random.default_rng(1).integers(0, 200, 1000).astype(np.uint16)
    t = token_files.Table.of(np.arange(200), token_files.scale(np.bincount(ids, minlength=200) + 1))
    block = token_files.encode_block(ids, t)
    n = token_files.checkpoints(block)
    parts = [token_files.decode_part(block, t, k) for k in range(n)]
    assert n == 8 and np.array_equal(np.concatenate(parts), ids)
    broken = bytearray(block)
    broken[-3] ^= 1
    seen = []
    for k in range(n):
        try:
            assert np.array_equal(token_files.decode_part(bytes(broken), t, k), parts[k])
        except ValueError:
            seen.append(k)
    assert len(seen) == 1 and seen[0] >= n - 2
    broken[token_files.HEAD.size + 40] ^= 1  # a checkpoint: every part sees that
    for k in range(n):
        with pytest.raises(ValueError):
            token_files.decode_part(bytes(broken), t, k)


def test_scale_keeps_every_symbol():
    for counts in ([1], [10**12, 1, 1], [1] * 1000, list(range(1, 50_000))):
        f = token_files.scale(np.array(counts))
        assert f.sum() == 1 << token_files.BITS and f.min() >= 1
    with pytest.raises(ValueError):
        token_files.scale(np.ones((1 << token_files.BITS) + 1))


def test_files_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    lib, at, want = Tokenizer.from_file(token_files.default_path()), 0, {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*lib.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want[r.doc_id] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.op3_rans_token_files(spark, sf).collect()} == want


def test_files_edges(spark, messy, empty, tmp_path):
    token_files.write(messy, str(tmp_path / "m"))
    rows = sorted(token_files.read(spark, str(tmp_path / "m")).collect(), key=lambda r: r.start)
    assert len(rows) == 9 and rows[0].doc_id is None and [r.doc_id for r in rows[1:]] == [1, 2, 3, 4, 5, 6, 6, 7]
    assert rows[1].n_tokens == 1 and rows[1].ids == (2).to_bytes(4, "little")
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:], strict=False))
    token_files.write(empty, str(tmp_path / "e"))
    assert token_files.read(spark, str(tmp_path / "e")).collect() == []
