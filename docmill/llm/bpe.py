"""BPE encoding and decoding.

Merges run over a doubly linked symbol list with a priority queue of merge ranks; entries that a merge
made stale are skipped when they surface. Decoding joins the vocabulary's strings. Text preparation
follows the file's own steps (NFC, white space, lower case, split, byte letters); words repeat, so each
worker keeps the codes of short ones it has met, up to a number of bytes, and gives out rows by bytes too.

Null and empty texts have no codes: n_tokens 0, and the digests of empty strings. Texts are encoded
whole, one by one; repeated rows give equal rows, and there is no shuffle. Characters of which Python's Unicode tables
say other than the tokenizers library's (most of them newer than either) are cut and lower-cased by the library.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from tokenizers import Tokenizer

from docmill.llm.common import fresh, slices, table
from docmill.llm.memo import Memo

#: Bytes that a worker keeps, in either generation, for chunks between white space, and for words.
CHUNKS, WORDS = 32 << 20, 32 << 20
#: Characters of text after which a worker hands on what it has made.
BATCH = 4 << 20
#: Unicode's White_Space, which differs from what str.split takes by U+001C to U+001F.
SPACE = "\t-\r \x85\xa0  -     　"
SPACES = re.compile(f"[{SPACE}]+")
#: Symbols from which on a list of merge() is an array, which takes a fourth of the memory.
LONG = 1 << 14
ODD = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable stand-in for each byte: itself where it prints in Latin-1, else a letter from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


#: For each symbol, the symbols that may follow it: the rank of their merge, 32 bits to the left, and the merged symbol.
Followers = list[dict[int, tuple[int, int]]]


def followers(size: int, merges: list[tuple[int, int, int]]) -> Followers:
    """Of merges (left, right, merged symbol) in order of rank, over symbols below size."""
    none: dict = {}
    out = [none] * size
    for rank, (a, b, merged) in enumerate(merges):
        if out[a] is none:
            out[a] = {}
        out[a][b] = rank << 32, merged
    return out


def merge(ids: list[int], after: Followers) -> list[int]:
    """Apply merges in order of rank, then of position, until none fits.

    A queue entry holds rank and position in one int; it is stale if the symbol there is gone or no longer
    starts a pair of that rank.
    """
    n = len(ids)
    heap = [p[0] | i for i in range(n - 1) if (p := after[ids[i]].get(ids[i + 1]))]
    if not heap:
        return ids
    heapq.heapify(heap)
    push, pop = heapq.heappush, heapq.heappop
    hold = list if n < LONG else functools.partial(array, "q")
    ids, left, right = hold(ids), hold(range(-1, n - 1)), hold(range(1, n + 1))
    while heap:
        entry = pop(heap)
        i = entry & 0xFFFFFFFF
        j = right[i]
        if j >= n or ids[i] < 0:
            continue  # stale
        p = after[ids[i]].get(ids[j])
        if p is None or p[0] != entry - i:
            continue  # stale
        ids[i] = a = p[1]
        ids[j] = -1
        right[i] = k = right[j]
        if k < n:
            left[k] = i
            p = after[a].get(ids[k])
            if p:
                push(heap, p[0] | i)
        h = left[i]
        if h >= 0:
            p = after[ids[h]].get(a)
            if p:
                push(heap, p[0] | h)
    return [i for i in ids if i >= 0]


class WordBpe:
    """The steps of a tokenizer file: NFC, white space, lower case, split, byte letters, BPE with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.after = followers(max(self.vocab.values()) + 1, [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in merges])
        letters, end = byte_letters(), model["end_of_word_suffix"] or ""
        self.inner, self.last = [self.vocab[c] for c in letters], [self.vocab[c + end] for c in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        contractions = "'s|'t|'re|'ve|'m|'ll|'d"
        self.ascii = re.compile(rf"{contractions}|[a-z]+|[0-9]|[^a-z0-9]+")
        self.any = regex.compile(rf"{contractions}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
        # three sets of Unicode tables meet here: a character counts as known once Python's say of it what the library's do
        library = Tokenizer.from_file(path)
        self.library_form, self.library_split = library.normalizer, library.pre_tokenizer[0]
        self.agreed, self.odd = set(map(chr, range(128))), set()
        # memos hold codes as bytes, which take a quarter of what lists or texts of them take
        size = max(self.strings) + 1
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = [i.to_bytes(self.kind.itemsize, "little") for i in range(size)]
        self.names, self.texts = [str(i) for i in range(size)], [self.strings.get(i, "") for i in range(size)]
        self.words = Memo(self._word, WORDS)
        self.chunks = Memo(self._chunk, CHUNKS)

    def _word(self, word: str) -> bytes:
        data, code = word.encode("utf-8", "surrogatepass"), self.code
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        return b"".join([code[i] for i in merge(ids, self.after)])

    def _cut(self, chunk: str) -> list[str]:
        """The words of a chunk by Python's Unicode tables."""
        if not unicodedata.is_normalized("NFC", chunk):
            chunk = unicodedata.normalize("NFC", chunk)
        return self.any.findall("".join(c.lower() for c in chunk) if "Σ" in chunk else chunk.lower())

    def _library_cut(self, chunk: str) -> list[str]:
        """The words of a chunk by the tokenizers library's tables."""
        return [w for w, _ in self.library_split.pre_tokenize_str(self.library_form.normalize_str(chunk))]

    def _agrees(self, c: str) -> bool:
        """Whether the tables of both sides say the same of a character; one that Python doesn't know is left to the library."""
        return unicodedata.category(c) != "Cn" and all(self._cut(x) == self._library_cut(x) for x in (c, f"1{c}1", f"a{c}.", f"{c}a", f"é{c}"))

    def _plain(self, chunk: str) -> bytes:
        """Codes of a chunk without white space and special strings."""
        if chunk.isascii():
            found = self.ascii.findall(chunk.lower())
        elif self.agreed.issuperset(chunk):
            found = self._cut(chunk)
        else:
            # each character is asked about once
            for c in set(chunk) - self.agreed - self.odd:
                (self.agreed if self._agrees(c) else self.odd).add(c)
            found = self._cut(chunk) if self.agreed.issuperset(chunk) else self._library_cut(chunk)
        return self.words[found[0]] if len(found) == 1 else b"".join(map(self.words.__getitem__, found))

    def _chunk(self, chunk: str) -> bytes:
        """Codes of what stands between white space; special strings in it are their own codes, as the file says."""
        if "<" not in chunk and not ODD.search(chunk):
            return self._plain(chunk)
        out, at = [], 0
        for m in self.specials.finditer(chunk) if self.specials else ():
            out += [self._plain(part) for part in SPACES.split(chunk[at : m.start()]) if part]
            out.append(self.code[self.special[m.group()]])
            at = m.end()
        out += [self._plain(part) for part in SPACES.split(chunk[at:]) if part]
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings, joined as the file's missing decoder joins them."""
        return " ".join(map(self.texts.__getitem__, ids))

    def text(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, ids as text and decoded text of a whole text."""
        if not text:
            return 0, "", ""
        chunks = [c for c in SPACES.split(text) if c] if ODD.search(text) else text.split()
        ids = np.frombuffer(b"".join(map(self.chunks.__getitem__, chunks)), self.kind).tolist()
        return len(ids), " ".join(map(self.names.__getitem__, ids)), self.decode(ids)


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """docs with ids (decimal codes joined by one space), n_tokens and decoded.

    A column of docs that has one of these names is kept, and the new one gets a leading underscore.
    keep: columns of docs to give back (default: all); text that isn't among them never leaves the worker.
    """
    return _add(docs, path, keep, lambda got: [pa.array([g[1] for g in got], pa.string()), pa.array([g[0] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.string())], {"ids": T.StringType(), "n_tokens": T.LongType(), "decoded": T.StringType()})


def digests(docs: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns keep) with n_tokens and the digests of ids and decoded text, made where the text is encoded."""
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    return _add(docs, path, keep, lambda got: [pa.array([g[0] for g in got], pa.int64()), pa.array([sha(g[1]) for g in got], pa.string()), pa.array([sha(g[2]) for g in got], pa.string())], {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()})


def _add(docs: DataFrame, path: str | None, keep: list[str] | None, columns, kinds: dict[str, T.DataType]) -> DataFrame:
    path = path or default_path()
    kept = docs.columns if keep is None else keep
    names = fresh(docs.select(*kept), *kinds)
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(n, k) for n, k in zip(names, kinds.values(), strict=True))])
    at, own = docs.columns.index("text"), [docs.columns.index(c) for c in kept]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in slices(batches, at, BATCH):
            got = [bpe.text(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in own), *columns(got)], names=[*kept, *names])

    return docs.mapInArrow(rows, schema)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """Rows of encode() with decoded_text, made anew from the codes alone."""
    path = path or default_path()
    name = fresh(encoded, "decoded_text")[0]
    schema = T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())])
    at = encoded.columns.index(ids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in slices(batches, at, BATCH):
            texts = [bpe.decode([int(i) for i in (s or "").split()]) for s in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, name])

    return encoded.mapInArrow(rows, schema)


def op8_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document."""
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
