"""Token files: static range asymmetric numeral system (rANS) over the whole corpus' frequencies.

Layout of a set of files, all written by Spark's Parquet writer below one folder:
``tables`` holds the shared frequency table (id, frequency; the sum is 2**20), ``blocks`` one row per
block. A block holds whole documents in ascending order of doc_id, is decoded by itself, and carries
what encode_block() makes: interleaved lanes, checkpoints (lane states, word position, and a checksum of the
words up to the next one, so that several readers may share a large block and each reads its part only), and
a checksum of the ids.

Documents are dealt by ranges of doc_id, so no task sees more than its share and no sort is global. Rows
with a null doc_id come first, rows of one doc_id stand in order of their text; a null text is empty. A
document always ends with END, so an empty one has one token. An empty table gives empty files.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.bpe import byte_letters
from docmill.llm.common import scratch, stage, table
from docmill.llm.memo import Memo

END = 2
BITS = 20
LANES, EVERY, BLOCK = 4096, 256, 1 << 21
LOW = np.uint64(1 << 31)
#: Bytes that a worker keeps, in either generation, for words, and for pieces between spaces.
WORDS, PIECES = 64 << 20, 176 << 20
HEAD = struct.Struct("<4sIIIQII")
MAGIC = b"rns2"
ADJACENT = re.compile(r" \s|\s ")
#: White space that is seldom in texts; the rest is a space or a line break.
SELDOM = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]


def adjacent(text: str) -> bool:
    """Whether a space stands beside other white space: ADJACENT, found by plain searches in most texts."""
    if "  " in text or " \n" in text or "\n " in text:
        return True
    for c in SELDOM:
        if c in text:
            return ADJACENT.search(text) is not None
    return False


@dataclass
class Table:
    """Frequencies that sum to 2**BITS, their running sum, and the symbol of every slot."""

    freq: np.ndarray
    cum: np.ndarray
    slots: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, freq: np.ndarray) -> Table:
        full = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint64)
        full[ids] = freq
        cum = np.concatenate([[0], np.cumsum(full)[:-1]]).astype(np.uint64)
        return cls(full, cum, np.repeat(np.arange(len(full), dtype=np.uint32), full.astype(np.int64)))


def scale(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positive counts to positive frequencies with sum 2**bits; the largest ones take up the rounding."""
    total, want = counts.sum(), 1 << bits
    if not len(counts) or len(counts) > want:
        raise ValueError(f"{len(counts)} symbols don't fit {bits} bits")
    freq = np.maximum(1, np.floor(counts / total * want)).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    over = int(freq.sum()) - want
    while over > 0:
        for k in order:
            cut = min(over, max(0, int(freq[k]) // 2))
            freq[k] -= cut
            over -= cut
            if over <= 0:
                break
    freq[order[0]] -= over
    return freq


def encode_block(ids: np.ndarray, t: Table) -> bytes:
    """One block: header, checkpoints, coded words. Token k goes to lane k mod lanes."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 64))
    steps = -(-n // lanes)
    x = np.full(lanes, LOW, np.uint64)
    shift = np.uint64(63 - BITS)
    words, sizes, marks = [], np.zeros(steps, np.int64), []
    places = ids.astype(np.intp)
    for s in range(steps - 1, -1, -1):
        seg = places[s * lanes : (s + 1) * lanes]
        f, y = t.freq[seg], x[: len(seg)]
        full = y >= (f << shift)
        out = y[full].astype(np.uint32)
        y[full] >>= np.uint64(32)
        q = y // f
        x[: len(seg)] = (q << np.uint64(BITS)) + (y - q * f) + t.cum[seg]
        words.append(out)
        sizes[s] = len(out)
        if s % EVERY == 0:
            marks.append(x.copy())
    at = np.concatenate([[0], np.cumsum(sizes)])[:-1][::EVERY].astype("<u8") if steps else np.zeros(0, "<u8")
    coded = (np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)).astype("<u4")
    sums = np.array([zlib.crc32(coded[a:b]) for a, b in zip(at.tolist(), [*at.tolist()[1:], len(coded)], strict=False)], "<u4")
    marked = at.tobytes() + sums.tobytes() + (np.concatenate(marks[::-1]) if marks else x[:0]).astype("<u8").tobytes()
    return HEAD.pack(MAGIC, lanes, EVERY, len(at), n, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(marked)) + marked + coded.tobytes()


def checkpoints(block: bytes) -> int:
    """Number of checkpoints, each of which decode_part() can start from."""
    return HEAD.unpack_from(block)[3]


def decode_part(block: bytes, t: Table, k: int) -> np.ndarray:
    """The ids from checkpoint k up to the next one, without those before; only this part's words are checked and read."""
    _, lanes, every, marks, n, _, crc = HEAD.unpack_from(block)
    body = memoryview(block)[HEAD.size :]
    head = marks * (12 + 8 * lanes)
    if zlib.crc32(body[:head]) != crc:
        raise ValueError("a block's checkpoints don't match their checksum")
    coded = body[head:]
    places = [*np.frombuffer(body, "<u8", marks).tolist(), len(coded) // 4]
    part = coded[4 * places[k] : 4 * places[k + 1]]
    if zlib.crc32(part) != int(np.frombuffer(body, "<u4", marks, marks * 8)[k]):
        raise ValueError("a part's words don't match their checksum")
    x = np.frombuffer(body, "<u8", lanes, marks * 12 + k * lanes * 8).astype(np.uint64)
    words, pos = np.frombuffer(part, "<u4").astype(np.uint64), 0
    first, last = k * every * lanes, min(n, (k + 1) * every * lanes)
    out = np.empty(last - first, np.uint32)
    mask, bits = np.uint64((1 << BITS) - 1), np.uint64(BITS)
    for a in range(first, last, lanes):
        b = min(a + lanes, last)
        y = x[: b - a]
        slot = y & mask
        sym = t.slots[slot.view(np.int64)].astype(np.intp)
        y = t.freq[sym] * (y >> bits) + slot - t.cum[sym]
        low = y < LOW
        m = int(np.count_nonzero(low))
        y[low] = (y[low] << np.uint64(32)) | words[pos : pos + m]
        pos += m
        x[: b - a] = y
        out[a - first : b - first] = sym
    return out


def decode_block(block: bytes, t: Table) -> np.ndarray:
    """All ids of a block, checked against their checksum."""
    magic, *_, n, crc, _ = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    parts = [decode_part(block, t, k) for k in range(checkpoints(block))]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    if len(ids) != n or zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("a block's ids don't match their checksum")
    return ids


class ByteBpe:
    """Ids of a byte-level tokenizer file, by the tokenizers library, which sees each distinct piece once.

    In such files a single space starts a new piece wherever other than white space surrounds it, so a text
    whose spaces all stand so is cut there. Pieces of printable Latin-1 are cut on by the file's own pattern
    and their words given to the library's model; all others, and other texts, go to the library whole. So
    does everything if the file has a normalizer, a prefix space or a pattern of its own.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = not spec.get("normalizer") and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        self.known = plain and model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        del spec, model
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        letters = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
        digits = "0-9²³¹¼-¾"
        self.cut = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^ \n{letters}{digits}]+|[ \n]+(?![^ \n])|[ \n]+")
        self.byte = {b: c for b, c in enumerate(byte_letters())}
        self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.marks = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        self.starts = {s[0] for s in self.specials}
        self.spaced = any(" " in s for s in self.specials)
        # letters stand for themselves, and none starts a special string
        self.letters, self.space = not any(c.isalpha() for c in self.starts), self.byte[ord(" ")]
        self.ends = {c for c in ".,;:!?" if c not in self.starts}
        self.model = self.lib.model
        # ids fit 16 bits in most vocabularies; a code is what one id looks like in a row of them
        self.small = np.dtype("<u2" if self.lib.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = [int(i).to_bytes(self.small.itemsize, "little") for i in range(self.lib.get_vocab_size())]
        self.words = Memo(self._word, WORDS)
        self.pieces = Memo(self._piece, PIECES)

    def _coded(self, letters: str) -> bytes:
        code = self.code
        return b"".join([code[t.id] for t in self.model.tokenize(letters)])

    def _word(self, word: str) -> bytes:
        return self._coded(word.encode().decode("latin-1").translate(self.byte))

    def _whole(self, text: str) -> bytes:
        code = self.code
        return b"".join([code[i] for i in self.lib.encode(text, add_special_tokens=False).ids])

    def _cut(self, piece: str) -> bytes:
        if piece.isascii():
            fine = piece.isprintable() or piece.replace("\n", "").isprintable()
        else:
            fine = max(piece) <= "ÿ" and piece.replace("\n", "").isprintable()
        if not fine or (not self.starts.isdisjoint(piece) and self.marks.search(piece)):
            return self._whole(piece)
        return b"".join(map(self.words.__getitem__, self.cut.findall(piece)))

    def _piece(self, piece: str) -> bytes:
        """The codes of a piece and the space before it; letters are one word, and a mark behind them another."""
        if self.letters:
            if piece.isalpha():
                if piece.isascii():
                    return self._coded(self.space + piece)
                if max(piece) <= "ÿ":
                    return self._word(f" {piece}")
            elif piece[-1:] in self.ends and piece[:-1].isalpha() and piece.isascii():
                return self.words[f" {piece[:-1]}"] + self.words[piece[-1]]
        return self._cut(f" {piece}")

    def ids(self, text: str | None) -> bytes:
        """All ids of a text, as little-endian unsigned integers of the dtype ``small``."""
        if not text:
            return b""
        if not self.known or self.spaced or adjacent(text):
            return self._whole(text)
        first, *rest = text.split(" ")
        return (self._cut(first) if first else b"") + b"".join(map(self.pieces.__getitem__, rest))


@functools.lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


ENCODED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("at", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
    ]
)
BLOCKS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("at", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("block", T.BinaryType()),
    ]
)


def batch(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    to = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(to)], schema=to)


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """Rows of ENCODED in range partitions of doc_id: each document's ids and its offset in its shard, and one row of token counts per task (with null ids)."""
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, shard, at = load(path), TaskContext.get().partitionId(), 0
        small, counts, end = bpe.small, np.zeros(0, np.int64), bpe.code[END]
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = bpe.ids(text) + end
                out.append((doc_id, shard, at, ids, None))
                at += len(ids) // small.itemsize
                if len(out) == 1000:
                    counts = summed(counts, out, small)
                    yield batch(ENCODED, out)
                    out = []
            if out:
                counts = summed(counts, out, small)
                yield batch(ENCODED, out)
        if at:
            yield batch(ENCODED, [(None, shard, at, None, counts.astype("<u8").tobytes())])

    return ordered.mapInArrow(rows, ENCODED)


def summed(counts: np.ndarray, rows: list[tuple], small: np.dtype) -> np.ndarray:
    new = np.bincount(np.frombuffer(b"".join(r[3] for r in rows), small))
    if len(new) < len(counts):
        new, counts = counts.copy(), new
    new[: len(counts)] += counts
    return new


def frequencies(encoded: DataFrame) -> DataFrame:
    """(id, n) over all documents; each task sums its count rows before any shuffle."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for c in b.column(0).to_pylist():
                one = np.frombuffer(c, "<u8").astype(np.int64)
                if len(one) > len(total):
                    total = np.concatenate([total, np.zeros(len(one) - len(total), np.int64)])
                total[: len(one)] += one
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return encoded.where("counts IS NOT NULL").select("counts").mapInArrow(rows, schema).groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, out: str, path: str | None = None) -> None:
    """Encode docs (doc_id, text) into token files below out."""
    path, spark = path or default_path(), docs.sparkSession
    encoded = stage(tokenize(docs, path), "tokens")
    # one row per id of the vocabulary at most, so the driver may hold it
    counted = sorted((r.id, r.n) for r in frequencies(encoded).collect())
    ids = np.array([i for i, _ in counted], np.int64)
    freq = scale(np.array([n for _, n in counted], np.int64)) if counted else np.zeros(0, np.int64)
    spark.createDataFrame([(int(i), int(f)) for i, f in zip(ids, freq, strict=True)], "id long, freq long").coalesce(1).write.parquet(f"{out}/tables")
    small = load(path).small

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, pending, size = Table.of(ids, freq), [], 0

        def flush() -> pa.RecordBatch:
            shard, at = pending[0][1], pending[0][2]
            sizes = [len(r[3]) // small.itemsize for r in pending]
            block = encode_block(np.frombuffer(b"".join(r[3] for r in pending), small), t)
            return batch(BLOCKS, [(shard, at, sum(sizes), [r[0] for r in pending], sizes, block)])

        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                # a block takes what follows without a gap
                if pending and (size >= BLOCK or row[1] != pending[-1][1] or row[2] != pending[0][2] + size):
                    yield flush()
                    pending, size = [], 0
                pending.append(row)
                size += len(row[3]) // small.itemsize
        if pending:
            yield flush()

    encoded.where("ids IS NOT NULL").select("doc_id", "shard", "at", "ids").mapInArrow(rows, BLOCKS).write.parquet(f"{out}/blocks")


def read(spark: SparkSession, out: str) -> DataFrame:
    """Per document of token files below out: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit integers) and ids_crc32."""
    return _read(spark, out, True)


def _read(spark: SparkSession, out: str, with_ids: bool) -> DataFrame:
    counted = sorted((r.id, r.freq) for r in spark.read.parquet(f"{out}/tables").collect())
    ids, freq = np.array([i for i, _ in counted], np.int64), np.array([f for _, f in counted], np.int64)
    blocks = spark.read.schema(BLOCKS).parquet(f"{out}/blocks")
    # one row per shard, of which there are as many as partitions
    base, so_far = {}, 0
    for r in sorted(blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()):
        base[r.shard], so_far = so_far, so_far + r.n
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()), *[T.StructField("ids", T.BinaryType())] * with_ids])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Table.of(ids, freq)
        for b in batches:
            for k in range(b.num_rows):
                shard, at, docs, sizes, block = (b.column(c)[k].as_py() for c in range(5))
                got = decode_block(block, t).astype("<u4").tobytes()
                rows, at, pos = [], at + base[shard], 0
                for doc_id, n in zip(docs, sizes, strict=True):
                    own = got[pos : pos + 4 * n]
                    rows.append((doc_id, at, n, zlib.crc32(own), own))
                    pos, at = pos + 4 * n, at + n
                yield batch(schema, rows)

    return blocks.select("shard", "at", "doc_ids", "sizes", "block").mapInArrow(rows, schema)


def op3_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write token files of all documents, read them back, and give each document's place and checksum."""
    out = scratch(spark, "token-files")
    write(table(spark, sf_dir, "documents"), out)
    return _read(spark, out, False)
