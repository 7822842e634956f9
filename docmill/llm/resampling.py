"""Importance resampling towards a target: documents are drawn by how much their hashed features resemble it.

A document's features are its words and pairs of neighbouring words; CRC-32 puts each into one of a fixed
number of buckets. Bucket counts of all documents and of all target texts give each bucket a gain, the
logarithm of a ratio of smoothed shares. A document's weight is the mean gain of its features; Gumbel noise
from a hash of its id is added, and the highest scores are drawn, which samples without replacement in
proportion to the exponentials of the weights.

CRCs are worked out in matrices: the distinct features of a piece of text are grouped by their length in
bytes into two-dimensional arrays of uint8, all CRCs of a group are updated column by column, and the
buckets are scattered back to where the features stand. Texts are read twice, once for the counts and once
for the weights; what meets in one place is one number per bucket, and one row per range of scores.

Null, empty and wordless texts have no features, weight 0, and a score like any others; they are below the
least number of words and so are never drawn. A null doc_id is hashed as an empty text and stands first
among ties. Repeated rows are scored and ranked one by one. An empty table gives no rows; without target
texts T and t are 0. Texts of any length are taken in pieces that overlap by one word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm.common import slices, stage, table
from docmill.llm.quality import WordIds
from docmill.operators.ranks import numbered

#: Bytes that aren't in words become blanks, A to Z small letters; bytes from 0x80 up belong to words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: About so many bytes of text are looked at together.
PIECE = 1 << 20
#: Features of more bytes, which are seldom of one length, are summed one by one.
LONG = 200
#: Cells of a matrix at most.
CELLS = 400_000


def _steps() -> np.ndarray:
    """What one byte does to a CRC-32 (reflected polynomial 0xEDB88320)."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, out >> 1 ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


STEPS = _steps()


def crc_columns(cells: np.ndarray) -> np.ndarray:
    """CRC-32 of each column of a uint8 array of shape (bytes, features), all features at once, byte by byte."""
    state = np.full(cells.shape[1], 0xFFFFFFFF, np.uint32)
    for byte in cells:
        state = STEPS[state.astype(np.uint8) ^ byte] ^ state >> 8
    return ~state


def crcs(data: np.ndarray, first: np.ndarray, n: np.ndarray, second: np.ndarray, m: np.ndarray) -> np.ndarray:
    """CRC-32 of features: n bytes of data from first on, then m bytes from second on. Grouped by equal length."""
    length = n + m
    order = np.argsort(length, kind="stable")
    out = np.empty(len(order), np.uint32)
    ends = np.flatnonzero(np.diff(length[order], append=-1)) + 1
    at = 0
    for end in ends.tolist():
        size = int(length[order[at]])
        if size > LONG:
            for k in order[at:end].tolist():
                out[k] = zlib.crc32(data[second[k] : second[k] + m[k]], zlib.crc32(data[first[k] : first[k] + n[k]]))
            at = end
        byte = np.arange(size)[:, None]
        while at < end:
            some = order[at : min(end, at + max(1, CELLS // size))]
            cells = data[np.where(byte < n[some], first[some] + byte, second[some] - n[some] + byte)]
            out[some] = crc_columns(cells)
            at += len(some)
    return out


def runs(data: bytes) -> Iterator[tuple[list[bytes], bool]]:
    """The words of a text in runs of about PIECE bytes; each but the first begins with the last word of the one before, and says so."""
    folded, at, last = data.translate(FOLD), 0, []
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        words = folded[at:end].split()
        if words:
            yield last + words, bool(last)
            last = words[-1:]
        at = end


def pieces(texts: Iterable[bytes | None]) -> Iterator[list[tuple[int, list[bytes], bool]]]:
    """(number of the text, words, whether the first of them was counted before), about PIECE bytes at a time and one run of a text at most."""
    held, size = [], 0
    for k, text in enumerate(texts):
        for words, again in runs(text or b""):
            if held and (size >= PIECE or held[-1][0] == k):
                yield held
                held, size = [], 0
            held.append((k, words, again))
            size += sum(map(len, words))
    if held:
        yield held


def features(piece: list[tuple[int, list[bytes], bool]], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts and buckets of all words of a piece, then of all its pairs."""
    ids, sizes = WordIds(), [len(words) for _, words, _ in piece]
    word = np.fromiter(map(ids.__getitem__, chain.from_iterable(words for _, words, _ in piece)), np.int64, sum(sizes))
    doc = np.repeat([k for k, _, _ in piece], sizes)
    data = np.frombuffer(b" ".join(ids) + b" ", np.uint8)
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    start = np.cumsum(n + 1) - (n + 1)
    nothing = np.zeros(len(n), np.int64)
    of_word = crcs(data, start, n, nothing, nothing) % buckets
    new = np.ones(len(word), bool)
    new[(np.cumsum(sizes) - sizes)[[again for _, _, again in piece]]] = False
    inside = doc[1:] == doc[:-1]
    pairs, place = np.unique(word[:-1][inside] * len(ids) + word[1:][inside], return_inverse=True)
    one, two = np.divmod(pairs, len(ids))
    of_pair = crcs(data, start[one], n[one] + 1, start[two], n[two]) % buckets
    return doc[new], of_word[word[new]], doc[1:][inside], of_pair[place.reshape(-1)]


def bucket_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): features of all texts by bucket; each task adds its own up first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in slices(iter([b]), 0, PIECE):
                for piece in pieces(part.column(0).cast(pa.binary()).to_pylist()):
                    _, words, _, pairs = features(piece, buckets)
                    total += np.bincount(words, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    return docs.select("text").mapInArrow(rows, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of each bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))). As many rows as buckets come to the driver."""
    spark = docs.sparkSession
    both = bucket_counts(docs, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(bucket_counts(target, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    counts = both.unionByName(spark.range(buckets).selectExpr("id AS bucket", "0L AS s", "0L AS t")).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    got = counts.collect()
    s, t = np.zeros(buckets), np.zeros(buckets)
    for r in got:
        s[r.bucket], t[r.bucket] = r.s, r.t
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of docs."""
    buckets = len(gain)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(iter([b]), 1, PIECE):
                n_words, n, total = (np.zeros(part.num_rows, np.int64) for _ in range(3))
                for piece in pieces(part.column(1).cast(pa.binary()).to_pylist()):
                    doc, words, doc2, pairs = features(piece, buckets)
                    n_words += (own := np.bincount(doc, minlength=len(n)))
                    n += own + np.bincount(doc2, minlength=len(n))
                    # whole numbers below 2^53 for any piece, so the sums of doubles are exact
                    total += (np.bincount(doc, gain[words], len(n)) + np.bincount(doc2, gain[pairs], len(n))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words), pa.array(n), pa.array(total // np.maximum(n, 1))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, buckets: int = 10_000, seed: int = 7, least_words: int = 20) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words) of every row of docs; rank is null where a row isn't drawn.

    percent of the rows with least_words words or more are drawn, rounded down: highest scores first, ties to
    the smaller doc_id. docs and target have a column text, docs also doc_id; other columns aren't read.
    """
    weighed = weigh(docs, gains(docs, target, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = stage(weighed.withColumn("score", F.col("weight") + noise), "scores")
    eligible = scored.where(F.col("n_words") >= least_words)
    drawn = eligible.count() * percent // 100
    placed = numbered(eligible, [F.desc("score"), F.asc_nulls_first("doc_id")], "rank", keep=lambda d: stage(d, "ranks"))
    out = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark texts."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
