"""Quality rules: gradient-boosted trees over document statistics.

A fixed base rule rejects very short and very repetitive texts. The rest is judged by boosted trees
that are trained with monotonic constraints on a bounded sample of labelled rows, flattened into numpy
node arrays, and sent to the tasks as a few kilobytes. Scoring is one pass without a shuffle.

Null and empty texts have no words: every statistic is 0, base_failed is true and kept false. Repeated
rows are judged one by one, and get equal verdicts for equal texts. Without usable labels (none, or of
one class only) the base rule alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.common import fresh, slices, table

#: At most so many labelled rows are learned from: those with the smallest hash of their id.
TRAIN_ROWS = 4000
#: Bytes of texts that a worker looks at together.
BATCH = 4 << 20
#: Words that a text may have for three of their numbers to fit one code.
NARROW = 1 << 21
SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Feature names, and the sign by which each may move the score (0: free).
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "bangs_per_word": -1,
    "distinct_share": 0,
    "words_per_line": 0,
    "digit_share": 0,
}


class WordIds(dict):
    """Word to small int, in order of arrival."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def repeat_words(words: list[bytes], ids: WordIds) -> tuple[int, int]:
    """Words in 3-word windows that are found twice or more, and the number of distinct words."""
    n = len(words)
    if len(ids) > 400_000:
        ids.clear()
    got = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    distinct = len(np.unique(got)) if n else 0
    if n < 3:
        return 0, distinct
    if len(ids) < NARROW:
        codes = got[:-2] << 42 | got[1:-1] << 21 | got[2:]
    else:  # one text with millions of distinct words: rank the pairs first
        pairs = np.unique(got[:-1] << 32 | got[1:], return_inverse=True)[1].reshape(-1)
        codes = pairs[:-1] << 32 | got[2:]
    ordered = np.sort(codes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0, distinct
    at = np.isin(codes, np.unique(twice))
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= at
    return int(covered.sum()), distinct


def statistics(texts: list[str | None], ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """COUNTS (int64) and FEATURES (float64) of each text; null counts as empty."""
    counts = np.zeros((len(texts), len(COUNTS)), np.int64)
    values = np.zeros((len(texts), len(FEATURES)), np.float64)
    for i, text in enumerate(texts):
        if not text:
            continue
        data = text.encode("utf-8", "surrogatepass")
        words = data.split()  # on exactly the six ASCII white-space bytes
        n = len(words)
        if not n:
            continue
        chars = len(text) - (len(data) - len(data.translate(None, SPACE)))
        symbols = len(data) - len(data.translate(None, SYMBOLS))
        lines = [x for x in data.split(b"\n") if x.strip(SPACE)]
        dup = len(lines) - len(set(lines))
        repeats, distinct = repeat_words(words, ids)
        upper = len(text) - len(text.translate(_NO_UPPER))
        digits = len(data) - len(data.translate(None, b"0123456789"))
        counts[i] = n, chars, symbols, dup, repeats
        values[i] = np.log1p(n), chars / n, symbols / n, dup / len(lines), repeats / n, upper / chars, data.count(b"!") / n, distinct / n, n / len(lines), digits / chars
    return counts, values


#: Deletes Latin capital letters (a fixed range rule: A to Z, and U+00C0 to U+00DE without the sign U+00D7).
_NO_UPPER = dict.fromkeys([*range(65, 91), *(c for c in range(0xC0, 0xDF) if c != 0xD7)])


@dataclass
class Forest:
    """Flattened trees. A leaf points to itself, so that walking on changes nothing."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of x; all trees of all rows walk down together."""
        if not len(x):
            return np.zeros(0)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def train(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 50, depth: int = 4, rate: float = 0.2, bins: int = 48, ridge: float = 2.0, least: float = 3.0) -> Forest:
    """Newton boosting of the logistic loss on quantile bins.

    Where a sign is not 0, a split is taken only if its children's values stand in that order, and the
    midpoint bounds everything below either child, so each tree is monotonic in that feature.
    """
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)], axis=1)
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate0 / (1 - rate0)))
    margin = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        k = len(feature)
        for column, v in ((feature, 0), (threshold, np.inf), (left, k), (right, k), (value, 0.0)):
            column.append(v)
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        step = np.zeros(n)
        roots.append(node())
        todo = [(roots[-1], np.arange(n), 0, -np.inf, np.inf)]
        while todo:
            k, rows, level, low, high = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            own = float(np.clip(-g / (h + ridge), low, high))
            best = None
            if level < depth and len(rows) >= 10:
                for j in range(d):
                    if not len(edges[j]):
                        continue
                    b = binned[rows, j]
                    size = len(edges[j]) + 1
                    gl = np.cumsum(np.bincount(b, grad[rows], size))[:-1]
                    hl = np.cumsum(np.bincount(b, hess[rows], size))[:-1]
                    gr, hr = g - gl, h - hl
                    vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
                    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g**2 / (h + ridge)
                    ok = (hl > least * 0.05) & (hr > least * 0.05)
                    if signs[j]:
                        ok &= (vr - vl) * signs[j] >= 0
                    gain = np.where(ok, gain, -np.inf)
                    c = int(gain.argmax())
                    if gain[c] > 1e-6 and (best is None or gain[c] > best[0] + 1e-12):
                        best = (gain[c], j, c, float(vl[c]), float(vr[c]))
            if best is None:
                value[k] = rate * own
                step[rows] = value[k]
                continue
            _, j, c, vl, vr = best
            go = binned[rows, j] <= c
            lo, hi, mid = [low, low], [high, high], (vl + vr) / 2
            if signs[j]:
                (hi if signs[j] > 0 else lo)[0] = mid
                (lo if signs[j] > 0 else hi)[1] = mid
            feature[k], threshold[k] = j, float(edges[j][c])
            left[k], right[k] = node(), node()
            todo += [(left[k], rows[go], level + 1, lo[0], hi[0]), (right[k], rows[~go], level + 1, lo[1], hi[1])]
        margin += step
    return Forest(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), base, depth)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Forest | None:
    """Trees from at most train_rows labelled documents; None if there are not both classes.

    The rows are those with the smallest hash of their id, so the choice follows neither order nor
    partitioning. Rows without an id or a label teach nothing; the larger of several labels counts.
    """
    chosen = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for b in batches:
            _, x = statistics(b.column(2).to_pylist(), ids)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    # chosen has train_rows rows at most: a broadcast of known size
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", F.col("y").cast("int"), "text")
    got = sorted((r.doc_id, r.y, tuple(r.x)) for r in picked.mapInArrow(rows, schema).collect())
    y = np.array([r[1] for r in got], float)
    if len(y) < 20 or y.min() == y.max():
        return None
    return train(np.array([r[2] for r in got]), y, list(FEATURES.values()))


def judge(docs: DataFrame, forest: Forest | None, least: float = 0.5, keep_only: bool = False) -> DataFrame:
    """docs with COUNTS, base_failed, score and kept; or, with keep_only, the kept rows as they were.

    A column of docs that has one of the new names is left as it is, and the new one gets a leading
    underscore. score is null where the base rule or missing trees left nothing to ask.
    """
    named = dict(zip([*COUNTS, "base_failed", "score", "kept"], fresh(docs, *COUNTS, "base_failed", "score", "kept"), strict=True))
    kinds = [T.LongType()] * len(COUNTS) + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    schema = docs.schema if keep_only else T.StructType([*docs.schema.fields, *(T.StructField(c, k) for c, k in zip(named.values(), kinds, strict=True))])
    at = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for b in slices(batches, at, BATCH):
            counts, x = statistics(b.column(at).to_pylist(), ids)
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            score = np.full(len(x), np.nan) if forest is None else forest.score(x)
            kept = ~failed & ((score >= least) if forest is not None else True)
            if keep_only:
                yield b.filter(pa.array(kept))
                continue
            new = [pa.array(counts[:, k]) for k in range(len(COUNTS))]
            new += [pa.array(failed), pa.array(score, mask=np.isnan(score) | failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *named.values()])

    return docs.mapInArrow(rows, schema)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    forest = fit(docs, table(spark, sf_dir, "labels"))
    out = judge(docs.select("doc_id", "text"), forest)
    return out.drop("text")
