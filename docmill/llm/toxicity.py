"""Toxicity by weak supervision.

Many voters (one per lexicon term, and patterns) vote on every document that isn't held out, labelled or not.
The annotator is one more voter, who abstains where there is no label. A generative label model of two hidden
classes estimates by EM how often each class occurs, how often each voter (the annotator too) fires in either,
and how voters depend on each other: within a class each may depend on one other voter, by the tree of largest
conditional mutual information. EM sees a document as the list of voters that fire and the label: Spark counts
equal ones, keeps that table, and adds up each round's sums over it, so all rows count and none is drawn. The
posteriors are the labels that a linear classifier learns from, on a bounded sample of labelled rows; they differ
from the annotator's where the voters contradict an annotator as good as estimated. Scoring is one pass without
a shuffle.

The lexicon is mined from the labelled sample, the annotator's labels start EM and so name the classes; rows held
out are never read into the fit. labels, lang, source and doc_id never enter a score. Bounds, all of the fitted
model and none of the corpus: TRAIN_ROWS labelled rows, TERMS inputs of the classifier, VOTERS of them in the
label model. Null and empty texts have no votes and get the score of such a text, near the classifier's lowest.
Repeated rows get equal scores. Rows without a doc_id are scored and not learned from. Without labels of both
classes nothing can be mined: the score is then 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.common import Space, fresh, table

#: At most so many labelled rows are mined and teach the classifier: those with the smallest hash of their id.
TRAIN_ROWS = 8000
#: Of the mined terms, so many vote and so many are inputs of the classifier; each is at least ODDS times
#: as frequent in toxic rows. A term is a word, or (with a mark before it) how a longer word begins.
VOTERS, TERMS, ODDS = 300, 800, 5.0
BEGINS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")
#: Pattern voters: shouted words and repeated marks are weak signs in either direction.
PATTERNS = (
    re.compile(r"!{2,}"),
    re.compile(r"\?{2,}"),
    re.compile(r"(?:\b[A-Z]{3,}\b\W+){3}"),
    re.compile(r"(?i)\b(?:you|u)\s+(?:are|r)\s+(?:an?\s+)?\w+"),
    re.compile(r"(?i)\b(?:kill|hate|shut)\s+(?:you|up|them)\b"),
    re.compile(r"[@#$%&*]{3,}\w*"),
)


def held_out(doc_id: int | None) -> bool:
    """Whether crc32 of the id's decimal text leaves remainder 2 on division by 4 (null: of the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


def words(text: str | None) -> set[str]:
    """The words of a text, and how longer ones begin, each with ^ before it."""
    found = set(WORD.findall(text.lower())) if text else set()
    return found.union(*({f"^{w[:n]}" for w in found if len(w) > n} for n in BEGINS))


def _odds(one: np.ndarray, zero: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds for class 1 of silence and of firing, given the chance to fire in class 1 and 0."""
    return np.log((1 - one) / (1 - zero)), np.log(one / zero)


def _pairs(votes: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and voter, whether its parent fires, and whether both do."""
    u = np.where(parent >= 0, votes[:, parent], 0)
    return u, votes * u


@dataclass
class LabelModel:
    """prior: chance of class 1. parent: the voter that each voter depends on, or -1. rates[c, u]: chance that a
    voter fires in class c where its parent is silent (u = 0, also without a parent) or fires (1).
    annotator[c]: chance that the annotator says 1 in class c."""

    prior: float
    parent: np.ndarray
    rates: np.ndarray
    annotator: np.ndarray

    def posterior(self, votes: np.ndarray, gold: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Chance of class 1 of each row; gold is nan where the annotator abstains. pairs: what _pairs() gives, if it is at hand."""
        u, both = pairs or _pairs(votes, self.parent)
        (s0, f0), (s1, f1) = (_odds(self.rates[1, k], self.rates[0, k]) for k in (0, 1))
        z = np.log(self.prior / (1 - self.prior)) + s0.sum() + votes @ (f0 - s0) + u @ (s1 - s0) + both @ (f1 - s1 - f0 + s0)
        silent, fires = _odds(self.annotator[1], self.annotator[0])
        z = z + np.where(np.isnan(gold), 0, np.where(gold == 1, fires, silent))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def correlation(self, votes: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Correlations of the voters within the classes."""
        cov = 0
        for q in (p, 1 - p):
            c = (votes - (q @ votes) / max(q.sum(), 1e-9)) * np.sqrt(q)[:, None]
            cov = cov + c.T @ c
        sd = np.sqrt(np.diag(cov)) + 1e-9
        return cov / sd[:, None] / sd[None, :]


#: A dependence is taken up from this conditional mutual information on, times twice the rows: chance alone gives 13.8 to one pair in a thousand.
DEPENDS = 13.8


def dependencies(votes: np.ndarray, p: np.ndarray) -> np.ndarray:
    """tree() of votes whose chance of class 1 is p."""
    each = (1 - p, p)
    return tree([q.sum() for q in each], [q @ votes for q in each], [(votes * q[:, None]).T @ votes for q in each])


def tree(totals: list[float], ones: list[np.ndarray], joints: list[np.ndarray]) -> np.ndarray:
    """Each voter's parent in the tree of largest mutual information given the class, or -1. By class: rows, rows in which each voter fires, and each two do."""
    m = len(ones[0])
    info = np.zeros((m, m))
    for total, one, both in zip(totals, ones, joints, strict=True):
        if total < 1:
            continue
        for a, b, joint in ((1, 1, both), (1, 0, one[:, None] - both), (0, 1, one[None, :] - both), (0, 0, total - one[:, None] - one[None, :] + both)):
            apart = np.outer(one if a else total - one, one if b else total - one) / total
            ratio = np.divide(joint, apart, out=np.ones((m, m)), where=(joint > 1e-9) & (apart > 1e-9))
            info += joint * np.log(np.maximum(ratio, 1e-300))
    np.fill_diagonal(info, 0)
    parent = np.full(m, -1)
    best, of, inside = np.full(m, -np.inf), np.full(m, -1), np.zeros(m, bool)
    for _ in range(m):  # the tree grows by its strongest edge
        k = int(np.argmax(np.where(inside, -np.inf, best))) if inside.any() else int(np.argmax(info.max(1)))
        inside[k] = True
        if of[k] >= 0 and 2 * info[k, of[k]] >= DEPENDS:
            parent[k] = of[k]
        closer = (info[k] > best) & ~inside
        best[closer], of[closer] = info[k][closer], k
    return parent


@dataclass
class Tally:
    """Sums over rows that a round of EM needs, as one array: by class (0, 1) the rows, those that each voter fires in, its parent, and both,
    those that the annotator judges, and calls 1; then all rows by voter; then, if asked for, rows by class and two voters."""

    values: np.ndarray
    m: int

    @classmethod
    def of(cls, votes: np.ndarray, gold: np.ndarray, n: np.ndarray, model: LabelModel | None, parent: np.ndarray, joint: bool) -> Tally:
        """Of rows that stand for n each. Without a model the labelled rows alone count, and their labels are right nine times in ten."""
        pairs, known = _pairs(votes, parent), ~np.isnan(gold)
        if model is None:
            n, p = np.where(known, n, 0), np.where(gold == 1, 0.9, 0.1)
        else:
            p = model.posterior(votes, gold, _pairs(votes, model.parent))
        said, parts = np.where(known, gold, 0), []
        for q in ((1 - p) * n, p * n):
            parts += [[q.sum()], q @ votes, q @ pairs[0], q @ pairs[1], [q @ known], [q @ said]]
        parts += [[n.sum()], n @ votes]
        if joint:
            parts += [((votes * q[:, None]).T @ votes).ravel() for q in ((1 - p) * n, p * n)]
        return cls(np.concatenate(parts), votes.shape[1])

    def by_class(self, c: int) -> tuple:
        """Rows, fired, parents, both, judged, called 1."""
        m, size = self.m, 3 * self.m + 3
        v = self.values[c * size : (c + 1) * size]
        return v[0], v[1 : m + 1], v[m + 1 : 2 * m + 1], v[2 * m + 1 : 3 * m + 1], v[-2], v[-1]

    def tree(self) -> np.ndarray:
        m, at = self.m, 7 * self.m + 7
        joints = [self.values[at + c * m * m : at + (c + 1) * m * m].reshape(m, m) for c in (0, 1)]
        return tree([self.by_class(c)[0] for c in (0, 1)], [self.by_class(c)[1] for c in (0, 1)], joints)

    def fitted(self, parent: np.ndarray) -> LabelModel:
        """The likeliest parameters, drawn a little to rates of both classes together."""
        m, at = self.m, 6 * self.m + 6
        total, mean = self.values[at], self.values[at + 1 : at + 1 + m] / max(self.values[at], 1e-9)
        rates, annotator = np.zeros((2, 2, m)), np.zeros(2)
        for c in (0, 1):
            n, fired, up, both, judged, called = self.by_class(c)
            alone = (fired + 0.5 * mean + (0.01 if c else 1e-4)) / (n + 1)
            rates[c, 0] = (fired - both + alone) / (n - up + 1)
            rates[c, 1] = (both + alone) / (up + 1)
            # as if ten rows more had been labelled, nine of them rightly
            annotator[c] = (called + (9 if c else 1)) / (judged + 10)
        return LabelModel(float(np.clip(self.by_class(1)[0] / max(total, 1e-9), 1e-3, 1 - 1e-3)), parent, np.clip(rates, 1e-5, 1 - 1e-5), annotator)


#: A tally of all rows, given the model (None: by labels alone), the parents to count, and whether to count voters by twos.
Tallies = Callable[[LabelModel | None, np.ndarray, bool], Tally]


def expect(tallies: Tallies, m: int, rounds: int = 20) -> LabelModel:
    """EM over m voters: the labelled rows give the first parameters; then all rows take part, and every fifth round looks for dependences anew."""
    parent = np.full(m, -1)
    model = tallies(None, parent, False).fitted(parent)
    for k in range(rounds):
        if k % 5 == 2:
            parent = tallies(model, parent, True).tree()
        model = tallies(model, parent, False).fitted(parent)
    return model


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 20) -> LabelModel:
    """expect() over votes (0 or 1 by voter) and gold (0, 1, or nan where there is no label) at hand."""
    n = np.ones(len(votes))
    return expect(lambda model, parent, joint: Tally.of(votes, gold, n, model, parent, joint), votes.shape[1], rounds)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge-penalised logistic regression on soft labels, by Newton's steps; rows are taken in parts."""
    d = x.shape[1] + 1
    penalty = np.full(d, ridge)
    penalty[-1] = 1e-6
    w = np.zeros(d)
    for _ in range(rounds):
        h, g = np.diag(penalty), penalty * w
        for a in range(0, len(x), 2000):
            full = np.concatenate([x[a : a + 2000], np.ones((len(x[a : a + 2000]), 1))], axis=1)
            p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
            h = h + (full * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ full
            g = g + full.T @ (p - y[a : a + 2000])
        w = w - np.linalg.solve(h, g)
    return w[:-1], float(w[-1])


@dataclass
class Classifier:
    terms: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = inputs(texts, self.terms)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -50, 50)))


def inputs(texts: list[str | None], terms: dict[str, int]) -> np.ndarray:
    """0 or 1 for each term that a text holds, then for each pattern."""
    x = np.zeros((len(texts), len(terms) + len(PATTERNS)), np.float64)
    for i, text in enumerate(texts):
        if not text:
            continue
        for w in words(text) & terms.keys():
            x[i, terms[w]] = 1
        for k, p in enumerate(PATTERNS):
            if p.search(text):
                x[i, len(terms) + k] = 1
    return x


def _crc() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))


def asked_for(labels: DataFrame) -> DataFrame:
    """(doc_id, y): a label for each labelled row that isn't held out, the larger of several."""
    return labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(_crc() % 4 != 2).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y"))


def sample(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, y, words, patterns) of the labelled rows to mine and to learn from. No row is held out."""
    chosen = asked_for(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    # train_rows rows at most: a broadcast of known size
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("patterns", T.ArrayType(T.IntegerType()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            hit = [[k for k, p in enumerate(PATTERNS) if p.search(t or "")] for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([sorted(words(t)) for t in texts], pa.list_(pa.string())), pa.array(hit, pa.list_(pa.int32()))], schema=pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("words", pa.list_(pa.string())), ("patterns", pa.list_(pa.int32()))]))

    return got.select("doc_id", "y", "text").mapInArrow(rows, out)


@dataclass
class Training:
    """The labelled sample: mined terms, inputs of each row (terms, then patterns), and labels."""

    terms: list[str]
    x: np.ndarray
    gold: np.ndarray

    def votes(self) -> np.ndarray:
        return ballots(self.x, len(self.terms)).astype(np.float64)


def ballots(x: np.ndarray, n_terms: int) -> np.ndarray:
    """The voters' columns of inputs(), and one voter more, who fires where no lexicon voter does."""
    n = min(VOTERS, n_terms)
    return np.concatenate([x[:, :n], x[:, n_terms:], x[:, :n].sum(1, keepdims=True) == 0], axis=1)


def training(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Training | None:
    """The labelled sample; None without labels of both classes.

    Term counts are summed by Spark; only terms found in three toxic rows or more reach the driver, at most
    TERMS of them, ranked by their log likelihood ratio.
    """
    found = sample(docs, labels, train_rows).persist()
    try:
        sizes = {r.y: r.n for r in found.groupBy("y").agg(F.count("*").alias("n")).collect()}
        if not sizes.get(0) or not sizes.get(1):
            return None
        n1, n0 = sizes[1], sizes[0]
        both, share = F.col("a") + F.col("c"), n1 / (n1 + n0)
        gain = F.col("a") * F.log(F.col("a") / (both * share)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (both * (1 - share)))).otherwise(0)
        ranked = (
            found.select("y", F.explode("words").alias("term"))
            .groupBy("term")
            .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("c"))
            .where("a >= 3")
            .where((F.col("a") + 0.5) * n0 >= ODDS * (F.col("c") + 0.5) * n1)
            .withColumn("gain", F.round(gain, 6))
            .orderBy(F.desc("gain"), "term")
            .limit(TERMS)
            .collect()
        )
        terms = {r.term: k for k, r in enumerate(ranked)}
        kept = F.filter("words", lambda w: w.isin(list(terms)))
        data = sorted((r.doc_id, r.y, tuple(r.w), tuple(r.patterns)) for r in found.select("doc_id", "y", kept.alias("w"), "patterns").collect())
    finally:
        found.unpersist()
    x = np.zeros((len(data), len(terms) + len(PATTERNS)), np.float32)
    for i, (_, _, held, hit) in enumerate(data):
        x[i, [terms[w] for w in held]] = 1
        x[i, [len(terms) + k for k in hit]] = 1
    return Training(list(terms), x, np.array([r[1] for r in data], float))


def marked(docs: DataFrame, terms: list[str]) -> DataFrame:
    """docs with marks, the columns of inputs() that are 1, in place of the text: all that a text says to the voters and the classifier."""
    at = {w: k for k, w in enumerate(terms)}
    column = docs.columns.index("text")
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != "text"), T.StructField("marks", T.ArrayType(T.ShortType()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # a thousand rows of inputs at a time
            for part in (b.slice(k, 1000) for k in range(0, b.num_rows, 1000)):
                marks = [np.flatnonzero(x).tolist() for x in inputs(part.column(column).to_pylist(), at)]
                yield pa.RecordBatch.from_arrays([*(c for k, c in enumerate(part.columns) if k != column), pa.array(marks, pa.list_(pa.int16()))], names=schema.names)

    return docs.mapInArrow(rows, schema)


def vote_table(marks: DataFrame, labels: DataFrame, n_terms: int) -> DataFrame:
    """(fired, y, n): of marks (doc_id, marks), how many rows that aren't held out have a list of voters that fire, and a label (null: none).

    Voters are numbered as ballots() has them: terms, patterns, and the one who fires where no term does.
    """
    n = min(VOTERS, n_terms)
    lexicon, patterns = F.filter("marks", lambda m: m < n), F.transform(F.filter("marks", lambda m: m >= n_terms), lambda m: m - n_terms + n)
    silent = F.when(F.size(lexicon) == 0, F.array(F.lit(n + len(PATTERNS)))).otherwise(F.array().cast("array<int>"))
    voted = marks.where("doc_id IS NOT NULL").where(_crc() % 4 != 2).select("doc_id", F.concat(lexicon.cast("array<int>"), patterns.cast("array<int>"), silent).cast("array<smallint>").alias("fired"))
    return voted.join(asked_for(labels), "doc_id", "left").groupBy("fired", "y").agg(F.count("*").alias("n"))


def spread_tallies(table_: DataFrame, m: int) -> Tallies:
    """Tallies of a vote table: each task adds its rows up, Spark the tasks; as many numbers come to the driver as the model has."""

    def tallies(model: LabelModel | None, parent: np.ndarray, joint: bool) -> Tally:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for b in batches:
                for part in (b.slice(k, 2000) for k in range(0, b.num_rows, 2000)):
                    lists = part.column(0)
                    votes = np.zeros((len(lists), m))
                    sizes = np.diff(lists.offsets.to_numpy())
                    votes[np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy()] = 1
                    gold = part.column(1).cast(pa.float64()).to_numpy(zero_copy_only=False)
                    total = total + Tally.of(votes, gold, part.column(2).to_numpy().astype(float), model, parent, joint).values
            if not isinstance(total, int):
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["at", "value"])

        got = table_.mapInArrow(rows, "at int, value double").groupBy("at").agg(F.round(F.sum("value"), 6).alias("value")).toArrow()
        values = np.zeros(7 * m + 7 + (2 * m * m if joint else 0))
        values[got.column(0).to_numpy()] = got.column(1).to_numpy()
        return Tally(values, m)

    return tallies


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Classifier | None:
    """A classifier of the label model's posteriors; None without labels of both classes."""
    space = Space(docs.sparkSession, "toxicity")
    made = learn(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, space, train_rows)
    if made is None:
        return None
    space.drop(made[1])
    return made[0]


def learn(docs: DataFrame, labels: DataFrame, space: Space, train_rows: int = TRAIN_ROWS) -> tuple[Classifier, DataFrame] | None:
    """The classifier, and marked() of all docs (doc_id, text, ...), which is written, so that texts are read once; None without labels of both classes."""
    t = training(docs, labels, train_rows)
    if t is None:
        return None
    votes, marks = t.votes(), space.write(marked(docs, t.terms), "marks")
    # a file for each task that may run at once
    counted = space.write(vote_table(marks, labels, len(t.terms)).repartition(docs.sparkSession.sparkContext.defaultParallelism), "votes")
    model = expect(spread_tallies(counted, votes.shape[1]), votes.shape[1])
    space.drop(counted)
    weights, bias = logistic(t.x, model.posterior(votes, t.gold))
    return Classifier({w: k for k, w in enumerate(t.terms)}, weights, bias), marks


def score_marks(marks: DataFrame, classifier: Classifier, least: float = 0.3) -> DataFrame:
    """marked() rows with score and predicted in place of the marks."""
    weights, bias = classifier.weights, classifier.bias
    kept = [f for f in marks.schema.fields if f.name != "marks"]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(len(kept))
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            z = bias + np.bincount(row, weights[lists.flatten().to_numpy()], len(lists))
            s = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], pa.array(s), pa.array((s >= least).astype(np.int32))], names=schema.names)

    return marks.select(*(f.name for f in kept), "marks").mapInArrow(rows, schema)


def score(docs: DataFrame, classifier: Classifier | None, least: float = 0.3) -> DataFrame:
    """docs (with text) and score, predicted; names that docs has already get a leading underscore."""
    names = fresh(docs, "score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])
    at = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.zeros(b.num_rows) if classifier is None else classifier.score(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= least).astype(np.int32))], names=[*b.schema.names, *names])

    return docs.mapInArrow(rows, schema)


def op2_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document; labels of held-out rows are never read into the fit."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), (_crc() % 4 == 2).alias("held_out"), "text")
    made = learn(docs, table(spark, sf_dir, "labels"), Space(spark, "toxicity"))
    return score(docs, None).drop("text") if made is None else score_marks(made[1], made[0])
