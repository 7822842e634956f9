"""Exact top-k search by inner product: columnar branch and bound.

Vectors are turned into integers and packed into blocks that hold one array per dimension. Blocks of
queries meet groups of candidate blocks in a grid of cells, so neither side is ever broadcast or held whole.
In a cell, inner products grow by a few dimensions at a time; what the remaining dimensions can still add
is bounded by the product of the remaining norms, and candidates whose upper bound is below the k-th lower
bound are dropped and the columns compacted. Ties are never dropped.

Scores are exact for components of any size: where sums might leave what a double holds exactly, doubles
(scaled, with bounds on their rounding) only drop candidates, and those left are scored in whole numbers. A
score that doesn't fit a long is null; its rank is right all the same.

Vectors that are null, or hold a null or a component that isn't finite (also after scaling by 1024), take no
part; shorter ones count as if zeros followed; rows without an id take no part either. Rows with the same id
are candidates each, but none for that id's own query; each row of a repeated query id gets its own k.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.common import stage, table

#: Rows per block, candidate rows per cell, query rows per cell, dimensions per step.
ROWS, CELL, QUERIES, STEP = 2048, 16384, 4096, 16
BLOCK = T.StructType([T.StructField("n", T.LongType()), T.StructField("dims", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("ids", T.BinaryType()), T.StructField("columns", T.BinaryType())])
FOUND = "query_id long, block long, at int, vec_id long, size int, score long, key binary"


def narrowest(m: np.ndarray) -> str:
    """The smallest type that holds whole numbers, given as doubles."""
    most = np.abs(m).max(initial=0)
    return "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"


def pack(vectors: DataFrame, rows_per_block: int) -> DataFrame:
    """(vec_id, v array<double>) to blocks: ids, and the components one dimension after the other."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            dims = max(p.shape[1] for p in parts)
            m = np.concatenate([np.pad(p, ((0, 0), (0, dims - p.shape[1]))) for p in parts])
            own = np.concatenate(ids)
            order, kind = np.argsort(own, kind="stable"), narrowest(m)
            return pa.RecordBatch.from_arrays([pa.array([len(own)], pa.int64()), pa.array([dims], pa.int32()), pa.array([kind]), pa.array([own[order].astype("<i8").tobytes()], pa.binary()), pa.array([np.ascontiguousarray(m[order].T).astype(kind).tobytes()], pa.binary())], names=BLOCK.names)

        for b in batches:
            for a in range(0, b.num_rows, rows_per_block):
                part = b.slice(a, rows_per_block)
                lists = part.column(1)
                sizes = np.diff(np.asarray(lists.offsets))
                dims = int(sizes.max())
                m = np.zeros((part.num_rows, dims))
                m[np.arange(dims)[None, :] < sizes[:, None]] = np.asarray(lists.flatten(), np.float64)
                ids.append(np.asarray(part.column(0), np.int64))
                parts.append(m)
                held += part.num_rows
                if held >= rows_per_block:
                    yield flush()
                    ids, parts, held = [], [], 0
        if held:
            yield flush()

    return vectors.mapInArrow(rows, BLOCK)


def unpack(n: int, dims: int, kind: str, ids: bytes, columns: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(columns, kind).reshape(dims, n).astype(np.float64)


def whole_scores(q: np.ndarray, columns: np.ndarray) -> list[int]:
    """Inner products in whole numbers of any size."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(columns).max(initial=0)) * len(q)
    if most < 1 << 63:
        return (q.astype(np.int64) @ columns.astype(np.int64)).tolist()
    own = [int(x) for x in q]
    return [sum(map(int.__mul__, own, map(int, c))) for c in columns.T.tolist()]


@dataclass
class Side:
    """Vectors as columns: whole numbers as doubles, and the same as seen by the bounds, with the norms of what each step leaves."""

    ids: np.ndarray
    columns: np.ndarray
    scaled: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, columns: np.ndarray, exact: bool) -> Side:
        most = np.abs(columns).max(initial=0)
        # by a power of two, so that nothing rounds and squares stay finite
        scaled = columns if exact or not most else np.ldexp(columns, -int(np.frexp(most)[1]))
        norms = np.sqrt(np.cumsum((scaled**2)[::-1], axis=0)[::-1])
        return cls(ids, columns, scaled, np.concatenate([norms[::STEP], np.zeros((1, len(ids)))]))


def search(side: Side, query: Side, j: int, exact: bool, k: int) -> tuple[np.ndarray, list[int]]:
    """Ids and scores of the k best candidates of side for query j (largest score, then smallest id); ids of side ascend."""
    q, scaled, rest = query.columns[:, j], query.scaled[:, j], query.rest[:, j]
    alive = np.flatnonzero(side.ids != query.ids[j])
    so_far, whole = np.zeros(len(alive)), len(alive) == len(side.ids)
    # what rounding can do to a sum: nothing where all are whole numbers below 2**53
    doubt = None if exact else rest[0] * side.rest[0] * ((len(q) + 8) * 2.0**-52) + 1e-280
    for s, a in enumerate(range(0, len(q), STEP)):
        part = side.scaled[a : a + STEP]
        so_far = so_far + (scaled[a : a + STEP] @ (part if whole else part[:, alive]))
        last = a + STEP >= len(q)
        if len(alive) > k and not (last and exact):
            slack = np.zeros(len(alive)) if last else rest[s + 1] * side.rest[s + 1][alive] * (1 + 1e-9) + (1e-3 if exact else 0)
            if not exact:
                slack = slack + doubt[alive]
            floor = np.partition(so_far - slack, len(alive) - k)[len(alive) - k]
            keep = so_far + slack >= floor
            if not keep.all():
                alive, so_far, whole = alive[keep], so_far[keep], False
    if exact:
        order = np.lexsort((side.ids[alive], -so_far))[:k]
        return side.ids[alive[order]], so_far[order].astype(np.int64).tolist()
    scores = whole_scores(q, side.columns[:, alive])
    order = sorted(range(len(alive)), key=lambda i: (-scores[i], side.ids[alive[i]]))[:k]
    return side.ids[alive[order]], [scores[i] for i in order]


def ordered(score: int) -> tuple[int, int, bytes | None]:
    """What scores are ranked by: whether they are below (-1), within (0) or above (1) a long's range, themselves within it, and beyond it bytes in their order."""
    if -(1 << 63) <= score < 1 << 63:
        return 0, score, None
    size = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    key = len(size).to_bytes(4, "big") + size
    return (1, 0, key) if score > 0 else (-1, 0, bytes(255 - b for b in key))


def gathered(frame: pd.DataFrame, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and columns of several blocks, cut or filled up to dims (default: the most that one has)."""
    got = [unpack(*r) for r in frame[["n", "dims", "kind", "ids", "columns"]].itertuples(index=False)]
    dims = dims or max(c.shape[0] for _, c in got)
    return np.concatenate([i for i, _ in got]), np.concatenate([np.pad(c, ((0, max(0, dims - c.shape[0])), (0, 0)))[:dims] for _, c in got], axis=1)


def cell(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of one cell's candidates for each of its queries."""
    out: list[list] = [[] for _ in range(7)]
    if len(left) and len(right):
        ids, columns = gathered(left)
        order = np.argsort(ids, kind="stable")
        ids, columns = ids[order], np.ascontiguousarray(columns[:, order])
        sides: dict[bool, Side] = {}
        for n in range(len(right)):
            one = right.iloc[n : n + 1]
            own, qs = gathered(one, len(columns))
            exact = len(columns) * float(np.abs(columns).max(initial=0)) * float(np.abs(qs).max(initial=0)) < 2.0**53
            if exact not in sides:
                sides[exact] = Side.of(ids, columns, exact)
            query = Side.of(own, qs, exact)
            for j in range(len(own)):
                found, scores = search(sides[exact], query, j, exact, k)
                size, score, key = zip(*map(ordered, scores), strict=True) if scores else ((), (), ())
                for column, new in zip(out, ([own[j]] * len(found), [one["block"].iat[0]] * len(found), [j] * len(found), found, size, score, key), strict=True):
                    column.extend(new)
    names = [f.split()[0] for f in FOUND.split(", ")]
    kinds = ("int64", "int64", "int32", "int64", "int32", "int64", object)
    return pd.DataFrame({name: pd.Series(column, dtype=kind) for name, column, kind in zip(names, out, kinds, strict=True)})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of vectors for each row of queries, both (vec_id, v array<double> of whole numbers)."""
    candidates = stage(pack(vectors, ROWS), "candidates")
    # written with numbers, by which rows of one query id are told apart
    asked = stage(pack(queries, QUERIES).withColumn("block", F.monotonically_increasing_id()), "queries")
    counted = candidates.agg(F.sum("n")).collect()[0][0] or 0, asked.agg(F.sum("n")).collect()[0][0] or 0
    columns, rows = max(1, -(-counted[0] // CELL)), max(1, -(-counted[1] // QUERIES))
    seed = F.xxhash64("ids")
    # each block of candidates goes to one column of the grid and to all its rows, each of queries the other way
    left = candidates.withColumn("col", F.pmod(seed, F.lit(columns))).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    right = asked.withColumn("row", F.pmod(seed, F.lit(rows)).cast("int")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))).withColumn("col", F.col("col").cast("long"))
    found = left.groupBy("row", "col").cogroup(right.groupBy("row", "col")).applyInPandas(lambda a, b: cell(a, b, k), FOUND)
    best = Window.partitionBy("query_id", "block", "at").orderBy(F.desc("size"), F.desc("score"), F.desc("key"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.when(F.col("size") == 0, F.col("score")).alias("score"))


def integers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): floor(1024 * x) of every component as a double, which holds it exactly; only of rows whose components are all finite numbers."""
    v = F.transform("embedding", lambda x: x.cast("double") * 1024)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # doubles from 2**52 on are whole numbers
    whole = F.transform(v, lambda x: F.when(F.abs(x) < F.lit(2.0**52), F.floor(x).cast("double")).otherwise(x))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows for every row whose id is divisible by 100."""
    vectors = integers(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (SELECT *, row_number() OVER () AS n FROM v WHERE vec_id % 100 = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM q JOIN v c ON c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
