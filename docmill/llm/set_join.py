"""N-gram Jaccard join: chosen-path join over sets of five-word shingles.

1. Each text becomes its set of shingles and a MinHash embedding of it. Texts with equal sets form one
   record, so exact copies are never paired.
2. Chosen paths: at a node, each coordinate of the embedding is sampled with probability 1 / (LEAST *
   COORDINATES), by a hash of the node, and the node's records are split on their value there, which stands
   for a shared token. Nodes of few records are compared all against all by their embeddings; others are
   split again, and those still large after LEVELS splits are compared block by block, so that no node is
   cut short. The whole is repeated with new hashes, as often as the target recall asks for.
3. Records whose embeddings agree well enough are candidates, and connected candidates a family. Within
   each family all pairs whose sizes allow a link are compared by their exact sets, again block by block. A
   pair is a link if its Jaccard similarity is LEAST or more; links' connected components are the classes.

Words are runs without ASCII white space, in lower case. A text of one to four words has one shingle, all
its words. Texts without words (null, empty) are classes of their own and have no links. Every row counts,
whatever its doc_id: repeated rows and rows with a null doc_id are copies like any others, and rows that
share a doc_id but not the text are told apart by their sets. A class is named by its smallest doc_id (null
if it has none), so two classes have one name only where different texts share that doc_id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.common import Space, fresh, table
from docmill.llm.components import components

WORDS_PER_SHINGLE, LEAST = 5, 0.8
COORDINATES, LEVELS, RECALL = 64, 3, 0.99
#: Records that one node compares at once, and of a block; records of a block of exact sets.
SMALL, BLOCK, EXACT = 256, 1024, 512
#: Embeddings that agree in this share of coordinates make a candidate: four standard errors below LEAST.
CANDIDATE = 0.6
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of a common 64-bit generator: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeded(*values: int) -> int:
    return xxhash.xxh64_intdigest(",".join(map(str, values)))


#: Odd factors of the embedding's hashes.
FACTORS = np.array([_seeded(7, i) | 1 for i in range(COORDINATES)], np.uint64)
POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WORDS_PER_SHINGLE, 0, -1)], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    got = text.lower().encode("utf-8", "surrogatepass").split() if text else []
    n = len(got)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, got), np.uint64, n)
    if n < WORDS_PER_SHINGLE:
        return np.array([_seeded(n, *h.tolist())], np.uint64)
    m = n - WORDS_PER_SHINGLE + 1
    out = np.zeros(m, np.uint64)
    for k in range(WORDS_PER_SHINGLE):
        out += h[k : k + m] * POWERS[k]
    return np.unique(_mix(out))


def embed(hashes: np.ndarray) -> np.ndarray:
    """MinHash: the smallest upper half of each coordinate's hash."""
    low = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for a in range(0, len(hashes), 4096):
        part = (hashes[a : a + 4096, None] * FACTORS[None, :]) >> np.uint64(32)
        low = np.minimum(low, part.min(axis=0))
    return low.astype("<u4")


def runs_for(recall: float = RECALL, levels: int = LEVELS) -> int:
    """Runs after which a pair of similarity LEAST has met with probability recall, were its nodes always split levels times.

    One run's pair survives a split with a Poisson number of common children of mean 1.
    """
    q = 1.0
    for _ in range(levels):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


FEATURES = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("embedding", T.BinaryType()), T.StructField("size", T.LongType())])
NODES = T.StructType([T.StructField("node", T.LongType()), T.StructField("rec", T.LongType())])
FOUND = T.StructType([T.StructField("rec", T.LongType()), T.StructField("root", T.LongType()), T.StructField("links", T.LongType())])


def features(text: Column) -> Column:
    """A struct of FEATURES of each text, of nulls where it has no words; other columns don't pass through Python."""

    def made(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            digests, embeddings, sizes = [], [], []
            for k in range(len(column)):
                s = shingles(column[k].as_py())
                some = len(s) > 0
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if some else None)
                embeddings.append(embed(s).tobytes() if some else None)
                sizes.append(len(s) if some else None)
            yield pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(embeddings, pa.binary()), pa.array(sizes, pa.int64())], FEATURES.names)

    return F.arrow_udf(made, FEATURES)(text)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, COORDINATES)


def _emit(node: np.ndarray, rec: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(rec)], names=NODES.names)


def _children(node: np.ndarray, rec: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Split each record's node: one child per sampled coordinate, named by node, coordinate and value."""
    chance = np.uint64(int(_MASK / (LEAST * COORDINATES)))
    for i in range(COORDINATES):
        of = _mix(node + np.uint64(_seeded(11, i)))
        go = of < chance
        if go.any():
            yield _emit(_mix(of[go] ^ _mix(values[go, i].astype(np.uint64) + np.uint64(i << 32))), rec[go])


def roots(records: DataFrame, runs: int) -> DataFrame:
    """The first split of every run."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rec, values = np.asarray(b.column(0), np.int64), _matrix(b.column(1))
            for r in range(runs):
                yield from _children(np.full(len(rec), _seeded(*_live(r)), np.uint64), rec, values)

    return records.select("rec", "embedding").mapInArrow(rows, NODES)


def _live(run: int) -> tuple[int, int, int]:
    """A seed for the run's root under which at least one coordinate is sampled."""
    chance = int(_MASK / (LEAST * COORDINATES))
    k = 0
    while True:
        node = np.full(1, _seeded(3, run, k), np.uint64)
        if any(_mix(node + np.uint64(_seeded(11, i)))[0] < chance for i in range(COORDINATES)):
            return 3, run, k
        k += 1


def split(nodes: DataFrame, records: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _children(np.asarray(b.column(0), np.int64).view(np.uint64), np.asarray(b.column(1), np.int64), _matrix(b.column(2)))

    return nodes.select("node", "rec").join(records.select("rec", "embedding"), "rec").select("node", "rec", "embedding").mapInArrow(rows, NODES)


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of rows with equal first columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        columns = [np.asarray(b.column(k)) for k in range(keys)]
        change = np.zeros(b.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for a, z in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(a, z - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def forest(rec: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """For each record the smallest record that pairs (rows of two positions) connect it with."""
    label = rec.copy()
    if len(pairs):
        i, j = pairs[:, 0], pairs[:, 1]
        while True:
            before = label.copy()
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            if (before == label).all():
                break
    return label


def paired(rows: DataFrame, own: Column, others: Column) -> DataFrame:
    """rows once for each block of others, with own and both blocks in order (one, two)."""
    each = rows.withColumn("own", own).withColumn("other", F.explode(others))
    return each.withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other"))


def node_blocks(rows: DataFrame) -> DataFrame:
    """rows (node, n, rec) for each pair of blocks of their node that they belong to; small nodes have the pair (0, 0)."""
    n = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("long")
    return paired(rows, F.pmod(F.xxhash64("rec", "node"), n), F.sequence(F.lit(0).cast("long"), n - 1))


def band(size: Column) -> Column:
    """Sizes of sets in steps of 1 / LEAST (a hair more, against rounding): linked sets are at most one step apart."""
    return F.floor(F.log(size.cast("double")) / F.lit(math.log(1.0000001 / LEAST))).cast("int")


def family_blocks(rows: DataFrame) -> DataFrame:
    """rows (family, n, bands, band, rec) for each pair of blocks of their own and the neighbouring bands; small families have the pair (0, 0)."""
    of = lambda b, k: b.cast("long") * F.lit(1 << 32) + k
    parts = lambda n: F.ceil(n / EXACT).cast("long")
    whole = F.col("n") <= EXACT
    own = of(F.col("band"), F.pmod(F.xxhash64("rec", "family"), parts(F.element_at("bands", F.col("band")))))
    near = F.filter(F.map_entries("bands"), lambda e: F.abs(e.key - F.col("band")) <= 1)
    others = F.flatten(F.transform(near, lambda e: F.transform(F.sequence(F.lit(0).cast("long"), parts(e.value) - 1), lambda k: of(e.key, k))))
    zero = F.lit(0).cast("long")
    return paired(rows, F.when(whole, zero).otherwise(own), F.when(whole, F.array(zero)).otherwise(others))


def compare_embeddings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, one, two, own, rec, embedding) to (rec, root) of agreeing records of each pair of blocks."""
    need = math.ceil(CANDIDATE * COORDINATES)
    out_rec, out_root, held = [], [], 0
    for t in grouped(batches, 3):
        one, two = t.column(1)[0].as_py(), t.column(2)[0].as_py()
        own, rec = np.asarray(t.column(3)), np.asarray(t.column(4), np.int64)
        values = _matrix(t.column(5))
        left = np.arange(len(rec)) if one == two else np.flatnonzero(own == one)
        right = left if one == two else np.flatnonzero(own == two)
        found = []
        for a in range(0, len(left), 64):
            part = left[a : a + 64]
            agree = (values[part][:, None, :] == values[right][None, :, :]).sum(axis=2)
            i, j = np.nonzero(agree >= need)
            found.append(np.stack([part[i], right[j]], axis=1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        root = forest(rec, pairs[rec[pairs[:, 0]] != rec[pairs[:, 1]]])
        moved = root != rec
        if moved.any():
            out_rec.append(rec[moved])
            out_root.append(root[moved])
            held += int(moved.sum())
        if held > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_rec)), pa.array(np.concatenate(out_root))], names=["rec", "root"])
            out_rec, out_root, held = [], [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_rec)), pa.array(np.concatenate(out_root))], names=["rec", "root"])


def candidates(records: DataFrame, runs: int, space: Space) -> DataFrame:
    """(rec, root): edges that connect the records that chosen paths brought together and whose embeddings agree."""
    nodes, leaves = space.write(roots(records, runs), "nodes"), None
    for level in range(1, LEVELS + 1):
        # written before the join, so that Spark may split a node that holds many records
        sizes = space.write(nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        met = space.write(nodes.join(sizes, "node"), "met")
        space.drop(nodes, sizes)
        ready = met if level == LEVELS else met.where(F.col("n") <= SMALL)
        leaves = ready if leaves is None else leaves.unionByName(ready)
        large = met.where(F.col("n") > SMALL)
        if level == LEVELS or large.isEmpty():
            break
        nodes = space.write(split(large, records), "nodes")
    known = leaves.join(records.select("rec", "embedding"), "rec")
    dealt = node_blocks(known).select("node", "one", "two", "own", "rec", "embedding").repartition("node", "one", "two").sortWithinPartitions("node", "one", "two")
    return dealt.mapInArrow(compare_embeddings, "rec long, root long")


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of a with all of b; a matrix product for frequent elements, and lists for rare ones."""
    out = np.zeros((len(a), len(b)), np.float32)
    elements, flat = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    flat = flat.reshape(-1)
    cut = sum(map(len, a))
    fa, fb = flat[:cut], flat[cut:]
    ra, rb = np.repeat(np.arange(len(a)), list(map(len, a))), np.repeat(np.arange(len(b)), list(map(len, b)))
    ca, cb = np.bincount(fa, minlength=len(elements)), np.bincount(fb, minlength=len(elements))
    shared = (ca > 0) & (cb > 0)
    heavy = shared & (ca * cb > max(16, len(a) * len(b) / 200))
    ids = np.cumsum(heavy) - 1
    n = int(heavy.sum())
    for s in range(0, n, 4096):
        def dense(rows: np.ndarray, e: np.ndarray, count: int, s: int = s) -> np.ndarray:
            m = np.zeros((count, min(4096, n - s)), np.float32)
            k = ids[e]
            go = heavy[e] & (k >= s) & (k < s + 4096)
            m[rows[go], k[go] - s] = 1
            return m

        out += dense(ra, fa, len(a)) @ dense(rb, fb, len(b)).T
    light = shared & ~heavy
    if light.any():
        ga, gb = light[fa], light[fb]
        ea, wa, eb, wb = fa[ga], ra[ga], fb[gb], rb[gb]
        oa, ob = np.argsort(ea, kind="stable"), np.argsort(eb, kind="stable")
        ea, wa, eb, wb = ea[oa], wa[oa], eb[ob], wb[ob]
        first, count = np.searchsorted(eb, ea, "left"), np.searchsorted(eb, ea, "right")
        count = count - first
        left = np.repeat(wa, count)
        at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        out += np.bincount(left * len(b) + wb[at], minlength=out.size).reshape(out.shape)
    return out


def compare_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (family, one, two, own, rec, copies, hashes) to (rec, root, links) of each pair of blocks."""
    out: list[list[np.ndarray]] = [[], [], []]
    for t in grouped(batches, 3):
        one, two = t.column(1)[0].as_py(), t.column(2)[0].as_py()
        own, rec, copies = np.asarray(t.column(3)), np.asarray(t.column(4), np.int64), np.asarray(t.column(5), np.int64)
        sets = [np.frombuffer(h, "<u8") for h in t.column(6).to_pylist()]
        left = np.arange(len(rec)) if one == two else np.flatnonzero(own == one)
        right = left if one == two else np.flatnonzero(own == two)
        links = np.zeros(len(rec), np.int64)
        root = rec
        if len(left) and len(right):
            both = intersections([sets[i] for i in left], [sets[i] for i in right])
            na, nb = np.array([len(sets[i]) for i in left]), np.array([len(sets[i]) for i in right])
            # J >= 4/5 in whole numbers: 5 * both >= 4 * either
            linked = 5 * both >= 4 * (na[:, None] + nb[None, :] - both)
            linked &= rec[left][:, None] != rec[right][None, :]
            links[left] += linked @ copies[right]
            if one != two:
                links[right] += linked.T @ copies[left]
            i, j = np.nonzero(linked)
            root = forest(rec, np.stack([left[i], right[j]], axis=1))
        for column, new in zip(out, (rec, root, links), strict=True):
            column.append(new)
        if sum(map(len, out[0])) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=FOUND.names)
            out = [[], [], []]
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=FOUND.names)


def with_sets(members: DataFrame) -> DataFrame:
    """members (…, text) with hashes, the shingles made anew from the text, instead of it."""
    fields = [f for f in members.schema.fields if f.name != "text"]
    at = members.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                hashes = [shingles(t).astype("<u8").tobytes() for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in fields), pa.array(hashes, pa.binary())], names=[*(f.name for f in fields), "hashes"])

    return members.mapInArrow(rows, T.StructType([*fields, T.StructField("hashes", T.BinaryType())]))


def numbered(docs: DataFrame, space: Space) -> tuple[DataFrame, list[str]]:
    """docs written with a number, digest, embedding and size of each row, and these columns' names.

    The numbers are made once and written, so they tell rows apart whatever the rows hold.
    """
    row, made = fresh(docs, "row", "made")
    got = space.write(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(made, features(F.col("text"))), "rows")
    return got, [row, *(f"{made}.{name}" for name in FEATURES.names)]


def classify(rows: DataFrame, space: Space, recall: float) -> DataFrame:
    """(digest, copies, rec, root, n_links) of every different set of rows (row, doc_id, text, digest, embedding, size).

    root: the class, by the number of one of its records; null where no other record is linked.
    """
    same = rows.where("digest IS NOT NULL").groupBy("digest", "embedding").agg(F.count("*").alias("copies"), F.min("row").alias("row"), F.max("size").alias("size"))
    records = space.write(same.withColumn("rec", F.monotonically_increasing_id()), "records")
    family = components(candidates(records, runs_for(recall), space), "rec", "root")
    # roots are members too
    listed = family.select(F.col("node").alias("rec"), F.col("root").alias("family")).unionByName(family.select(F.col("root").alias("rec"), F.col("root").alias("family")).distinct())
    banded = space.write(listed.join(records.select("rec", "row", "copies", band(F.col("size")).alias("band")), "rec"), "members")
    counts = banded.groupBy("family", "band").agg(F.count("*").alias("k"))
    # a family has as many bands as sizes have steps of a quarter: a few dozen
    families = space.write(counts.groupBy("family").agg(F.sum("k").alias("n"), F.map_from_entries(F.collect_list(F.struct("band", "k"))).alias("bands")), "families")
    members = banded.join(families, "family").join(rows.select("row", "text"), "row").select("family", "n", "bands", "band", "rec", "copies", "text")
    dealt = family_blocks(with_sets(members)).select("family", "one", "two", "own", "rec", "copies", "hashes").repartition("family", "one", "two").sortWithinPartitions("family", "one", "two")
    found = space.write(dealt.mapInArrow(compare_sets, FOUND), "found")
    classes = components(found.select("rec", "root"), "rec", "root")
    linked = classes.select(F.col("node").alias("rec"), "root").unionByName(classes.select(F.col("root").alias("rec"), "root").distinct())
    links = found.groupBy("rec").agg(F.sum("links").alias("links"))
    known = records.select("rec", "digest", "copies").join(linked, "rec", "left").join(links, "rec", "left")
    out = space.write(known.select("digest", "copies", "rec", "root", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    space.drop(records, banded, families, found)
    return out


def near_duplicates(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links, is_representative) of every row of docs.

    class_id: the smallest doc_id of the class. n_links: rows linked with this one, exact copies included.
    is_representative: one row of each class (rows alike in doc_id share it).
    """
    space = Space(docs.sparkSession, "set-join")
    got, names = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), space)
    rows = got.select(F.col(names[0]).alias("row"), "doc_id", "text", *[F.col(n).alias(k) for n, k in zip(names[1:], FEATURES.names, strict=True)])
    known = classify(rows, space, recall)
    own = space.write(rows.select("doc_id", "digest").join(known, "digest", "left").select("doc_id", "n_links", "digest", F.coalesce("root", "rec").alias("class")), "classed")
    low = space.write(own.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("low")), "low")
    space.drop(got, known)
    out = own.join(low, "class", "left").withColumn("class_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("low")))
    return out.select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("class_id").eqNullSafe(F.col("doc_id")).alias("is_representative"))


def keep_representatives(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """docs with one row of each class: of the smallest doc_id (null last), and of its rows one with the smallest text hash. Rows without words stay."""
    space = Space(docs.sparkSession, "set-join")
    got, names = numbered(docs, space)
    rows = got.select(F.col(names[0]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(n).alias(k) for n, k in zip(names[1:], FEATURES.names, strict=True)])
    shared = classify(rows, space, recall).where("copies > 1 OR root IS NOT NULL").select("digest", F.coalesce("root", "rec").alias("class"))
    members = space.write(rows.select("row", "doc_id", F.xxhash64("text").alias("hash"), "digest").join(shared, "digest").select("class", "row", "doc_id", "hash"), "shared")
    first = members.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "hash", "row")).alias("first"))
    gone = members.select("row").join(first.select("first.row"), "row", "left_anti").select(F.col("row").alias(names[0]))
    return got.join(gone, names[0], "left_anti").select(*docs.columns)


def op4_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
