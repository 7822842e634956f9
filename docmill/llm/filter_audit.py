"""An audit of how quality filters interact, kept up to date as files arrive.

Five filters judge each document: A to D by its own text, E by whether another row with a smaller doc_id holds
the same text. Which rows fail E changes while files come in, so the audit is a stream with retractions:

1. Files of documents come in available-now micro-batches. Each batch works out the masks of failed filters
   and the digests of texts, joins the labels, and adds equal rows up, so that a text with a million copies is a
   handful of rows afterwards.
2. A second stream keeps the smallest doc_id of each text in keyed state, with the parts and labels of the rows
   that hold it; a state entry serves a bucket of some texts, by the first bits of their digests. Every row is counted as failing E; the holders of the smallest id are taken out of that count
   and put into that of their mask without E. When a smaller id arrives, the earlier holders are put back.
3. The signed changes of a batch are added up by (part, mask, labels) and written to a folder of the batch's
   number. Their sums over all batches are the counters; 32 masks a part tell all 120 orders of the filters.

Everything is in one folder: streams' checkpoints, added-up rows, and counters. If an executor is lost, a
batch is done again and overwrites its own folder. A later update() of the same folder takes only new files.
What reaches the driver is file names alone.

Null texts count as empty, and a null source is the part ''. Rows without a doc_id never fail E and make no
other row fail it. Rows with the same doc_id and text don't make each other fail. A document labelled more
than once is good, or toxic, if any label says so. Texts of any length are read whole. Other columns aren't
read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from docmill.llm.common import scratch, slices, table

FILTERS = "ABCDE"
#: The bit of filter E, which depends on other rows.
COPY = 16
UPPER, ODD = bytes(range(65, 91)), b"#$%&*|"
#: Bytes that don't begin a code point.
FOLLOWING = bytes(range(0x80, 0xC0))
#: Counters: rows by part, mask of failed filters, and labels.
COUNTER = "part string, mask int, good boolean, toxic boolean, n long"
#: Texts of a bucket, which share one entry of the state, when the first files are taken in.
TEXTS = 64
#: Micro-batches that a run is divided into, as far as there are files.
BATCHES = 4
#: State lives in RocksDB on the executors' disks, not in their heaps, with one bounded cache an executor.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores would each claim some MB of disk in advance
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest) of every row: bits of the filters A to D that its text fails, and 16 bytes that stand for the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(iter([b]), 2, 4 << 20):
                mask, digest = [], []
                for text in part.column(2).cast(pa.binary()).to_pylist():
                    text = text or b""
                    words, points = text.split(), len(text.translate(None, FOLLOWING))
                    fails = len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * (len(text) - len(text.translate(None, UPPER))) > 5 * points, len(text.translate(None, ODD)) < len(text)
                    mask.append(sum(1 << k for k, f in enumerate(fails) if f))
                    digest.append(hashlib.sha256(text).digest()[:16])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())], names=["doc_id", "part", "mask", "digest"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), "text")
    return slim.mapInArrow(rows, "doc_id long, part string, mask int, digest binary")


def added_up(docs: DataFrame, labels: DataFrame, bits: int) -> DataFrame:
    """Rows of a batch by (bucket, digest, mask, part, labels): smallest doc_id, rows that hold it, rows with an id, rows without one."""
    marked = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    known = masks(docs).join(marked, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # by doc_id first, which deals a text with many copies over all tasks, and is how the join left the rows
    keys = ["digest", "mask", "part", "good", "toxic"]
    each = known.groupBy("doc_id", *keys).agg(F.count("*").alias("n"))
    whole = each.groupBy(*keys).agg(F.min("doc_id").alias("doc_id"), F.min_by("n", "doc_id").alias("n_first"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")).otherwise(0)).alias("n_ids"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_none"))
    return whole.withColumn("bucket", F.shiftrightunsigned(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), 48 - bits))


def retract(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by new rows of a bucket's texts; the state is each text's smallest doc_id and the rows that hold it."""
    texts = json.loads(state.get[0]) if state.exists else {}
    out: dict[tuple, int] = {}

    def add(mask: int, who: tuple, n: int) -> None:
        out[(mask, *who)] = out.get((mask, *who), 0) + n

    def hold(mask: int, held: list, sign: int) -> None:
        for *who, n in held:
            add(mask, tuple(who), sign * n)
            add(mask | COPY, tuple(who), -sign * n)

    for b in batches:
        for digest, mask, *who, doc_id, n_first, n_ids, n_none in zip(*(b[c].tolist() for c in ("digest", "mask", "part", "good", "toxic", "doc_id", "n_first", "n_ids", "n_none")), strict=True):
            if n_none:
                add(mask, tuple(who), n_none)
            if not n_ids:
                continue
            add(mask | COPY, tuple(who), n_ids)
            first, held = texts.get(digest.hex(), (None, []))
            mine = [*who, int(n_first)]
            if first is None or doc_id < first:
                hold(mask, held, -1)
                texts[digest.hex()] = int(doc_id), [mine]
                hold(mask, [mine], 1)
            elif doc_id == first:
                same = [x for x in held if x[:3] == who]
                texts[digest.hex()] = first, [x for x in held if x[:3] != who] + [[*who, int(n_first) + sum(x[3] for x in same)]]
                hold(mask, [mine], 1)
    state.update((json.dumps(texts),))
    got = [(part, mask, good, toxic, n) for (mask, part, good, toxic), n in out.items() if n]
    yield pd.DataFrame(got, columns=["part", "mask", "good", "toxic", "n"])


class Audit:
    """Counters of one collection of documents, in one folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark, self.folder = spark, folder or scratch(spark, "audit")

    def _bits(self, rows: int) -> int:
        """Bits of a digest that name its bucket; written once, so that later updates find the same state."""
        path = f"{self.folder}/settings"
        try:
            return self.spark.read.parquet(path).first().bits
        except AnalysisException:
            bits = max(1, min(48, (rows // TEXTS).bit_length()))
            self.spark.range(1).selectExpr(f"{bits} AS bits").write.parquet(path)
            return bits

    def _run(self, stream: DataFrame, name: str, into: str, make: Callable[[DataFrame], DataFrame], mode: str = "append") -> None:
        def write(batch: DataFrame, number: int) -> None:
            # a batch's own session leaves adaptive plans off; skewed joins need them
            batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
            make(batch).write.mode("overwrite").parquet(f"{self.folder}/{into}/{number:09d}")

        query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{self.folder}/{name}").trigger(availableNow=True).start()
        query.awaitTermination()

    def _read(self, path: str, schema, batches: int) -> DataFrame:
        """Files below path as a stream of about so many micro-batches."""
        files = len(self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path).inputFiles())
        return self.spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max(1, -(-files // batches))).parquet(path)

    def update(self, path: str, labels: DataFrame, batches: int = BATCHES) -> Audit:
        """Take in the Parquet files at path that this folder hasn't seen."""
        docs = self.spark.read.parquet(path).select("doc_id", "text", "source")
        bits = self._bits(docs.count())  # from the files' footers
        self._run(self._read(path, docs.schema, batches), "documents-checkpoint", "rows", lambda b: added_up(b, labels, bits))
        rows = f"{self.folder}/rows"
        slim = "bucket long, digest binary, mask int, part string, good boolean, toxic boolean, doc_id long, n_first long, n_ids long, n_none long"
        before = {k: self.spark.conf.get(k, None) for k in STATE}
        try:
            for k, v in STATE.items():
                self.spark.conf.set(k, v)
            changes = self._read(rows, slim, batches).groupBy("bucket").applyInPandasWithState(retract, COUNTER, "texts string", "update", "NoTimeout")
            self._run(changes, "texts-checkpoint", "counters", lambda b: b.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")), "update")
        finally:
            for k, v in before.items():
                if v is None:
                    self.spark.conf.unset(k)
                else:
                    self.spark.conf.set(k, v)
        return self

    def counters(self) -> DataFrame:
        """(part, mask, good, toxic, n) over all batches."""
        found = self.spark.read.schema(COUNTER).option("recursiveFileLookup", "true").parquet(f"{self.folder}/counters")
        return found.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def orders() -> list[dict]:
    """Each order's name, step by step, with the bit of its filter and those of the filters before it."""
    out = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(c) for c in order]
        out += [{"filter_order": "".join(order), "step": k + 1, "own": bits[k], "before": sum(bits[:k])} for k in range(len(bits))]
    return out


def report(counters: DataFrame) -> DataFrame:
    """A row for each part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    masks = counters.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))
    steps = F.from_json(F.lit(json.dumps(orders())), "array<struct<filter_order: string, step: int, own: int, before: int>>")
    each = masks.select("part", "mask", "n", "good", "toxic", F.explode(steps).alias("at")).select("*", "at.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0
    total = lambda which, what: F.sum(F.when(which, F.col(what)).otherwise(0)).alias
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone, "n")("kept"),
        total(fails & ~gone, "n")("removed"),
        total(fails & gone, "n")("redundant"),
        total(F.col("mask") == F.col("own"), "n")("unique_fails"),
        total(fails & ~gone, "good")("good_lost"),
        total(fails & ~gone, "toxic")("toxic_lost"),
        # of 120 orders, each of the filters that a row fails comes first in an equal share
        F.sum(F.when(fails, F.expr("n * 120 div bit_count(mask)")).otherwise(0)).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes of every source, in all 120 orders."""
    return report(Audit(spark).update(f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels")).counters())


OP11_SQL = r"""
WITH marked AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
counted AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS upper, min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
failed AS (SELECT part, doc_id, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b, 100 * upper > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e FROM counted),
known AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM failed LEFT JOIN marked USING (doc_id)),
masks AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM known GROUP BY ALL),
letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
perms AS (SELECT p.l || q.l || r.l || s.l || t.l AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits FROM letters p, letters q, letters r, letters s, letters t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND p.bit | q.bit | r.bit | s.bit | t.bit = 31),
steps AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM perms, generate_series(1, 5) x(step)),
flow AS (SELECT part, filter_order, step, own, mask, n, good, toxic, mask & own > 0 AS fails, mask & before > 0 AS gone FROM masks, steps),
sums AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
  coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails, coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost FROM flow GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM sums
"""
