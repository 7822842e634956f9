"""A training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and is written as
Parquet and read again before the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmill.llm import bpe, line_dedup, mixing, quality, set_join
from docmill.llm.common import Space, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the trees learn from those of docs that are labelled."""
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")), keep_only=True)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of repeated three-line windows; n_chars follows the text."""
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.selectExpr(*("CAST(char_length(text) AS BIGINT) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns))
    return cleaned.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest doc_id."""
    return set_join.keep_representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to tempered source weights, in shuffled order."""
    return mixing.mix(docs, mixing.tempered(docs)).select(*docs.columns)


def word_codes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's codes, their number, and the text decoded from them."""
    return bpe.encode(docs.select("doc_id", "source", "text"), keep=["doc_id", "source"])


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("ngram_jaccard_join", near_copies),
    ("source_mixing", source_mix),
    ("bpe_encoding", word_codes),
]

#: Boosted trees and the tokenizer file can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage but the last is written and read again, and deleted once the next one is written."""
    space = Space(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, f) in enumerate(STAGES):
        made = f(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return made
        before, docs = docs, space.write(made, name)
        if k:
            space.drop(before)
    return docs
