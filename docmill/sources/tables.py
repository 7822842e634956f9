"""Landed tables: one Parquet file or folder per table under one path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read table ``name``; the path may be anything that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
