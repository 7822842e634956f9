"""Registered queries over the driver's tables, and the same results in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docmill.jobs import audits, catalogs, courses, pages, sheets, texts, topics, trees

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for _module in (pages, texts, catalogs, sheets, courses, topics, audits, trees):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
