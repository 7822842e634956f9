"""Values that must be unique: which rows repeat an earlier one (WIN-04, VAL-09, VAL-11, AGG-13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeats(df: DataFrame, keys: dict[str, Column], place: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(kind, value, place, first, keep): each row that has, for one of the keys, a value that a row at an earlier place has.

    All keys go through one shuffle as (kind, value) pairs. The first place of a value is a minimum that tasks
    work out before they deal, and only values of several rows come back to the rows, in a join that Spark
    may split where a value is hot. Null and empty values say nothing and are passed over. Rows of a value that
    share the first place aren't repeats.
    """
    pairs = F.array(*(F.struct(F.lit(k).alias("kind"), v.cast("string").alias("value")) for k, v in keys.items()))
    each = df.select(F.col(place).alias("place"), *keep, F.explode(pairs).alias("p")).select("p.kind", "p.value", "place", *keep).where("value <> ''")
    first = each.groupBy("kind", "value").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return each.join(first, ["kind", "value"]).where("place > first").select("kind", "value", "place", "first", *keep)


def flags(df: DataFrame, keys: dict[str, str], place: str) -> DataFrame:
    """df with, for each key column and its name, whether an earlier row has the value, and the place of the first one (its own if none has)."""
    again = repeats(df, {k: F.col(k) for k in keys}, place)
    wide = again.groupBy(F.col("place").alias(place)).agg(*(F.min(F.when(F.col("kind") == k, F.col("first"))).alias(f"{name}_first") for k, name in keys.items()))
    out = df.join(wide, place, "left")
    for name in keys.values():
        out = out.withColumn(f"{name}_repeated", F.col(f"{name}_first").isNotNull()).withColumn(f"{name}_first", F.coalesce(f"{name}_first", place))
    return out
