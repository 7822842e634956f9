"""Places in a total order of any size, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.session import cut

#: monotonically_increasing_id() holds the partition above so many bits, and a row's place in it below.
PLACE_BITS = 33


def numbered(df: DataFrame, order: list[Column | str], name: str, partitions: int | None = None, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """df with a long column ``name``: 1, 2, 3, ... in the given order of columns (ties in any order).

    Rows are dealt into sampled ranges of the order and sorted there; a row's number in its range is added
    to the number of rows in the ranges before it. The dealt rows are kept (written) first, so that both
    parts see the same ranges. Rows that tie are dealt by an arbitrary number, so a hot key is split too.
    Only one row per range meets in one task. An empty df gives no rows.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    rows = df.withColumn("__tie", F.monotonically_increasing_id())
    dealt = keep(rows.repartitionByRange(n, *order, "__tie").sortWithinPartitions(*order, "__tie").select(*columns, F.monotonically_increasing_id().alias("__at")))
    part = F.shiftright("__at", PLACE_BITS)
    # one row for each range, whatever the number of rows
    sizes = dealt.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    inside = F.col("__at") - F.shiftleft("__part", PLACE_BITS)
    return dealt.withColumn("__part", part).join(F.broadcast(before), "__part").select(*columns, (F.col("__before") + inside + 1).alias(name))
