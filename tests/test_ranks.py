from __future__ import annotations

from pyspark.sql import functions as F

from docmill.operators import ranks


def test_numbers_follow_the_order(spark):
    df = spark.range(5000).selectExpr("id", "CAST(id * 7919 % 613 AS INT) AS k", "IF(id % 11 = 0, NULL, id % 3) AS g").repartition(7)
    got = ranks.numbered(df, [F.desc("k"), "g", "id"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 5001))
    assert [r.id for r in got] == [r.id for r in df.orderBy(F.desc("k"), "g", "id").collect()]


def test_a_hot_key_is_split(spark):
    df = spark.range(4000).selectExpr("IF(id < 3000, 5, id) AS k")
    kept = []
    out = ranks.numbered(df, ["k"], "n", 8, lambda d: kept.append(d) or d)
    rows = out.collect()
    assert sorted(r.n for r in rows) == list(range(1, 4001))
    assert [r.k for r in sorted(rows, key=lambda r: r.n)] == sorted(r.k for r in rows)
    sizes = [r["count"] for r in kept[0].groupBy(F.shiftright("__at", ranks.PLACE_BITS)).count().collect()]
    assert max(sizes) < 1500


def test_no_rows(spark):
    assert ranks.numbered(spark.range(0), ["id"], "n").collect() == []
