"""Shared helpers."""

from pyspark.sql import functions as F

from sparkrank.llm.shared import smallest


def test_smallest_hashes(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"))
    every = sorted(r["h"] for r in rows.collect())
    for n in (1, 700, 4999, 9000):
        assert [r["h"] for r in smallest(rows, n).collect()] == every[:n]
    skewed = spark.range(5000).select((F.col("id") + 1).alias("h"))
    assert [r["h"] for r in smallest(skewed, 10).collect()] == list(range(1, 11))
    assert smallest(rows.limit(0), 5).count() == 0
