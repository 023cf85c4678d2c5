"""Top-k per query and numbering of rows, both without one task seeing a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, by: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """First k rows of each group with their rank.

    Spark cuts every input partition to k rows per group (WindowGroupLimit)
    before the shuffle, so a hot group costs k rows per task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def rank_hits(scored: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score) cut to the k best per query; ties go to the lower id."""
    return top_k(scored, k, ["query_id"], [F.col("score").desc(), F.col("id").asc()])


def number_rows(
    df: DataFrame, groups: list[str], order: list[str], bucket: Column, name: str = "pos"
) -> DataFrame:
    """Consecutive numbers 0, 1, .. inside each group, in ``order``.

    ``bucket`` must not decrease along ``order``. Rows are numbered inside
    (group, bucket) and shifted by the count of the buckets before, so a group
    with most of the rows is still spread over all its buckets.
    """
    split = df.withColumn("_bucket", bucket)
    keys = [*groups, "_bucket"]
    counts = split.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        split.withColumn("_row", F.row_number().over(inside))
        .join(offsets, keys)
        .withColumn(name, (F.col("_offset") + F.col("_row") - 1).cast("bigint"))
        .drop("_bucket", "_row", "_offset")
    )
