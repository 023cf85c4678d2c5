"""Ranking metrics per query, their means, and improvements over a baseline."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METHODS = ("bm25", "vector", "hybrid", "hybrid_rrf")
METRICS = ("precision", "recall", "mrr", "ndcg")


def graded_dcg(hits: DataFrame, gains: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, method, dcg) with linear gain; an unlisted document gains 0."""
    gain = F.coalesce("gain", F.lit(0.0))
    return (
        hits.join(gains.select("query_id", "id", "gain"), ["query_id", "id"], "left")
        .groupBy("query_id", "method")
        .agg(F.sum(F.when(F.col("rank") <= k, gain / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias("dcg"))
    )


def _ideal_dcg(relevant: Column, k: int) -> Column:
    """DCG of min(relevant, k) relevant documents on top; the k prefix sums are constants."""
    sums, total = [0.0], 0.0
    for rank in range(1, k + 1):
        total += 1 / math.log2(rank + 1)
        sums.append(total)
    return F.get(F.array(*[F.lit(s) for s in sums]), F.least(relevant, F.lit(k)).cast("int"))


def evaluate(
    hits: DataFrame,
    qrels: DataFrame,
    queries: DataFrame,
    k: int = 10,
    methods: tuple[str, ...] = METHODS,
) -> DataFrame:
    """(query_id, query_type, method, precision, recall, mrr, ndcg).

    Every query appears with every method; without hits or without relevant
    documents its metrics are 0. Precision divides by k; the reciprocal rank
    looks at the whole list; a document listed twice counts once in precision
    and recall and each time in nDCG.
    """
    relevant = qrels.select("query_id", "id").distinct()
    n_relevant = relevant.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel"))
    base = queries.select(
        "query_id",
        F.coalesce("query_type", F.lit("unknown")).alias("query_type"),
        F.explode(F.array(*[F.lit(m) for m in methods])).alias("method"),
    )
    discount = F.when(F.col("rank") <= k, 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)
    per_query = (
        hits.select("query_id", "method", "id", "rank")
        .join(relevant, ["query_id", "id"], "left_semi")
        .groupBy("query_id", "method", "id")
        .agg(F.min("rank").alias("first"), F.sum(discount).alias("dcg"))
        .groupBy("query_id", "method")
        .agg(
            F.count_if(F.col("first") <= k).alias("found"),
            F.min("first").alias("first"),
            F.sum("dcg").alias("dcg"),
        )
    )
    found, total = F.coalesce("found", F.lit(0)), F.coalesce("n_rel", F.lit(0))
    ideal = _ideal_dcg(total, k)
    zero = F.lit(0.0)
    metrics = {
        "precision": found / F.lit(k) if k > 0 else zero,
        "recall": F.coalesce(F.try_divide(found, total), zero),
        "mrr": F.coalesce(1 / F.col("first"), zero),
        "ndcg": F.coalesce(F.try_divide(F.coalesce("dcg", zero), ideal), zero),
    }
    return (
        base.join(per_query, ["query_id", "method"], "left")
        .join(n_relevant, "query_id", "left")
        .select("query_id", "query_type", "method", *[c.alias(n) for n, c in metrics.items()])
    )


def summarize(metrics: DataFrame, by: tuple[str, ...] = ("method",)) -> DataFrame:
    """Mean of each metric over the queries of a group."""
    return metrics.groupBy(*by).agg(*[F.avg(m).alias(m) for m in METRICS])


def rollup(metrics: DataFrame, by: tuple[str, ...] = ("query_type", "method")) -> DataFrame:
    """Mean of each metric per group, per shorter group and over all, in one pass.

    ``level`` is 0 for whole groups and has a bit per column that is summed up,
    so a row of a null type and the row of all types are told apart.
    """
    return metrics.rollup(*by).agg(
        F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("queries"),
        *[F.avg(m).alias(m) for m in METRICS],
    )


def summarize_method(metrics: DataFrame, method: str) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    return summarize(metrics.where(F.col("method") == method))


def long_form(summary: DataFrame, keys: tuple[str, ...] = ("method",)) -> DataFrame:
    """(keys.., metric, value)."""
    return summary.unpivot(list(keys), list(METRICS), "metric", "value")


def improvements(summary: DataFrame, baseline: str = "bm25") -> DataFrame:
    """(method, metric, improvement) in percent; over a zero baseline 0 or +infinity."""
    rows = long_form(summary)
    base = rows.where(F.col("method") == baseline).select("metric", F.col("value").alias("base"))
    change = (F.col("value") - F.col("base")) / F.when(F.col("base") > 0, F.col("base")) * 100
    return (
        rows.where(F.col("method") != baseline)
        .join(F.broadcast(base), "metric")
        .select(
            "method", "metric",
            F.when(F.col("base") > 0, change)
            .when(F.col("value") == 0, 0.0)
            .otherwise(float("inf"))
            .alias("improvement"),
        )
    )
