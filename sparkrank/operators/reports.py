"""Comparison tables: hits with document columns, grids by rank, metric and chart tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.functions.sizing import broadcast_if_within
from sparkrank.operators.metrics import METRICS, improvements, long_form
from sparkrank.sources.schema import HIT_FIELDS

COMPARED = ("bm25", "vector", "hybrid")


def tag(hits: DataFrame, method: str) -> DataFrame:
    return hits.select("query_id", F.lit(method).alias("method"), "id", "score", "rank")


def compare_methods(hits: DataFrame, top_k: int = 5, methods: tuple[str, ...] = COMPARED) -> DataFrame:
    """The first ``top_k`` of each method, one table."""
    return hits.where(F.col("method").isin(list(methods)) & (F.col("rank") <= top_k))


def format_hits(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Hits with the columns of their document; only those columns are read."""
    return (
        docs.select("id", *HIT_FIELDS)
        .join(broadcast_if_within(hits), "id")
        .withColumnRenamed("method", "search_type")
    )


def _shown_score(digits: int) -> Column:
    """Score as text; rounded as a decimal, since scores of few digits often lie between two."""
    return F.round(F.col("score").cast("decimal(18,6)"), digits).cast("string")


def _grid(hits: DataFrame, docs: DataFrame, methods: tuple[str, ...], cell: Column) -> DataFrame:
    titles = docs.select("id", "title").join(broadcast_if_within(hits), "id")
    grid = titles.groupBy("query_id", "rank").pivot("method", list(methods)).agg(F.first(cell))
    return grid.select("query_id", "rank", *[F.coalesce(m, F.lit("-")).alias(m) for m in methods])


def side_by_side(
    hits: DataFrame, docs: DataFrame, width: int = 45, methods: tuple[str, ...] = COMPARED
) -> DataFrame:
    """Rank by method, a cell is ``title | score``; ``-`` where a list is shorter."""
    cell = F.concat(F.substring("title", 1, width), F.lit(" | "), _shown_score(3))
    return _grid(hits, docs, methods, cell)


def side_by_side_report(
    hits: DataFrame, docs: DataFrame, rows: int = 5, width: int = 24, methods: tuple[str, ...] = COMPARED
) -> DataFrame:
    """Five ranks; scores with three decimals for ``vector``, else two."""
    score = F.when(F.col("method") == "vector", _shown_score(3)).otherwise(_shown_score(2))
    cell = F.concat(F.substring("title", 1, width), F.lit(" ("), score, F.lit(")"))
    return _grid(hits.where(F.col("rank") <= rows), docs, methods, cell)


def category_hits(hits: DataFrame, docs: DataFrame, rows: int = 5) -> DataFrame:
    """(query_id, method, category, n, categories): hits per category and distinct categories."""
    placed = docs.select("id", "category").join(
        broadcast_if_within(hits.where(F.col("rank") <= rows).select("query_id", "method", "id")), "id"
    )
    per_category = placed.groupBy("query_id", "method", "category").agg(F.count(F.lit(1)).alias("n"))
    distinct = per_category.groupBy("query_id", "method").agg(F.count("category").alias("categories"))
    return per_category.join(distinct, ["query_id", "method"])


def metrics_grid(summary: DataFrame, baseline: str = "bm25") -> DataFrame:
    """(metric, method, value to 4 decimals, improvement to 1 decimal, NULL for the baseline)."""
    def shown(name: str, digits: int) -> Column:
        # means of tenths lie exactly between two decimals; sums of doubles do not
        return F.round(F.round(name, 9), digits).alias(name)

    values = long_form(summary).select("metric", "method", shown("value", 4))
    change = improvements(summary, baseline).select("metric", "method", shown("improvement", 1))
    return values.join(change, ["metric", "method"], "left")


def chart_by_method(summary: DataFrame, methods: tuple[str, ...]) -> DataFrame:
    """One row per metric, one column per method."""
    grid = long_form(summary).groupBy("metric").pivot("method", list(methods)).agg(F.first("value"))
    return grid.na.fill(0.0, list(methods))


def chart_by_type(by_type: DataFrame, methods: tuple[str, ...], metric: str = "mrr") -> DataFrame:
    """One row per query type, one column per method; 0 where a method is missing."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    grid = by_type.groupBy("query_type").pivot("method", list(methods)).agg(F.first(metric))
    return grid.na.fill(0.0, list(methods))
