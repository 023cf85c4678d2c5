"""Hybrid search: weighted sum and reciprocal rank fusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.functions.ranking import rank_hits, top_k as cut
from sparkrank.functions.sizing import broadcast_if_within
from sparkrank.operators.index import Index
from sparkrank.operators.keyword import best_matches, combined, field_scores

RRF_CONSTANT = 60
RRF_WINDOW = 100


def fuse_linear(
    text_scores: DataFrame,
    vector_hits: DataFrame,
    top_k: int = 10,
    bm25_boost: float = 1.0,
    vector_boost: float = 1.0,
    digits: int = 4,
) -> DataFrame:
    """Top k of ``bm25_boost * text + vector_boost * vector`` over the union of both sides.

    ``text_scores`` holds all text matches. They are not joined in full: each
    match looks up its vector score and only the k best per query and task
    leave the task. The vector hits then enter once more with their vector
    part alone, which is right for those without a text match and never above
    the true sum for the others, whose true sum is already in the first list or
    behind k better ones.
    """
    if bm25_boost < 0 or vector_boost < 0:
        raise ValueError("boosts must not be negative")
    near = vector_hits.select(
        "query_id", "id", (F.col("score") * F.lit(vector_boost)).alias("near")
    )
    matched = text_scores.join(broadcast_if_within(near), ["query_id", "id"], "left").select(
        "query_id", "id",
        F.round(F.col("score") * F.lit(bm25_boost) + F.coalesce("near", F.lit(0.0)), digits).alias("score"),
    )
    return _with_nearest(matched, near, top_k, digits)


def _with_nearest(matched: DataFrame, near: DataFrame, top_k: int, digits: int) -> DataFrame:
    """The best of ``matched`` (query_id, id, score) and ``near`` (query_id, id, near) together."""
    both = rank_hits(matched, top_k).select("query_id", "id", "score").unionByName(
        near.select("query_id", "id", F.round("near", digits).alias("score"))
    )
    return rank_hits(both.groupBy("query_id", "id").agg(F.max("score").alias("score")), top_k)


def search_hybrid(
    index: Index,
    queries: DataFrame,
    vector_hits: DataFrame,
    top_k: int = 10,
    bm25_boost: float = 1.0,
    vector_boost: float = 1.0,
    digits: int = 4,
    matches: DataFrame | None = None,
) -> DataFrame:
    """Weighted sum; the text part is the best field alone. ``vector_hits`` = the k nearest.

    ``matches`` are the ``field_scores`` of the same queries, where they are
    written. Without them the sums are formed where the postings lie and only
    the best of each task leave it; a query table too large for that has its
    matches summed in a join.
    """
    nearest = vector_hits.where(F.col("rank") <= top_k)
    if matches is None:
        if bm25_boost < 0 or vector_boost < 0:
            raise ValueError("boosts must not be negative")
        near = nearest.select("query_id", "id", (F.col("score") * F.lit(vector_boost)).alias("near"))
        best = best_matches(index, queries, top_k, tie_breaker=0.0, digits=digits, boost=bm25_boost, near=near)
        if best is not None:
            return _with_nearest(best.withColumn("score", F.round("score", digits)), near, top_k, digits)
    text = combined(field_scores(index, queries) if matches is None else matches, tie_breaker=0.0)
    return fuse_linear(text, nearest, top_k, bm25_boost, vector_boost, digits)


def fuse_rrf(
    bm25_hits: DataFrame,
    vector_hits: DataFrame,
    top_k: int = 10,
    constant: int = RRF_CONSTANT,
    bm25_window: int = RRF_WINDOW,
    vector_window: int | None = None,
    digits: int = 6,
) -> DataFrame:
    """Sum of 1 / (constant + rank) over both lists, with both ranks kept.

    ``vector_window=10`` gives the behaviour of a search service that returns
    ten rows by default whatever number of neighbours is asked for.
    """
    vector_window = bm25_window if vector_window is None else vector_window
    no_rank = F.lit(None).cast("int")
    ranks = bm25_hits.where(F.col("rank") <= bm25_window).select(
        "query_id", "id", F.col("rank").alias("bm25_rank"), no_rank.alias("vector_rank")
    ).unionByName(
        vector_hits.where(F.col("rank") <= vector_window).select(
            "query_id", "id", no_rank.alias("bm25_rank"), F.col("rank").alias("vector_rank")
        )
    )

    def share(rank: str):
        return F.coalesce(F.lit(1.0) / (F.col(rank) + F.lit(constant)), F.lit(0.0))

    fused = (
        ranks.groupBy("query_id", "id")
        .agg(F.min("bm25_rank").alias("bm25_rank"), F.min("vector_rank").alias("vector_rank"))
        .withColumn("score", F.round(share("bm25_rank") + share("vector_rank"), digits))
    )
    return cut(fused, top_k, ["query_id"], [F.col("score").desc(), F.col("id").asc()])
