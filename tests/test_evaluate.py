"""Metrics, improvements and reports against hand-made lists."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sparkrank.operators import metrics, reports


def evaluate(spark, retrieved, relevant, k=10):
    """Metrics of one query and method as a dict."""
    hits = spark.createDataFrame(
        [("q", "bm25", i, r) for r, i in enumerate(retrieved, 1)],
        "query_id string, method string, id string, rank int",
    )
    qrels = spark.createDataFrame([("q", i) for i in relevant], "query_id string, id string")
    queries = spark.createDataFrame([("q", None)], "query_id string, query_type string")
    rows = metrics.evaluate(hits, qrels, queries, k, ("bm25",)).collect()
    assert len(rows) == 1 and rows[0]["query_type"] == "unknown"
    return tuple(round(rows[0][m], 6) for m in metrics.METRICS)


def test_hand_goldens(spark):
    assert evaluate(spark, "abcd", "bdx", 4) == (0.5, 0.666667, 0.5, 0.498189)
    assert evaluate(spark, "", "a") == (0.0, 0.0, 0.0, 0.0)
    assert evaluate(spark, "abc", "") == (0.0, 0.0, 0.0, 0.0)
    assert evaluate(spark, "a", "a", 10) == (0.1, 1.0, 1.0, 1.0)
    assert evaluate(spark, "xa", "a", 1) == (0.0, 0.0, 0.5, 0.0)
    assert evaluate(spark, "ab", "a", 0)[0] == 0.0


def test_repeated_ids_count_once_in_sets_and_each_time_in_ndcg(spark):
    p, r, rr, ndcg = evaluate(spark, "aab", "ac", 3)
    assert (p, r, rr) == (round(1 / 3, 6), 0.5, 1.0)
    assert ndcg == round((1 + 1 / math.log2(3)) / (1 + 1 / math.log2(3)), 6)


def test_graded_dcg(spark):
    hits = spark.createDataFrame(
        [(1, "bm25", "a", 1), (1, "bm25", "b", 2), (1, "bm25", "c", 3)],
        "query_id int, method string, id string, rank int",
    )
    gains = spark.createDataFrame([(1, "a", 3.0), (1, "b", 2.0)], "query_id int, id string, gain double")
    assert round(metrics.graded_dcg(hits, gains).first()["dcg"], 6) == 4.26186
    assert metrics.graded_dcg(hits, gains, k=1).first()["dcg"] == 3.0


def plain_metrics(retrieved, relevant, k):
    found = set(retrieved[:k]) & relevant
    dcg = sum(1 / math.log2(i + 2) for i, d in enumerate(retrieved[:k]) if d in relevant)
    ideal = sum(1 / math.log2(i + 2) for i in range(min(len(relevant), k)))
    first = next((1 / (i + 1) for i, d in enumerate(retrieved) if d in relevant), 0.0)
    return (
        len(found) / k, len(found) / len(relevant) if relevant else 0.0, first,
        dcg / ideal if ideal else 0.0,
    )


@pytest.mark.parametrize("partitions", [1, 5])
def test_random_lists_and_means(spark, partitions):
    rng = random.Random(9)
    methods = ("bm25", "vector")
    lists = {(q, m): rng.sample(range(30), rng.randint(0, 15)) for q in range(12) for m in methods}
    relevant = {q: set(rng.sample(range(30), rng.randint(0, 6))) for q in range(12)}
    hits = spark.createDataFrame(
        [(q, m, d, r) for (q, m), ids in lists.items() for r, d in enumerate(ids, 1)],
        "query_id int, method string, id int, rank int",
    ).repartition(partitions)
    qrels = spark.createDataFrame(
        [(q, d) for q, ds in relevant.items() for d in ds] * 2, "query_id int, id int"
    )
    queries = spark.createDataFrame([(q, "even" if q % 2 == 0 else None) for q in range(12)], "query_id int, query_type string")
    per_query = metrics.evaluate(hits, qrels, queries, 5, methods).persist()
    rows = {(r["query_id"], r["method"]): tuple(r[m] for m in metrics.METRICS) for r in per_query.collect()}
    expected = {
        key: tuple(round(x, 6) for x in plain_metrics(ids, relevant[key[0]], 5)) for key, ids in lists.items()
    }
    assert rows.keys() == expected.keys()
    for key in rows:
        assert rows[key] == pytest.approx(expected[key], abs=1e-6)
        assert all(0 <= x <= 1 for x in rows[key])
    means = {r["method"]: r["mrr"] for r in metrics.summarize(per_query).collect()}
    assert means["bm25"] == pytest.approx(sum(v[2] for (q, m), v in rows.items() if m == "bm25") / 12, abs=1e-6)
    by_type = metrics.summarize(per_query, ("query_type", "method")).collect()
    assert {r["query_type"] for r in by_type} == {"even", "unknown"}


def test_unknown_method(spark):
    with pytest.raises(ValueError, match="unknown method"):
        metrics.summarize_method(None, "magic")


def summary(spark):
    rows = [
        ("bm25", 0.2, 0.0, 0.0, 0.5), ("vector", 0.3, 0.0, 0.1, 0.25), ("hybrid", 0.1, 0.2, 0.0, 0.5),
    ]
    return spark.createDataFrame(rows, "method string, precision double, recall double, mrr double, ndcg double")


def test_improvements(spark):
    got = {(r["method"], r["metric"]): r["improvement"] for r in metrics.improvements(summary(spark)).collect()}
    assert got[("vector", "precision")] == pytest.approx(50.0)
    assert got[("vector", "recall")] == 0.0
    assert got[("vector", "mrr")] == math.inf
    assert got[("vector", "ndcg")] == -50.0
    assert got[("hybrid", "ndcg")] == 0.0
    assert not any(m == "bm25" for m, _ in got)
    grid = {(r["metric"], r["method"]): r["improvement"] for r in reports.metrics_grid(summary(spark)).collect()}
    assert grid[("precision", "bm25")] is None and grid[("precision", "vector")] == 50.0


def test_charts_fill_missing_methods_with_zero(spark):
    by_type = spark.createDataFrame(
        [("natural", "bm25", 0.5), ("keyword", "vector", 0.25)], "query_type string, method string, mrr double"
    )
    rows = {r["query_type"]: (r["bm25"], r["vector"]) for r in reports.chart_by_type(by_type, ("bm25", "vector")).collect()}
    assert rows == {"natural": (0.5, 0.0), "keyword": (0.0, 0.25)}
    with pytest.raises(ValueError):
        reports.chart_by_type(by_type, ("bm25",), "speed")


def docs_and_hits(spark):
    docs = spark.createDataFrame(
        [(1, "A very long title that goes on and on and on and on", "d1", "x", "b", 1.0, 4.0),
         (2, "Short", "d2", "y", "b", 2.0, None)],
        "id int, title string, description string, category string, brand string, price double, rating double",
    )
    hits = spark.createDataFrame(
        [(7, "bm25", 1, 3.14159, 1), (7, "bm25", 2, 1.5, 2), (7, "vector", 2, 0.98765, 1)],
        "query_id int, method string, id int, score double, rank int",
    )
    return docs, hits


def test_side_by_side(spark):
    docs, hits = docs_and_hits(spark)
    rows = {r["rank"]: r for r in reports.side_by_side(hits, docs).collect()}
    assert rows[1]["bm25"] == "A very long title that goes on and on and on  | 3.142"
    assert rows[1]["vector"] == "Short | 0.988"
    assert rows[2]["vector"] == "-" and rows[2]["hybrid"] == "-"
    report = {r["rank"]: r for r in reports.side_by_side_report(hits, docs).collect()}
    assert report[1]["bm25"] == "A very long title that g (3.14)"
    assert report[1]["vector"] == "Short (0.988)"


def test_format_hits_and_categories(spark):
    docs, hits = docs_and_hits(spark)
    formatted = reports.format_hits(hits, docs)
    assert set(formatted.columns) == {
        "id", "title", "description", "category", "brand", "price", "rating", "score", "search_type",
        "query_id", "rank",
    }
    assert formatted.count() == 3
    rows = {(r["method"], r["category"]): (r["n"], r["categories"]) for r in reports.category_hits(hits, docs).collect()}
    assert rows == {("bm25", "x"): (1, 2), ("bm25", "y"): (1, 2), ("vector", "y"): (1, 1)}


def test_compare_methods_cuts_lists(spark):
    _, hits = docs_and_hits(spark)
    assert reports.compare_methods(hits, 1).count() == 2
    assert reports.compare_methods(hits.withColumn("method", F.lit("hybrid_rrf"))).count() == 0


def test_rollup_tells_null_types_from_totals(spark):
    rows = [("q1", None, "a", 1.0), ("q2", None, "b", 0.0), ("q3", "x", "a", 0.5)]
    table = spark.createDataFrame(rows, "query_id string, query_type string, method string, precision double")
    table = table.selectExpr("*", "precision as recall", "precision as mrr", "precision as ndcg")
    made = {(r["query_type"], r["method"], r["level"]): (r["queries"], r["precision"]) for r in metrics.rollup(table).collect()}
    assert made == {
        (None, "a", 0): (1, 1.0), (None, "b", 0): (1, 0.0), ("x", "a", 0): (1, 0.5),
        (None, None, 1): (2, 0.5), ("x", None, 1): (1, 0.5), (None, None, 3): (3, 0.5),
    }
