"""The inverted-file index against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrank.operators import cells, nearest
from sparkrank.sources.scratch import scratch_root


def table(spark, points, key="id"):
    rows = [(i, p) for i, p in enumerate(np.asarray(points, float).tolist())]
    return spark.createDataFrame(rows, f"{key} long, embedding array<double>").repartition(4)


def lists(hits):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 6)) for r in hits.collect())


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16)) * 4
    points = np.vstack([c + rng.normal(size=(60, 16)) * 0.3 for c in centres])
    points = np.vstack([points, np.zeros((2, 16)), np.full((1, 16), np.nan), points[:3], points[:3] * 5])
    return table(spark, points), table(spark, np.vstack([centres, points[5], np.zeros(16)]), "query_id")


@pytest.mark.parametrize("query_bytes", [nearest.QUERY_BYTES, 4000])
def test_bounded_search_is_exact_and_skips_cells(spark, clustered, query_bytes):
    vectors, queries = clustered
    index = cells.build_cells(vectors, scratch_root(spark), cells=24)
    report = []
    made = cells.search_bounded(index, queries, 7, report=report, query_bytes=query_bytes)
    assert lists(made) == lists(nearest.search_vector(vectors, queries, 7))
    assert max(report) < 0.5 and (len(report) > 1) == (query_bytes == 4000)


def test_bounded_search_where_nothing_can_be_skipped(spark):
    rng = np.random.default_rng(4)
    vectors, queries = table(spark, rng.normal(size=(400, 24))), table(spark, rng.normal(size=(9, 24)), "query_id")
    index = cells.build_cells(vectors, scratch_root(spark))
    assert lists(cells.search_bounded(index, queries, 500)) == lists(nearest.search_vector(vectors, queries, 500))
    assert lists(cells.search_bounded(index, queries, 5)) == lists(nearest.search_vector(vectors, queries, 5))


def test_probing_all_cells_is_exact_and_few_have_recall(spark, clustered):
    vectors, queries = clustered
    index = cells.build_cells(vectors, scratch_root(spark), cells=24)
    exact = lists(nearest.search_vector(vectors, queries, 10))
    assert lists(cells.search_cells(index, queries, 10, probes=24)) == exact
    few = {(q, i) for q, _, i, _ in lists(cells.search_cells(index, queries, 10, probes=3))}
    assert len(few & {(q, i) for q, _, i, _ in exact}) >= 0.9 * len(exact)


def test_only_probed_folders_are_read(spark, clustered):
    vectors, queries = clustered
    index = cells.build_cells(vectors, scratch_root(spark), cells=24)
    plan = cells._read(index, np.array([3, 5]))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cast(cell" in shown or "PartitionFilters: [cell" in shown
    assert {f.split("cell=")[1].split("/")[0] for f in index.vectors.inputFiles()} > {"3", "5"}
    assert {r["cell"] for r in plan.select("cell").distinct().collect()} == {3, 5}


def test_opened_again_and_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(cells, "FILE_ROWS", 10)
    points = np.vstack([np.tile([1.0, 0, 0, 0], (200, 1)), np.eye(4)[1:]])
    path = scratch_root(spark)
    cells.build_cells(table(spark, points), path, cells=4)
    index = cells.open_cells(spark, path)
    assert index.sizes.sum() == 203 and index.vectors.count() == 203
    hot = index.vectors.where(F.col("cell") == int(index.sizes.argmax()))
    assert len(hot.inputFiles()) > 1
    queries = table(spark, [[1.0, 0.1, 0, 0]], "query_id")
    assert lists(cells.search_bounded(index, queries, 3)) == [(0, n, n - 1, lists(cells.search_bounded(index, queries, 1))[0][3]) for n in (1, 2, 3)]


def test_empty_sides(spark, clustered):
    vectors, queries = clustered
    index = cells.build_cells(vectors.limit(0), scratch_root(spark))
    assert cells.search_cells(index, queries).collect() == cells.search_bounded(index, queries).collect() == []
    full = cells.build_cells(vectors, scratch_root(spark))
    assert cells.search_cells(full, queries.limit(0)).collect() == []
