"""Hashed and plug-in embeddings, approximate search."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrank.operators import approximate, embedding, nearest
from sparkrank.sources.scratch import scratch_root, write_bucketed


def plain_hashed(tokens, dim):
    v = np.zeros(dim)
    for t in tokens:
        h = hashlib.md5(t.encode()).hexdigest()
        v[int(h[:8], 16) % dim] += 1 if h[8] < "8" else -1
    n = np.linalg.norm(v)
    return v / n if n else v


@pytest.mark.parametrize("dim", [16, 64])
def test_hashed_embedding(spark, dim):
    texts = {1: "red shoe red", 2: "", 3: "...", 4: "Blue"}
    df = spark.createDataFrame(list(texts.items()), "id int, text string")
    rows = {r["id"]: r["embedding"] for r in embedding.hashed_embedding(df, "id", "text", dim).collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        plain = plain_hashed([w for w in t.lower().split() if w != "..."], dim)
        assert np.allclose(rows[i], plain), i


def test_plug_in_encoder_is_opened_once_per_task(spark):
    def open_encoder():
        state = {"batches": 0}

        def encode(texts):
            state["batches"] += 1
            assert len(texts) <= 7
            return np.array([[len(t), state["batches"]] for t in texts])

        return encode

    df = spark.range(50).select("id", F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text")).coalesce(1)
    rows = embedding.embed(df, "text", open_encoder, batch_size=7).collect()
    assert [r["embedding"][0] for r in sorted(rows)] == [float(i) for i in range(50)]
    assert max(r["embedding"][1] for r in rows) == 8.0


def test_stats_and_preview(spark):
    df = spark.createDataFrame([(2, [1.0, 2.0, 3.0]), (1, [4.0, 5.0, 6.0])], "id int, embedding array<double>")
    assert tuple(embedding.embedding_stats(df).first()) == (2, 3, 3, 6)
    assert [r["value"] for r in embedding.embedding_preview(df, 2).collect()] == [4.0, 5.0]


def clusters(rng, n, per, dim, noise):
    centres = rng.normal(size=(n, dim))
    points = np.repeat(centres, per, axis=0) + noise * rng.normal(size=(n * per, dim))
    return centres, points


def tables(spark, points, queries, bits, bands):
    dim = points.shape[1]
    v = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, embedding array<double>")
    vectors = write_bucketed(v, scratch_root(spark), ["id"])
    q = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(queries)], "query_id bigint, embedding array<double>")
    origin = approximate.centre(vectors, dim)
    coded = write_bucketed(approximate.band_codes(vectors, dim, bits, bands, origin=origin), scratch_root(spark), ["id"])
    return vectors, q, coded, approximate.band_codes(q, dim, bits, bands, key="query_id", origin=origin)


@pytest.mark.parametrize("query_bytes", [1 << 27, 0])
def test_planted_clusters_are_found(spark, query_bytes):
    rng = np.random.default_rng(1)
    centres, points = clusters(rng, 40, 25, 32, 0.15)
    vectors, q, bands, q_bands = tables(spark, points, centres, 8, 16)
    approx = approximate.search_vector_approx(vectors, bands, q, q_bands, 10, query_bytes=query_bytes)
    exact = nearest.search_vector(vectors, q, 10)
    pairs = approximate.shared_bands(bands, q_bands)
    facts = approximate.recall_and_share(approx, exact, pairs, len(points) * len(centres)).first()
    assert facts["recall"] >= 0.95 and facts["candidate_share"] <= 0.3, facts
    scores = {(r["query_id"], r["id"]): r["score"] for r in exact.collect()}
    for r in approx.collect():
        assert scores.get((r["query_id"], r["id"]), r["score"]) == r["score"]


def test_candidate_limit_and_exact_fallback(spark):
    rng = np.random.default_rng(2)
    centres, points = clusters(rng, 6, 30, 16, 0.05)
    vectors, q, bands, q_bands = tables(spark, points, np.vstack([centres[:3], -100 * np.ones((1, 16))]), 10, 4)
    assert approximate.search_vector_approx(vectors, bands, q, q_bands, 5, num_candidates=5).count() == 20
    with pytest.raises(ValueError):
        approximate.search_vector_approx(vectors, bands, q, q_bands, 5, num_candidates=4)
    # more rows than any cluster holds: every query falls back to the exact search
    few = approximate.search_vector_approx(vectors, bands, q, q_bands, 170)
    exact = nearest.search_vector(vectors, q, 170)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, exact.collect()))


def test_hot_code_stays_spread(spark):
    """A code that most vectors share: the band table is not shuffled by it."""
    points = np.vstack([np.ones((300, 8)), np.random.default_rng(3).normal(size=(100, 8))])
    vectors, q, bands, q_bands = tables(spark, points, points[:2], 6, 4)
    plan = approximate.shared_bands(bands, q_bands)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]
    hits = approximate.search_vector_approx(vectors, bands, q, q_bands, 4).collect()
    assert [(r["id"], r["score"]) for r in sorted(hits, key=lambda r: (r["query_id"], r["rank"]))] == [(i, 1.0) for i in range(4)] * 2
