"""The two vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrank.llm import hnsw, topk
from sparkrank.llm.queries import ORACLES
from sparkrank.llm.vectors import divisible

SCHEMA = "vec_id long, embedding array<float>, rank int, score double"
NAN, INF = float("nan"), float("inf")
ODD = [
    (None, [1.0, 0.0]), (100, None), (200, [NAN, 1.0]), (300, [INF, 1.0]), (400, [None, 1.0]), (500, [0.0, 0.0]),
    (600, [1.0, 2.0, 3.0]), (700, [2.0, 0.0, 1.0]), (800, []),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], SCHEMA)


def brute(rows, by, k, whole, zero):
    usable = {(i, tuple(np.float32(x).item() for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    if whole:
        usable = {(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in usable}
    if not zero:
        usable = {(i, v) for i, v in usable if any(v)}
    out = []
    for q, a in sorted(u for u in usable if u[0] % by == 0):
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(a) == len(b))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def clustered(n, dim, rng):
    centres = rng.normal(size=(6, dim))
    v = centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, dim))
    v[: n // 3] = v[0]  # a third of all rows is one vector
    return [(i, x) for i, x in zip(rng.permutation(n).tolist(), np.round(v, 3).tolist(), strict=True)]


@pytest.mark.parametrize("lengths", ["equal", "spread", "huge"])
def test_topk_equals_brute_force(spark, lengths):
    rng = np.random.default_rng(4)
    rows = clustered(500, 8, rng)
    if lengths != "equal":
        power = 3.0 if lengths == "spread" else 4.0
        rows = [(i, [x * float(np.float32(np.exp(power * ((i * 7 % 10) / 10 - 0.5)))) for x in v]) for i, v in rows]
    if lengths == "huge":
        rows = [(i, [x * 1e6 for x in v]) for i, v in rows]
    found = topk.search(frame(spark, [*rows, *ODD, rows[3]]), divisible(50), head=40, block=7)
    expected = brute([*rows, *ODD], 50, 5, True, True)
    assert lengths != "huge" or max(s for *_, s in expected) > 2**53
    assert sorted(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("copies", [2, 12])
def test_topk_of_an_id_with_different_long_vectors(spark, copies):
    """The rows of a query's own id stand above all others, as the SQL has it they are no hits."""
    duckdb = pytest.importorskip("duckdb")
    rng = np.random.default_rng(11)
    rows = [(i, np.round(rng.normal(size=6), 3).tolist()) for i in range(1, 400)]
    rows += [(50, [9.0 + c, *np.round(rng.normal(size=5), 3).tolist()]) for c in range(copies)]
    given = frame(spark, rows)
    embeddings = given.toArrow()  # noqa: F841
    expected = duckdb.sql(ORACLES["op4_topk"]).fetchall()
    found = sorted(map(tuple, topk.search(given, divisible(50), head=40).collect()))
    assert found == sorted(expected) and len(found) == 5 * 7


def test_buckets_prune_but_lose_nothing():
    rng = np.random.default_rng(5)
    p = np.floor(256 * rng.normal(size=(3000, 16)) * np.exp(rng.normal(size=(3000, 1))))
    near = np.floor(p[:40] + rng.normal(size=(40, 16)) * 3)
    queries = topk.Queries(np.arange(10_000, 10_040), near)
    order = np.argsort(-np.sqrt((p**2).sum(axis=1)))
    p, ids = p[order], np.arange(3000)[order]
    lengths = np.sqrt((p**2).sum(axis=1))
    seeded = topk._seed(queries, p[:200], 5)
    pruned = False
    hits = []
    for at in range(0, 3000, 500):
        own = slice(at, at + 500)
        found = topk.search_bucket(seeded, ids[own], p[own], lengths[own], 5)
        pruned |= len(np.unique(found[0])) < 40
        hits.append(found)
    number, found, score = topk.top_rows(*(np.concatenate(c) for c in zip(*hits, strict=True)), 5)
    exact = near @ p.T
    for q in range(40):
        best = sorted(zip(-exact[q], ids, strict=True))[:5]
        assert [(-int(s), int(i)) for s, i in zip(score[number == q], found[number == q], strict=True)] == [(int(s), int(i)) for s, i in best]
    assert pruned


def test_hnsw_small_tables_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = clustered(300, 6, rng)
    found = hnsw.search(frame(spark, [*rows, *ODD, rows[5]]), divisible(20), k=20, shard=100, block=5)
    expected = brute([*rows, *ODD], 20, 20, False, False)
    got = sorted(map(tuple, found.collect()))
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected])
    assert np.mean([g[2] == e[2] for g, e in zip(got, expected, strict=True)]) > 0.99


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_on_the_given_vectors(spark, spread):
    """Also with vectors of different lengths, where the largest product is not the nearest angle."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    scale = F.exp(spread * F.sin(F.col("vec_id").cast("double")))
    given = given.withColumn("embedding", F.transform("embedding", lambda x: (x * scale).cast("float")))
    table = given.orderBy("vec_id").toPandas()
    v = np.array(table["embedding"].tolist(), float)
    found = hnsw.search(given, divisible(20), k=20, shard=1000).toPandas()
    hit = 0
    for q, own in found.groupby("query_id"):
        scores = v @ v[q]
        assert np.allclose(own.sort_values("rank")["score"], scores[own.sort_values("rank")["vec_id"]], rtol=1e-12)
        scores[q] = -np.inf
        hit += len(set(np.argsort(-scores)[:20]) & set(own["vec_id"]))
    assert len(found) == 20 * 100 and hit / len(found) >= 0.95


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_of_full_shards(spark, spread):
    """Production parameters on three full shards: given vectors, perturbed and of equal or unequal lengths."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas()
    base, rng, n = np.array(given["embedding"].tolist(), float), np.random.default_rng(12), 3 * hnsw.SHARD
    v = base[rng.integers(0, len(base), n)]
    v = v + rng.normal(size=v.shape) * 0.5 * v.std()
    v = (v * np.exp(spread * np.sin(np.arange(n)))[:, None]).astype(np.float32)
    rows = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<float>")
    assert hnsw.build_index(rows, 20).count() == 3
    found = hnsw.search(rows, divisible(20), k=20).toPandas()
    w, hit = v.astype(float), 0
    for q, own in found.groupby("query_id"):
        scores = w @ w[q]
        scores[q] = -np.inf
        hit += len(set(np.argpartition(-scores, 20)[:20]) & set(own["vec_id"]))
    assert len(found) == 20 * -(-n // 20) and hit / len(found) >= 0.9


def test_no_rows(spark):
    none = frame(spark, [])
    assert topk.search(none, divisible(50)).count() == 0
    assert hnsw.search(none, divisible(20)).count() == 0
    assert hnsw.search(frame(spark, [(20, [1.0, 0.0])]), divisible(20)).count() == 0
