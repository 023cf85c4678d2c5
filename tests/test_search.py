"""Keyword, vector and hybrid search against plain Python on small catalogs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrank.functions.porter2 import stem_word
from sparkrank.functions.text import STOP_WORDS
from sparkrank.operators import fusion, keyword, nearest
from sparkrank.operators.index import build_index, open_index, update_index
from sparkrank.sources.scratch import scratch_root

WORDS = "running shoes laptop phones cameras cotton dresses yoga mats blender the of quick fox".split()


def make_docs(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        title = " ".join(rng.choices(WORDS, k=rng.randint(0, 4)))
        body = " ".join(rng.choices(WORDS, k=rng.randint(0, 12)))
        rows.append((i, title, body))
    return rows


def brute_bm25(docs, queries, weights, tie, stem, k):
    def analyse(text):
        kept = [t for t in text.lower().split() if t not in STOP_WORDS]
        return [stem_word(t) for t in kept] if stem else kept

    out = {}
    fields = {"title": 1, "description": 2}
    toks = {f: {d[0]: analyse(d[p]) for d in docs} for f, p in fields.items()}
    for qid, text in queries:
        scored = []
        for d in docs:
            parts = []
            for f, w in weights.items():
                lengths = [len(t) for t in toks[f].values() if t]
                n, avgdl = len(lengths), sum(lengths) / len(lengths)
                mine, s = toks[f][d[0]], 0.0
                for t in analyse(text):
                    tf = mine.count(t)
                    if not tf:
                        continue
                    df = sum(t in x for x in toks[f].values())
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    s += w * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(mine) / avgdl))
                parts.append(s)
            if any(parts):
                best = max(parts)
                scored.append((round(best + tie * (sum(parts) - best), 4), d[0]))
        scored.sort(key=lambda x: (-x[0], x[1]))
        out[qid] = [(i, s) for s, i in scored[:k]]
    return out


def as_lists(hits, digits=4):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["id"], round(r["score"], digits)))
    return out


QUERIES = [
    ("q1", "laptop cotton laptop"), ("q2", "the running of shoes"), ("q3", "the of"),
    ("q4", "unknownword"), ("q5", "quick phone camera"), ("q6", ""),
]


@pytest.fixture(scope="module")
def docs():
    return make_docs(60)


def index_of(spark, docs, **kw):
    df = spark.createDataFrame(docs, "id bigint, title string, description string")
    return build_index(df, scratch_root(spark), **kw)


@pytest.mark.parametrize("stem", [True, False])
@pytest.mark.parametrize("tie", [0.3, 0.0])
def test_bm25_equals_brute_force(spark, docs, stem, tie):
    index = index_of(spark, docs, stem=stem)
    queries = spark.createDataFrame(QUERIES, "query_id string, query string")
    hits = keyword.search_keyword(index, queries, 7, tie_breaker=tie)
    expected = brute_bm25(docs, QUERIES, {"title": 2.0, "description": 1.0}, tie, stem, 7)
    assert as_lists(hits) == {q: h for q, h in expected.items() if h}


def test_bm25_fields_argument_and_shuffled_query_side(spark, docs):
    index = index_of(spark, docs, stem=False, buckets=3)
    queries = spark.createDataFrame(QUERIES, "query_id string, query string")
    only_title = keyword.search_keyword(index, queries, 5, fields={"title": 1.0})
    assert as_lists(only_title) == {
        q: h for q, h in brute_bm25(docs, QUERIES, {"title": 1.0}, 0.3, False, 5).items() if h
    }
    wide = keyword.keyword_scores(index, queries)
    salted = keyword.keyword_scores(index, queries, broadcast_bytes=0)
    rounded = ["query_id", "id", F.round("score", 9).alias("score")]
    assert sorted(map(tuple, wide.select(*rounded).collect())) == sorted(
        map(tuple, salted.select(*rounded).collect())
    )


def test_postings_stay_in_place(spark, docs):
    """Scoring shuffles only the k best per task, never the postings."""
    index = index_of(spark, docs, stem=False)
    queries = spark.createDataFrame(QUERIES, "query_id string, query string")
    plan = keyword.search_keyword(index, queries, 7)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("BroadcastHashJoin [field")[0]
    assert above.count("Exchange") == 1
    assert "WindowGroupLimit" in above and "Bucketed: true" in plan


def test_only_folders_of_the_tokens_are_read(spark, docs):
    index = index_of(spark, docs, stem=False, shards=64)
    queries = spark.createDataFrame(QUERIES[:1], "query_id string, query string")
    [found] = index.postings_of(keyword.query_terms(index, queries))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard" in plan or "PartitionFilters: [isnotnull(shard" in plan
    assert found.select("shard").distinct().count() < index.postings.select("shard").distinct().count()
    one = index_of(spark, docs, stem=False, shards=1)
    both = [as_lists(keyword.search_keyword(i, queries, 9)) for i in (index, one)]
    assert both[0] == both[1] and both[0]


def test_index_after_upserts_equals_rebuild(spark, docs):
    """Two batches: replaced, added, removed and empty texts; statistics and hits are those of a rebuild."""
    schema = "id bigint, title string, description string"
    now = {d[0]: d for d in docs}
    index = index_of(spark, docs, stem=False)
    queries = spark.createDataFrame(QUERIES, "query_id string, query string")
    ids = sorted(now)
    batches = [
        ([(i, f"{now[i][1]} red", None) for i in ids[:9]] + [(9001, "red wool", "blue"), (9002, "", None)], ids[9:14]),
        ([(ids[0], "wool", "red red"), (9001, "blue", "blue cotton")], [ids[1], 9002]),
        ([], []),
    ]
    for new, removed in batches:
        old = [now[i] for i in {d[0] for d in new} | set(removed) if i in now]
        made = [spark.createDataFrame(rows, schema) for rows in (old, new)]
        index = update_index(index, *made, scratch_root(spark))
        now.update({d[0]: d for d in new})
        for i in removed:
            now.pop(i, None)
        fresh = index_of(spark, list(now.values()), stem=False)
        for name in ("term_stats", "field_stats"):
            a, b = (sorted(map(tuple, getattr(i, name).collect())) for i in (index, fresh))
            assert a == b, name
        again = open_index(spark, index.path)
        wanted = as_lists(keyword.search_keyword(fresh, queries, 8))
        assert wanted and as_lists(keyword.search_keyword(index, queries, 8)) == wanted
        assert as_lists(keyword.search_keyword(again, queries, 8)) == wanted
    assert len(index.older) == 3


def test_keyword_and_hybrid_from_one_pass(spark, docs):
    index = index_of(spark, docs, stem=False)
    queries = spark.createDataFrame(QUERIES, "query_id string, query string")
    matches = keyword.field_scores(index, queries).persist()
    assert as_lists(keyword.search_keyword(index, queries, 5, matches=matches)) == as_lists(keyword.search_keyword(index, queries, 5))
    near = spark.createDataFrame([(QUERIES[0][0], docs[0][0], 0.9, 1)], "query_id string, id bigint, score double, rank int")
    made = [as_lists(fusion.search_hybrid(index, queries, near, 5, matches=m)) for m in (matches, None)]
    assert made[0] == made[1]


@pytest.mark.parametrize("fields", [None, {"title": 0.0, "description": 1.0}])
def test_tasks_return_only_their_best_matches(spark, monkeypatch, fields):
    """Ties, repeated and missing ids and queries: the hits of all matches, of which k per query and task are made."""
    monkeypatch.setattr(keyword, "BLOCK_CELLS", 50)
    rows = [(f"d{i:03d}", "quick fox" if i % 3 else "laptop", "yoga mats " * (i % 4)) for i in range(90)]
    rows += [(None, "quick laptop", "fox"), (None, "fox", "mats"), ("d001", "laptop laptop", "yoga")]
    index = build_index(
        spark.createDataFrame(rows, "id string, title string, description string"), scratch_root(spark), stem=False, buckets=2
    )
    asked = [("a", "quick fox"), ("b", "laptop yoga"), (None, "mats"), ("a", "fox"), ("c", "nowhere"), ("d", "")]
    queries = spark.createDataFrame(asked, "query_id string, query string")
    all_matches = keyword.field_scores(index, queries, fields)
    best = keyword.best_matches(index, queries, 4, fields)
    assert best.count() <= 2 * 3 * 4 < all_matches.count()
    wanted = keyword.search_keyword(index, queries, 4, fields, matches=all_matches).collect()
    assert wanted and sorted(map(str, keyword.search_keyword(index, queries, 4, fields).collect())) == sorted(map(str, wanted))
    assert keyword.best_matches(index, queries, 4, fields, term_bytes=0) is None
    near = spark.createDataFrame(
        [("a", "d004", 0.9, 1), ("a", "d080", 5.0, 2), ("b", "new", 7.0, 1), ("c", "d001", 0.5, 1)],
        "query_id string, id string, score double, rank int",
    )
    if fields is None:
        made = [fusion.search_hybrid(index, queries, near, 4, matches=m).collect() for m in (None, all_matches)]
        assert made[0] and sorted(map(str, made[0])) == sorted(map(str, made[1]))


def brute_knn(vectors, queries, k):
    out = {}
    for qid, q in queries:
        scored = []
        for i, v in vectors:
            if not np.linalg.norm(v) or not np.linalg.norm(q):
                continue
            cos = float(np.dot(q, v) / np.linalg.norm(q) / np.linalg.norm(v))
            scored.append((math.floor((1 + cos) / 2 * 1e6 + 0.5) / 1e6, i))
        scored.sort(key=lambda x: (-x[0], x[1]))
        if scored:
            out[qid] = [(i, round(s, 6)) for s, i in scored[:k]]
    return out


@pytest.mark.parametrize("query_bytes", [1 << 27, 2000])
@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_knn_equals_brute_force(spark, query_bytes, partitions):
    rng = np.random.default_rng(5)
    vectors = [(f"d{i:03d}", rng.normal(size=8).round(2).tolist()) for i in range(150)]
    vectors += [(f"e{i:03d}", vectors[0][1]) for i in range(60)]  # a hot copy
    vectors.append(("zero", [0.0] * 8))
    queries = [(f"q{i}", rng.normal(size=8).round(2).tolist()) for i in range(9)]
    queries += [("same", vectors[0][1]), ("none", [0.0] * 8)]
    v = spark.createDataFrame(vectors, "id string, embedding array<double>").repartition(partitions)
    q = spark.createDataFrame(queries, "query_id string, embedding array<double>")
    hits = nearest.search_vector(v, q, 12, query_bytes=query_bytes)
    assert as_lists(hits, 6) == brute_knn(vectors, queries, 12)


def test_knn_in_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    ids = np.arange(500)
    top = nearest._TopK(nearest._unit_rows(rng.normal(size=(4, 6)))[1], 5, 3)
    whole = nearest._TopK(top.q, 5, 3)
    vectors = nearest._unit_rows(rng.normal(size=(500, 6)).round(1))[1]
    whole.add(ids, vectors)
    monkeypatch.setattr(nearest, "BLOCK_CELLS", 12)
    top.add(ids, vectors)
    top.prune()
    whole.prune()
    assert len(whole.query) == 20
    assert top.query.tolist() == whole.query.tolist()
    assert top.ids.tolist() == whole.ids.tolist()


def test_knn_scores_of_known_angles(spark):
    v = spark.createDataFrame([(1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, [-1.0, 0.0])], "id int, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<float>")
    assert as_lists(nearest.search_vector(v, q, 3), 6) == {1: [(1, 1.0), (2, 0.5), (3, 0.0)]}


def test_wrong_dimension_fails(spark):
    v = spark.createDataFrame([(1, [2.0, 0.0, 1.0])], "id int, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<float>")
    with pytest.raises(Exception, match="vector is not of length 2"):
        nearest.search_vector(v, q, 3).collect()


def hits_of(spark, rows):
    return spark.createDataFrame(rows, "query_id int, id string, score double, rank int")


def test_best_fields(spark):
    row = spark.range(1).select(
        keyword.best_fields([F.lit(3.0), F.lit(1.0)], 0.3).alias("a"),
        keyword.best_fields([F.lit(3.0), F.lit(1.0)], 0.0).alias("b"),
    ).first()
    assert (round(row["a"], 9), row["b"]) == (3.3, 3.0)


def test_linear_fusion_of_known_lists(spark):
    text = spark.createDataFrame([(1, "a", 3.0), (1, "b", 1.0)], "query_id int, id string, score double")
    near = hits_of(spark, [(1, "b", 0.9, 1), (1, "c", 0.8, 2)])
    assert as_lists(fusion.fuse_linear(text, near, 10)) == {1: [("a", 3.0), ("b", 1.9), ("c", 0.8)]}
    with pytest.raises(ValueError):
        fusion.fuse_linear(text, near, 10, vector_boost=-1.0)


def test_linear_fusion_equals_full_outer_join(spark):
    """The early cut to k per task changes nothing, ties included."""
    rng = random.Random(3)
    text = [(q, i, float(rng.randint(0, 4))) for q in range(4) for i in rng.sample(range(80), 60)]
    near = [
        (q, i, rng.choice([0.5, 1.0]), r + 1)
        for q in range(5) for r, i in enumerate(rng.sample(range(80), 6))
    ]
    full = {}
    for q, i, s in text:
        full[(q, i)] = 0.5 * s
    for q, i, s, _ in near:
        full[(q, i)] = full.get((q, i), 0.0) + 2.0 * s
    expected = {}
    for q in range(5):
        best = sorted(((-s, i) for (qq, i), s in full.items() if qq == q))[:6]
        expected[q] = [(i, -s) for s, i in best]
    got = fusion.fuse_linear(
        spark.createDataFrame(text, "query_id int, id int, score double").repartition(7),
        spark.createDataFrame(near, "query_id int, id int, score double, rank int"),
        6, bm25_boost=0.5, vector_boost=2.0,
    )
    assert as_lists(got) == expected


def test_rrf_of_known_lists(spark):
    bm25 = hits_of(spark, [(1, "a", 9.0, 1), (1, "b", 8.0, 2)])
    near = hits_of(spark, [(1, "b", 0.9, 1), (1, "c", 0.8, 2)])
    rows = {r["id"]: r for r in fusion.fuse_rrf(bm25, near).collect()}
    assert {i: r["score"] for i, r in rows.items()} == {"b": 0.032522, "a": 0.016393, "c": 0.016129}
    assert [(rows[i]["bm25_rank"], rows[i]["vector_rank"]) for i in "bac"] == [(2, 1), (1, None), (None, 2)]
    swapped = {r["id"]: r["score"] for r in fusion.fuse_rrf(near, bm25).collect()}
    assert swapped == {i: r["score"] for i, r in rows.items()}


def test_rrf_windows(spark):
    bm25 = hits_of(spark, [(1, "a", 9.0, 1), (1, "b", 8.0, 2)])
    near = hits_of(spark, [(1, "c", 0.9, 1), (1, "d", 0.8, 2)])
    ids = {r["id"] for r in fusion.fuse_rrf(bm25, near, vector_window=1).collect()}
    assert ids == {"a", "b", "c"}
