"""Inputs that are empty, missing or not finite."""

import pytest
from pyspark.sql import functions as F

from sparkrank.operators import approximate, embedding, ingest, nearest
from sparkrank.plans.workspace import workspace
from sparkrank.sources import standin

VECTORS = "id long, embedding array<float>"
QUERIES = "query_id long, embedding array<float>"


def _vectors(spark, infinite):
    rows = [(i, [1.0, i / 10]) for i in range(50)]
    rows += [(100 + i, [float("inf"), 1.0]) for i in range(infinite)]
    return spark.createDataFrame([*rows, (200, [float("nan"), 1.0]), (201, [0.0, 0.0])], VECTORS).coalesce(1)


@pytest.mark.parametrize("infinite", [0, 1, 12])
@pytest.mark.parametrize("query_bytes", [1, 1 << 20])
def test_infinite_vectors_hide_no_hit(spark, infinite, query_bytes):
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [float("inf"), 0.0])], QUERIES)
    hits = nearest.search_vector(_vectors(spark, infinite), queries, 10, query_bytes=query_bytes).collect()
    assert sorted(r["id"] for r in hits) == list(range(10))
    assert {r["query_id"] for r in hits} == {1}


def test_no_query_no_hit(spark):
    none = spark.createDataFrame([], QUERIES)
    vectors = _vectors(spark, 1)
    assert nearest.search_vector(vectors, none).collect() == []
    bands = approximate.band_codes(vectors, 2)
    none_bands = approximate.band_codes(none, 2, key="query_id")
    assert approximate.search_vector_approx(vectors, bands, none, none_bands).collect() == []


def test_centre_leaves_out_what_is_not_finite(spark):
    assert approximate.centre(_vectors(spark, 3), 2) == pytest.approx([50 / 51, sum(range(50)) / 510])


def test_missing_title_keeps_the_text(spark):
    rows = spark.createDataFrame([(1, None, "b"), (2, "a", None)], "id long, title string, description string")
    texts = rows.orderBy("id").select(embedding.combined_text().alias("t")).collect()
    assert [r["t"] for r in texts] == [". b", "a. "]


def test_ingest_rejects_infinite_and_unordered_repeats(spark, tmp_path):
    schema = (
        "id string, title string, description string, category string, price double, brand string, "
        "rating double, attributes map<string,string>, product_type string, embedding array<float>"
    )
    row = lambda i, v: (i, "t", "d", "c", 1.0, "b", 4.0, {}, "p", v)
    rows = [row("a", [1.0, 0.0]), row("a", [0.0, 1.0]), row("b", [float("inf"), 0.0]), row("c", [1.0, 1.0])]
    ingest.ingest(spark.createDataFrame(rows, schema), str(tmp_path), 1, 2)
    log = ingest.read_log(spark, str(tmp_path))
    reasons = sorted({(r["id"], r["reason"]) for r in ingest.rejects(log).collect()})
    assert reasons == [("a", "duplicate id"), ("b", "not finite")]
    assert [r["id"] for r in ingest.current_catalog(log).collect()] == ["c"]


def test_short_passages_are_found(spark):
    sf_dir = "/root/testdata/sf0.001"
    ws = workspace(spark, sf_dir)
    word = ws.docs.orderBy("id").select(F.split("title", " ")[0].alias("w")).first()["w"]
    asked = spark.createDataFrame([(1, word), (2, ""), (3, None)], "query_id long, query string")
    found = standin.passage_qrels(ws.docs, asked, ws.index).collect()
    texts = {r["id"]: f"{r['title']}\n{r['description']}" for r in ws.docs.collect()}
    assert {r["id"] for r in found if r["query_id"] == 1} == {i for i, t in texts.items() if word in t}
    assert {r["id"] for r in found if r["query_id"] == 2} == set(texts)


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 20])
def test_many_short_passages_in_any_number_of_passes(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(standin, "SHORT_BYTES", block_bytes)
    texts = {1: "a\nab abc", 2: "", 3: "the of\x00", 4: "ünï 日本\nof", 5: "aaaa", 6: None}
    asked = {10: "a", 11: "ab", 12: "aa", 13: "", 14: "日", 15: "ï 日", 16: "\x00", 17: "zz", 18: "a", 19: "\n"}
    body = spark.createDataFrame(list(texts.items()), "id long, body string").withColumn("body", F.coalesce("body", F.lit("")))
    short = spark.createDataFrame(list(asked.items()), "query_id int, query string")
    found = standin._short_hits(body, short)
    got = sorted(tuple(r) for r in found.collect())
    assert got == sorted((q, i) for q, w in asked.items() for i, t in texts.items() if w in (t or ""))
    assert [t.dataType.simpleString() for t in found.schema] == ["int", "bigint"]
    assert standin._short_hits(body, short.limit(0)) is None


def test_row_wise_queries_do_not_shuffle(spark):
    import __spark_entry__ as entry

    for key, exchanges in {"tokens": 0, "combined_text": 0, "filter_keyword": 0, "facet_counts": 1}.items():
        df = entry.queries()[key](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= exchanges, key


def test_buckets_follow_the_size_of_the_files(spark, tmp_path, monkeypatch):
    import os

    from sparkrank.sources import scratch

    path = str(tmp_path / "t")
    spark.range(1000).repartition(3).write.parquet(path)
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.startswith("part"))
    assert scratch.bucket_count(spark, path) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(scratch, "BUCKET_BYTES", size / 100)
    assert scratch.bucket_count(spark, path) == 100


def test_buckets_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    """Small rows compress well, so bytes alone would leave millions of them in a bucket."""
    from sparkrank.sources import scratch

    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("'same' AS id").write.parquet(path)
    monkeypatch.setattr(scratch, "BUCKET_ROWS", 10)
    assert scratch.bucket_count(spark, path) == 100


def test_changed_files_give_a_new_workspace(spark, tmp_path):
    from sparkrank.plans.workspace import INPUTS

    for name in INPUTS:
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(3).write.parquet(f"{tmp_path}/{name}.parquet")
    first = workspace(spark, str(tmp_path))
    assert workspace(spark, str(tmp_path)) is first
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").limit(2).write.mode("append").parquet(f"{tmp_path}/part.parquet")
    assert workspace(spark, str(tmp_path)) is not first
