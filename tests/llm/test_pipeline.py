"""The pipeline stage by stage against brute force, and one call of every registered query."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sparkrank.llm import packing, pii, quality, queries
from tests.llm.test_dedup import brute_lines
from tests.llm.test_similar import brute_kept, pairs

GIVEN = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The given documents and planted ones: exact copies, edits around 0.8, one vocabulary, personal data, lines."""
    rng = np.random.default_rng(21)
    made, at = [], 10_000_000
    for kind in ("scattered", "appended", "block"):
        made += [(at + i, text) for i, text in pairs(kind, 12, rng)]
        at += 1000
    words = [f"word{x}" for x in range(60)]
    made += [(at + i, " ".join(rng.permutation(words).tolist() * 3)) for i in range(20)]
    made += [(at + 100 + i, made[0][1]) for i in range(5)]
    line = "This line stands in many documents and is long enough."
    made += [(at + 200 + i, f"{line}\nOwn words {i} {' '.join(rng.choice(words, 40))}") for i in range(8)]
    made += [(at + 300, f"IBAN DE89 3704 0044 0532 0130 00 Thanks {' '.join(rng.choice(words, 40))}"), (at + 301, None), (at + 302, "")]
    root = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    rows = [(i, t, "en", "made", len(t or "")) for i, t in made]
    schema = docs.schema
    docs.unionByName(spark.createDataFrame(rows, schema)).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{GIVEN}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    return str(root)


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_every_stage_equals_brute_force(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given, columns = texts_of(docs), docs.columns

    def step(name, df):
        made = corpus_pipeline.kept(stages[name](spark, df, folder))
        found = texts_of(made)
        assert made.columns == columns and made.count() == len(found)
        lengths = made.select("text", "n_chars").collect()
        assert name in ("quality", "near_dedup") or all(n == (None if t is None else len(t)) for t, n in lengths)
        return made, found

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, labels).select("doc_id", "score").collect()}
    good, kept = step("quality", docs)
    assert kept == {i: t for i, t in given.items() if scores[i] >= corpus_pipeline.QUALITY_THRESHOLD}
    planted = [(i, t) for i, t in kept.items() if i >= 10_000_000]
    assert len(planted) > 60

    fresh, lines_left = step("line_dedup", good)
    digests = sorted((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in lines_left.items())
    assert digests == [(i, digest) for i, _, _, digest in brute_lines(list(kept.items()))]

    one, left = step("near_dedup", fresh)
    expected = brute_kept(list(lines_left.items()))
    assert 0 < len(expected) < len(lines_left)
    assert left == {i: lines_left[i] for i in expected}

    clean, masked = step("pii", one)
    assert masked == {i: pii.masked(t) for i, t in left.items()}
    assert not any("DE89" in (t or "") for t in masked.values())

    packed = Counter(tuple(r)[:5] for r in stages["packing"](spark, clean, folder).collect())
    plain, pieces = Tokenizer.from_file(packing.default_tokenizer()), Counter()
    for i, text in masked.items():
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            pieces[i, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert packed == pieces
    assert Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, folder).collect()) == pieces


def test_clashing_names_pass_all_stages(spark, folder):
    """Names that the operators use inside are columns like any other; the last stage has its own columns."""
    clash = ["n_lines", "n_dropped", "_keep", "_row", "_doc", "score", "spans", "_bits", "node", "row"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wide = docs.select("*", *[F.col("doc_id").alias(c) for c in clash])
    plain = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        wide, plain = (corpus_pipeline.kept(stage(spark, df, folder)) for df in (wide, plain))
        assert wide.columns == [*docs.columns, *clash], name
        assert texts_of(wide) == texts_of(plain)
        assert wide.where(" or ".join(f"{c} <> doc_id" for c in clash)).isEmpty()
    last = dict(corpus_pipeline.STAGES)["packing"]
    assert last(spark, wide, folder).count() == last(spark, plain, folder).count()


def test_empty_documents_pass_all_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.kept(stage(spark, docs, folder))
        assert docs.isEmpty()


@pytest.mark.parametrize("name", queries.QUERIES)
def test_every_query_runs(spark, name):
    tables = {"op3_hnsw": "embeddings", "op4_topk": "embeddings", "op7_url_filter": "pages"}
    found = queries.QUERIES[name](spark, GIVEN).collect()
    n = spark.read.parquet(f"{GIVEN}/{tables.get(name, 'documents')}.parquet").count()
    per_query = {"op3_hnsw": n // 20 * 20, "op4_topk": n // 50 * 5}
    if name in ("op5_nbest_pieces", "op10_packing"):
        assert len({r["doc_id"] for r in found}) == n
    elif name in ("op11_source_divergence", "op13_spelling_variants"):
        assert len(found) > 50
    else:
        assert len(found) == per_query.get(name, n)
