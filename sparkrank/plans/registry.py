"""The registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.functions.text import stem_words
from sparkrank.operators import (
    approximate, cells, embedding, encoders, fusion, generation, ingest, keyword, metrics, nearest, reports,
)
from sparkrank.operators import index as indexing
from sparkrank.plans.workspace import workspace
from sparkrank.sources import catalog, standin
from sparkrank.sources.scratch import scratch_root
from sparkrank.streaming.ingest_stream import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
DIM = 64

REGISTRY: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Integers as BIGINT and arrays of double, so that engines agree on types."""
    for f in df.schema.fields:
        if isinstance(f.dataType, T.IntegerType):
            df = df.withColumn(f.name, F.col(f.name).cast("bigint"))
        elif isinstance(f.dataType, T.FloatType):
            df = df.withColumn(f.name, F.col(f.name).cast("double"))
    return df


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits``: sums differ in the last bits from engine to engine."""
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            df = df.withColumn(f.name, F.round(f.name, digits))
    return df


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = lambda spark, sf_dir: _plain(fn(spark, sf_dir))
    return fn


# --- sources, sinks, ingest -------------------------------------------------


def _flat(products: DataFrame) -> DataFrame:
    return products.select(
        "id", "title", "description", "category", "price", "brand", "rating",
        F.try_element_at("attributes", F.lit("source")).alias("attr_source"),
    )


@register
def scan_catalog(spark, sf_dir):
    return _flat(standin.products(spark, sf_dir))


@register
def scan_queries_qrels(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return ws.queries.join(ws.qrels, "query_id", "left")


@register
def embedded_only(spark, sf_dir):
    kept = catalog.embedded_only(standin.embedded_products(spark, sf_dir, rated=False))
    return kept.select("id", "title", F.size("embedding").alias("dim"))


@register
def embedding_coverage(spark, sf_dir):
    return catalog.embedding_coverage(standin.embedded_products(spark, sf_dir, rated=False))


@register
def roundtrip_catalog(spark, sf_dir):
    path = scratch_root(spark)
    source = standin.products(spark, sf_dir)
    catalog.save(source, path, "json")
    return _flat(catalog.load_products(spark, path, "json", schema=source.schema))


@register
def scan_json_array(spark, sf_dir):
    path = scratch_root(spark)
    source = standin.products(spark, sf_dir)
    catalog.save(source, path, "json_array")
    return _flat(catalog.load_products(spark, path, "json_array", schema=source.schema))


@register
def roundtrip_vectors(spark, sf_dir):
    path = scratch_root(spark)
    source = standin.embedded_products(spark, sf_dir)
    catalog.save(source, path)
    back = catalog.load_embedded_products(spark, path, schema=source.schema)
    return back.select("id", F.posexplode("embedding").alias("pos", "value"))


@register
def to_documents(spark, sf_dir):
    docs = ingest.to_documents(standin.embedded_products(spark, sf_dir, rated=False))
    return docs.select(
        "id", "title", "category", "brand", "price", "product_type",
        F.size("attributes").alias("attributes"),
    )


def _first_batch(spark, sf_dir):
    """Documents with the precomputed vectors; vectors without a document have no id."""
    vectors = standin.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    docs = standin.products(spark, sf_dir)
    return docs.join(vectors, docs["id"] == vectors["vec_id"], "full").drop("vec_id").withColumn(
        "seq", F.lit(1).cast("bigint")
    )


def _second_batch(spark, sf_dir):
    """A new version of every document that has labels."""
    labelled = standin.embedded_products(spark, sf_dir).where(F.col("rating").isNotNull())
    return labelled.withColumns(
        {"title": F.concat(F.lit("new: "), F.col("title")), "seq": F.lit(2).cast("bigint")}
    )


def _ingested(spark, sf_dir):
    target = scratch_root(spark)
    ingest.ingest(_first_batch(spark, sf_dir), target, 1, DIM)
    ingest.ingest(_second_batch(spark, sf_dir), target, 2, DIM)
    return ingest.read_log(spark, target, "bigint")


@register
def ingest_upsert(spark, sf_dir):
    current = ingest.current_catalog(_ingested(spark, sf_dir))
    return current.select("id", "title", "category", "price", "rating", "seq", "batch")


@register
def ingest_stats(spark, sf_dir):
    return ingest.ingest_stats(_ingested(spark, sf_dir))


@register
def ingest_rejects(spark, sf_dir):
    return ingest.rejects(_ingested(spark, sf_dir))


@register
def reject_sample(spark, sf_dir):
    return ingest.reject_sample(_ingested(spark, sf_dir))


@register
def ingest_streaming(spark, sf_dir):
    """The documents as a file stream, joined to their vectors per micro-batch."""
    root = scratch_root(spark)
    schema = standin.table(spark, sf_dir, "documents").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/documents*.parquet")
    vectors = standin.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding"
    )

    def prepare(rows: DataFrame) -> DataFrame:
        return standin.as_products(rows).join(vectors, "id", "left").withColumn(
            "rating", F.lit(None).cast("double")
        )

    start_ingest(stream, f"{root}/target", DIM, f"{root}/checkpoint", prepare).awaitTermination()
    current = ingest.current_catalog(ingest.read_log(spark, f"{root}/target", "bigint"))
    return current.select("id", "title", "category", "price")


@register
def verify_ingest(spark, sf_dir):
    packed = scratch_root(spark)
    facts = ingest.compact(_ingested(spark, sf_dir), packed)
    expected = catalog.embedded_only(standin.embedded_products(spark, sf_dir, rated=False)).count()
    return ingest.verify_ingest(ingest.read_log(spark, packed, "bigint"), expected, facts=facts)


@register
def sample_docs(spark, sf_dir):
    return ingest.sample_documents(standin.catalog(spark, sf_dir).select("id", "title", "category"))


@register
def index_stats(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return indexing.index_stats(ws.index, ws.vectors)


@register
def index_mapping(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return indexing.index_mapping(ws.index, ws.docs, ws.vectors)


# --- generation --------------------------------------------------------------


def _products(spark, sf_dir):
    """As many products as ``part`` has rows."""
    n = standin.table(spark, sf_dir, "part").count()
    ws = workspace(spark, sf_dir)
    return generation.generate_products(ws.templates, n, long_values=ws.template_values)


@register
def gen_products(spark, sf_dir):
    return _products(spark, sf_dir).select(
        "id", "title", "description", "category", "price", "brand", "rating", "product_type",
        F.try_element_at("attributes", F.lit("size")).alias("size"),
        F.try_element_at("attributes", F.lit("finish")).alias("finish"),
    )


@register
def gen_ratings(spark, sf_dir):
    return _products(spark, sf_dir).groupBy("rating").agg(F.count(F.lit(1)).alias("n"))


@register
def gen_quota(spark, sf_dir):
    return _products(spark, sf_dir).groupBy("category", "product_type").agg(F.count(F.lit(1)).alias("n"))


@register
def gen_shuffled(spark, sf_dir):
    return generation.shuffled(workspace(spark, sf_dir).made_products.select("id", "title"))


@register
def product_index(spark, sf_dir):
    return generation.product_index(workspace(spark, sf_dir).made_products)


def _query_count(spark, sf_dir, filled: bool) -> int:
    """As many queries as there are templates; ``filled``: a third more, made of product types."""
    ws = workspace(spark, sf_dir)
    return ws.filled_queries if filled else ws.query_templates.count()


def _labelled(spark, sf_dir, filled: bool):
    ws = workspace(spark, sf_dir)
    return generation.generate_queries(
        ws.templates, ws.query_templates, ws.product_index, _query_count(spark, sf_dir, filled),
        long_values=ws.template_values,
    )


@register
def gen_queries(spark, sf_dir):
    queries, qrels = _labelled(spark, sf_dir, filled=False)
    sizes = qrels.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    return queries.join(sizes, "query_id")


@register
def gen_capped_queries(spark, sf_dir):
    """The first stage whole, of the later ones what half of them leaves room for."""
    ws = workspace(spark, sf_dir)
    n = ws.query_templates.agg(
        F.count_if(F.col("stage") == 0).alias("first"), F.count_if(F.col("stage") != 0).alias("later")
    ).first()
    return generation.template_queries(ws.query_templates, ws.product_index, n["first"] + n["later"] // 2)[0]


@register
def sample_qrels(spark, sf_dir):
    return _labelled(spark, sf_dir, filled=False)[1]


@register
def gen_filler_queries(spark, sf_dir):
    queries, qrels = _labelled(spark, sf_dir, filled=True)
    sizes = qrels.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    return queries.where(F.col("query_type") == "generated").join(sizes, "query_id")


@register
def query_type_counts(spark, sf_dir):
    return catalog.query_type_counts(_labelled(spark, sf_dir, filled=True)[0])


@register
def gen_unmatched_targets(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return generation.unmatched_targets(ws.query_templates, ws.product_index)


# --- embedding ---------------------------------------------------------------


@register
def combined_text(spark, sf_dir):
    return standin.catalog(spark, sf_dir).select("id", embedding.combined_text().alias("text"))


def _long(vectors: DataFrame, key: str) -> DataFrame:
    return vectors.select(key, F.posexplode("embedding").alias("pos", "value")).withColumn(
        "value", F.round("value", 6)
    )


@register
def embed_hashed(spark, sf_dir):
    docs = standin.catalog(spark, sf_dir).select("id", embedding.combined_text().alias("text"))
    return _long(embedding.hashed_embedding(docs, "id", "text"), "id")


@register
def embed_queries(spark, sf_dir):
    return _long(
        embedding.hashed_embedding(standin.queries(spark, sf_dir), "query_id", "query"), "query_id"
    )


def _open_length_encoder():
    """Encoder of the plug-in check: counts of characters, spaces, line breaks and commas."""
    import numpy as np

    def encode(texts: list[str]) -> np.ndarray:
        return np.array([[len(t), t.count(" "), t.count("\n"), t.count(",")] for t in texts])

    return encode


@register
def embed_plugin(spark, sf_dir):
    docs = standin.catalog(spark, sf_dir).select("id", embedding.combined_text().alias("text"))
    encoded = embedding.embed(docs, "text", _open_length_encoder)
    return encoded.select("id", F.posexplode("embedding").alias("pos", "value"))


@register
def attach_embeddings(spark, sf_dir):
    vectors = standin.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    joined = embedding.attach_embeddings(standin.catalog(spark, sf_dir), vectors)
    return joined.select(
        "id", "title", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value")
    )


@register
def embedding_stats(spark, sf_dir):
    return embedding.embedding_stats(standin.table(spark, sf_dir, "embeddings"))


@register
def embedding_preview(spark, sf_dir):
    vectors = standin.table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    return embedding.embedding_preview(vectors)


# --- text analysis and index -------------------------------------------------


def _texts(spark, sf_dir):
    return standin.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


@register
def tokens(spark, sf_dir):
    return indexing.token_rows(_texts(spark, sf_dir), "text", stop=[])


@register
def tokens_nostop(spark, sf_dir):
    return indexing.token_rows(_texts(spark, sf_dir), "text")


@register
def stem_vocabulary(spark, sf_dir):
    vocabulary = indexing.token_rows(_texts(spark, sf_dir), "text").select("tok").distinct()
    return vocabulary.select("tok", stem_words("tok").alias("stem"))


@register
def postings(spark, sf_dir):
    return workspace(spark, sf_dir).index.postings.drop("shard")


@register
def field_stats(spark, sf_dir):
    stats = workspace(spark, sf_dir).index.field_stats
    return stats.withColumn("avgdl", F.round("avgdl", 6))


@register
def term_idf(spark, sf_dir):
    return indexing.term_idf(workspace(spark, sf_dir).index)


@register
def filter_keyword(spark, sf_dir):
    found = indexing.filter_keyword(standin.catalog(spark, sf_dir), category="fr", brand="src7")
    return found.select("id", "title", "category", "brand")


@register
def filter_range(spark, sf_dir):
    found = indexing.filter_range(standin.products(spark, sf_dir), "price", 5.0, 20.0)
    return indexing.filter_range(found, "rating", low=1.0).select("id", "price", "rating")


@register
def filter_attribute(spark, sf_dir):
    found = indexing.filter_attribute(standin.catalog(spark, sf_dir), "source", "src3")
    return found.select("id", "title")


@register
def facet_counts(spark, sf_dir):
    return indexing.facet_counts(standin.catalog(spark, sf_dir), "category", "brand")


@register
def sort_title_keyword(spark, sf_dir):
    titled = indexing.title_keyword(standin.catalog(spark, sf_dir))
    return titled.select("id", "title_keyword").orderBy("title_keyword", "id")


@register
def attribute_facets(spark, sf_dir):
    return indexing.attribute_facets(standin.catalog(spark, sf_dir))


# --- retrieval ---------------------------------------------------------------


@register
def bm25_topk(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return keyword.search_keyword(ws.index, ws.queries, 10)


@register
def index_after_upsert(spark, sf_dir):
    """Every tenth document gets another title, every tenth is removed, every tenth comes again under a new id."""
    ws = workspace(spark, sf_dir)
    docs = ws.docs.select("id", "title", "description", "category", "brand")
    old = docs.where(F.col("id") % 10 % 5 == 0)
    title = F.concat_ws(" ", "brand", "category").alias("title")
    new = docs.where(F.col("id") % 10 == 0).select("id", title, "description").unionByName(
        docs.where(F.col("id") % 10 == 1).select((F.col("id") + 1_000_000_000).alias("id"), "title", "description")
    )
    updated = indexing.update_index(ws.index, old, new, scratch_root(spark), ws.buckets)
    return keyword.search_keyword(updated, ws.queries, 10)


@register
def bm25_title_only(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return keyword.search_keyword(ws.index, ws.queries, 10, fields={"title": 1.0})


@register
def bm25_stemmed(spark, sf_dir):
    """The full analyser, stemming included."""
    plain, ws = workspace(spark, sf_dir), workspace(spark, sf_dir, stem=True)
    return keyword.search_keyword(ws.index, plain.queries, 10)


@register
def knn_exact(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return nearest.search_vector(ws.vectors, ws.query_vectors, 10)


@register
def knn_text(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return encoders.search_text(ws.vectors, ws.queries, encoders.hashed(), 10)


@register
def knn_precomputed(spark, sf_dir):
    """The given vectors, asked with the mean vector of each label."""
    given = standin.table(spark, sf_dir, "embeddings")
    means = (
        given.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("xs"))
        .select(F.col("label").cast("bigint").alias("query_id"), F.col("xs.x").alias("embedding"))
    )
    return nearest.search_vector(given.withColumnRenamed("vec_id", "id"), means, 10)


@register
def knn_approx(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return approximate.search_vector_approx(ws.vectors, ws.bands, ws.query_vectors, ws.query_bands)


@register
def knn_cells(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return cells.search_cells(ws.cells, ws.query_vectors)


@register
def knn_bounded(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return cells.search_bounded(ws.cells, ws.query_vectors)


@register
def knn_cells_recall(spark, sf_dir):
    """Hits per query are complete, most exact hits are among them, a part of the vectors is scored."""
    ws = workspace(spark, sf_dir)
    found = cells.search_cells(ws.cells, ws.query_vectors)
    exact = ws.nearest.where(F.col("rank") <= 10)
    same = exact.join(found.select("query_id", "id", F.col("score").alias("found")), ["query_id", "id"], "left")
    return same.agg(
        F.count("*").alias("wanted"),
        F.coalesce(F.count_if(F.col("found") != F.col("score")), F.lit(0)).alias("wrong_scores"),
        (F.count("found") >= 0.8 * F.count("*")).alias("most_found"),
    )


@register
def band_table(spark, sf_dir):
    return approximate.unfold(workspace(spark, sf_dir).bands)


@register
def knn_recall(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    found = approximate.search_vector_approx(ws.vectors, ws.bands, ws.query_vectors, ws.query_bands)
    return approximate.recall_and_share(
        found, ws.nearest.where(F.col("rank") <= 10),
        approximate.shared_bands(ws.bands, ws.query_bands),
        ws.vectors.count() * ws.query_vectors.count(),
    )


@register
def hybrid_linear(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return fusion.search_hybrid(ws.index, ws.queries, ws.nearest)


@register
def hybrid_rrf(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return fusion.fuse_rrf(ws.bm25, ws.nearest)


@register
def format_hits(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return reports.format_hits(ws.hits, ws.docs)


@register
def compare_methods(spark, sf_dir):
    return reports.compare_methods(workspace(spark, sf_dir).hits)


@register
def side_by_side(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return reports.side_by_side(reports.compare_methods(ws.hits), ws.docs)


@register
def side_by_side_report(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return reports.side_by_side_report(ws.hits, ws.docs)


@register
def category_hits(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return reports.category_hits(ws.hits, ws.docs)


# --- evaluation --------------------------------------------------------------


def _one_metric(name: str) -> Query:
    def run(spark, sf_dir):
        ws = workspace(spark, sf_dir)
        evaluated = metrics.evaluate(ws.hits, ws.qrels, ws.queries)
        return _rounded(evaluated.select("query_id", "method", name))

    return run


for _key, _metric in {
    "precision_at_k": "precision", "recall_at_k": "recall",
    "reciprocal_rank": "mrr", "ndcg_at_k": "ndcg",
}.items():
    _fn = _one_metric(_metric)
    _fn.__name__ = _key
    register(_fn)


@register
def dcg_graded(spark, sf_dir):
    """Graded gains: 1 for a relevant document, 2 if it is also of good quality."""
    ws = workspace(spark, sf_dir)
    gains = ws.qrels.join(ws.docs.select("id", "rating"), "id").select(
        "query_id", "id", (1 + F.coalesce("rating", F.lit(0.0))).alias("gain")
    )
    return _rounded(metrics.graded_dcg(ws.hits, gains))


@register
def metrics_per_query(spark, sf_dir):
    ws = workspace(spark, sf_dir)
    return _rounded(metrics.evaluate(ws.hits, ws.qrels, ws.queries))


@register
def metrics_by_method(spark, sf_dir):
    return _rounded(metrics.summarize(workspace(spark, sf_dir).metrics))


@register
def metrics_one_method(spark, sf_dir):
    return _rounded(metrics.summarize_method(workspace(spark, sf_dir).metrics, "hybrid"))


@register
def metrics_by_type(spark, sf_dir):
    return _rounded(metrics.summarize(workspace(spark, sf_dir).metrics, ("query_type", "method")))


@register
def metrics_rollup(spark, sf_dir):
    """Means by type and method, by type, and over all, from one pass."""
    return _rounded(metrics.rollup(workspace(spark, sf_dir).metrics, ("query_type", "method")))


@register
def improvement_over_baseline(spark, sf_dir):
    return _rounded(metrics.improvements(metrics.summarize(workspace(spark, sf_dir).metrics)))


@register
def metrics_grid(spark, sf_dir):
    return reports.metrics_grid(metrics.summarize(workspace(spark, sf_dir).metrics))


@register
def chart_data_by_method(spark, sf_dir):
    by_method = metrics.summarize(workspace(spark, sf_dir).metrics)
    return _rounded(reports.chart_by_method(by_method, metrics.METHODS))


@register
def chart_data_by_type(spark, sf_dir):
    by_type = metrics.summarize(workspace(spark, sf_dir).metrics, ("query_type", "method"))
    return _rounded(reports.chart_by_type(by_type, metrics.METHODS))


@register
def flow_by_type(spark, sf_dir):
    """All stages on the generated catalog: products, queries, vectors, ingest, index, metrics."""
    return _rounded(workspace(spark, sf_dir).flow["by_type"])


@register
def flow_improvements(spark, sf_dir):
    return _rounded(workspace(spark, sf_dir).flow["improvements"])


@register
def flow_report(spark, sf_dir):
    return workspace(spark, sf_dir).flow["side_by_side"]


@register
def flow_category_hits(spark, sf_dir):
    return workspace(spark, sf_dir).flow["category_hits"]
