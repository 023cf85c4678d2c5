"""From templates to metrics in stages that hand on written tables.

generate -> embed -> ingest -> index -> evaluate -> report. A stage named in ``skip``
reuses the tables of an earlier run in the same folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.operators import (
    embedding, fusion, generation, ingest, keyword, metrics, nearest, reports,
)
from sparkrank.operators.index import build_index, open_index
from sparkrank.operators.reports import tag
from sparkrank.sources.scratch import bucket_count, open_bucketed, write_bucketed, write_table

STAGES = ("generate", "embed", "ingest", "index")

# (rows, id column, text column) -> (id column, embedding array<float>)
Encoder = Callable[[DataFrame, str, str], DataFrame]


def hashed_encoder(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    dense = embedding.hashed_embedding(rows, id_col, text_col)
    return dense.withColumn("embedding", F.col("embedding").cast("array<float>"))


def generate(
    spark: SparkSession, root: str, product_templates: DataFrame, query_templates: DataFrame,
    n_products: int, num_queries: int, long_values: DataFrame | None = None,
) -> None:
    products = write_table(
        generation.generate_products(product_templates, n_products, long_values=long_values), f"{root}/products"
    )
    index = write_table(generation.product_index(products), f"{root}/product_index")
    queries, qrels = generation.generate_queries(
        product_templates, query_templates, index, num_queries, long_values=long_values
    )
    write_table(queries, f"{root}/queries")
    write_table(qrels, f"{root}/qrels")


def embed(spark: SparkSession, root: str, encoder: Encoder) -> None:
    products = spark.read.parquet(f"{root}/products")
    texts = products.select("id", embedding.combined_text().alias("text"))
    write_table(
        embedding.attach_embeddings(products, encoder(texts, "id", "text")), f"{root}/embedded"
    )
    queries = spark.read.parquet(f"{root}/queries")
    write_table(encoder(queries, "query_id", "query"), f"{root}/query_vectors")


def search_all(
    index, vectors: DataFrame, queries: DataFrame, query_vectors: DataFrame, root: str,
    top_k: int = 10, window: int = fusion.RRF_WINDOW,
) -> DataFrame:
    """(query_id, method, id, score, rank) of the four methods."""
    bm25 = write_table(keyword.search_keyword(index, queries, window), f"{root}/bm25")
    near = write_table(nearest.search_vector(vectors, query_vectors, window), f"{root}/near")
    lists = {
        "bm25": bm25.where(F.col("rank") <= top_k),
        "vector": near.where(F.col("rank") <= top_k),
        "hybrid": fusion.search_hybrid(index, queries, near, top_k),
        "hybrid_rrf": fusion.fuse_rrf(bm25, near, top_k, bm25_window=window),
    }
    for method, hits in lists.items():
        tag(hits, method).drop("method").write.mode("overwrite").parquet(f"{root}/hits/method={method}")
    written = queries.sparkSession.read.parquet(f"{root}/hits")
    return written.select("query_id", "method", "id", "score", "rank")


def run_flow(
    spark: SparkSession,
    root: str,
    product_templates: DataFrame | None = None,
    query_templates: DataFrame | None = None,
    n_products: int = 1500,
    num_queries: int = 100,
    encoder: Encoder = hashed_encoder,
    stem: bool = True,
    k: int = 10,
    skip: tuple[str, ...] = (),
    long_values: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Run the stages not named in ``skip``, evaluate and report; returns hits, metrics and reports.

    ``long_values`` are the lists of ``product_templates`` that are kept as rows (``operators.domains``).
    """
    unknown = set(skip) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    root = root.rstrip("/")
    if "generate" not in skip:
        if product_templates is None or query_templates is None:
            raise ValueError("the generate stage needs templates")
        generate(spark, root, product_templates, query_templates, n_products, num_queries, long_values)
    if "embed" not in skip:
        embed(spark, root, encoder)
    query_vectors = spark.read.parquet(f"{root}/query_vectors")
    buckets = bucket_count(spark, f"{root}/embedded")
    if "ingest" not in skip:
        embedded = spark.read.parquet(f"{root}/embedded")
        dim = embedding.embedding_stats(embedded).first()["max_dim"]
        ingest.ingest(embedded, f"{root}/catalog", 0, dim)
        current = ingest.current_catalog(ingest.read_log(spark, f"{root}/catalog"))
        docs = write_bucketed(current, f"{root}/docs", ["id"], buckets)
    else:
        docs = open_bucketed(spark, f"{root}/docs")
    if "index" not in skip:
        index = build_index(docs, f"{root}/index", stem=stem, buckets=buckets)
        vectors = write_bucketed(docs.select("id", "embedding"), f"{root}/vectors", ["id"], buckets)
    else:
        index = open_index(spark, f"{root}/index")
        vectors = open_bucketed(spark, f"{root}/vectors")
    queries = spark.read.parquet(f"{root}/queries")
    qrels = spark.read.parquet(f"{root}/qrels")
    hits = search_all(index, vectors, queries, query_vectors, root, k)
    per_query = write_table(metrics.evaluate(hits, qrels, queries, k), f"{root}/metrics")
    return {"docs": docs, "hits": hits, "metrics": per_query, **report(root, docs, hits, per_query)}


def report(root: str, docs: DataFrame, hits: DataFrame, per_query: DataFrame) -> dict[str, DataFrame]:
    """The last stage: summaries, improvements over BM25 and comparison tables, each written."""
    by_method = write_table(metrics.summarize(per_query), f"{root}/reports/by_method")
    tables = {
        "by_type": metrics.summarize(per_query, ("query_type", "method")),
        "improvements": metrics.improvements(by_method),
        "metrics_grid": reports.metrics_grid(by_method),
        "side_by_side": reports.side_by_side_report(hits, docs),
        "category_hits": reports.category_hits(hits, docs),
    }
    written = {name: write_table(df, f"{root}/reports/{name}") for name, df in tables.items()}
    return {"by_method": by_method, **written}
