"""Time the headline queries at $BENCH_SF_DIR; prints one JSON line.

Index and vector tables are built first and timed as queries of their own, as
searches run on the written tables. Every other query is computed in full into
a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from sparkrank.plans.registry import REGISTRY
from sparkrank.plans.workspace import workspace

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

BUILDS = ["docs", "queries", "index", "qrels", "vectors", "query_vectors", "bands", "query_bands", "cells"]
QUERIES = [
    "bm25_topk", "bm25_title_only", "knn_exact", "knn_precomputed", "knn_approx", "knn_cells", "knn_bounded",
    "hybrid_linear", "hybrid_rrf", "format_hits", "compare_methods", "side_by_side",
    "category_hits", "metrics_per_query", "metrics_by_method", "metrics_by_type",
    "improvement_over_baseline", "postings", "term_idf", "tokens", "stem_vocabulary",
    "embed_hashed", "embedding_stats", "facet_counts", "filter_range", "ingest_upsert",
    "gen_products", "product_index", "sample_qrels",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    timings: dict[str, float] = {}

    def timed(name: str, work) -> None:
        started = time.perf_counter()
        work()
        timings[name] = round(time.perf_counter() - started, 3)

    ws = workspace(spark, SF_DIR)
    for table in BUILDS:
        timed(f"build_{table}", lambda: getattr(ws, table))
    for key in QUERIES:
        timed(key, lambda: REGISTRY[key](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(SF_DIR.rstrip("/").rsplit("sf", 1)[-1]),
            }
        )
    )


if __name__ == "__main__":
    main()
