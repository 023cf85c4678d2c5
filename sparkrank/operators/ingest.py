"""Ingest with validation, upsert by id and per-row error accounting.

A target is a log of batches: ``<target>/batch=<n>/accepted=<bool>``. Each batch
is written once, in one pass; writing it again replaces it. The current
catalog is the last accepted version of every id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.functions.ranking import top_k
from sparkrank.operators.nearest import search_vector


class RejectedRows(ValueError):
    """Raised for invalid rows when errors are not tolerated."""


def to_documents(products: DataFrame) -> DataFrame:
    """The stored shape, with defaults for missing attributes and product type."""
    extra = ["seq"] if "seq" in products.columns else []
    no_attributes = F.create_map().cast("map<string,string>")
    return products.select(
        "id", "title", "description", "category", "price", "brand", "rating",
        F.coalesce("attributes", no_attributes).alias("attributes"),
        F.coalesce("product_type", F.lit("")).alias("product_type"),
        "embedding", *extra,
    )


def reject_reason(dim: int) -> Column:
    """Why a row cannot be stored; NULL for a valid row."""
    vector = F.col("embedding")
    return (
        F.when(F.col("id").isNull(), "missing id")
        .when(vector.isNull(), "missing embedding")
        .when(F.size(vector) != dim, "wrong dimension")
        .when(F.exists(vector, lambda x: x.isNull() | F.isnan(x)), "not a number")
        .when(F.exists(vector, lambda x: F.abs(x) == float("inf")), "not finite")
        .when(~F.exists(vector, lambda x: x != 0), "zero vector")
    )


def ingest(
    batch: DataFrame, target: str, batch_no: int, dim: int, raise_on_error: bool = False
) -> DataFrame:
    """Append one batch; returns its one-row stats (total, success, failed), counted as it is written.

    Rows of one id are ordered by ``seq``. Without that column nothing says
    which row is newer, so all rows of an id that repeats are rejected.
    """
    docs = to_documents(batch)
    reason = reject_reason(dim)
    if "seq" not in docs.columns:
        repeated = docs.groupBy("id").count().where("count > 1").select(F.col("id").alias("_again"))
        docs = docs.join(repeated, docs["id"] == repeated["_again"], "left").withColumn(
            "seq", F.lit(0).cast("bigint")
        )
        reason = F.coalesce(reason, F.when(F.col("_again").isNotNull(), "duplicate id"))
    checked = docs.withColumn("reason", reason).drop("_again")
    docs = docs.drop("_again")
    if raise_on_error and not checked.where(F.col("reason").isNotNull()).isEmpty():
        raise RejectedRows("the batch holds invalid rows, nothing was written")
    path = f"{target.rstrip('/')}/batch={int(batch_no)}"
    marked, seen = _observed(checked.withColumn("accepted", F.col("reason").isNull()), _STATS)
    marked.write.mode("overwrite").partitionBy("accepted").parquet(path)
    return _one_row(batch.sparkSession, seen.get, _STATS)


_STATS = {"total": "count(1)", "success": "count_if(accepted)", "failed": "count_if(not accepted)"}
_FACTS = {
    "n": "count(1)", "without_vector": "count_if(coalesce(size(embedding), 0) <= 0)",
    "min_dim": "cast(min(size(embedding)) as bigint)", "max_dim": "cast(max(size(embedding)) as bigint)",
}


def _measures(facts: dict[str, str]) -> list[Column]:
    return [F.expr(what).alias(name) for name, what in facts.items()]


def _observed(df: DataFrame, facts: dict[str, str]) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that are known once it is written.

    They are taken in the tasks that write, of which one attempt counts, so a
    lost executor changes no number.
    """
    seen = Observation()
    return df.observe(seen, *_measures(facts)), seen


def _one_row(spark: SparkSession, found: dict, facts: dict[str, str]) -> DataFrame:
    """The observed values as a row; counts of nothing are 0, extremes NULL."""
    values = {name: found.get(name, 0 if what.startswith("count") else None) for name, what in facts.items()}
    return spark.range(1).select(*[F.lit(v).cast("bigint").alias(name) for name, v in values.items()])


def _log(spark: SparkSession, target: str, doc_schema: T.StructType) -> DataFrame:
    schema = T.StructType(
        [
            *doc_schema.fields,
            T.StructField("reason", T.StringType()),
            T.StructField("batch", T.LongType()),
            T.StructField("accepted", T.BooleanType()),
        ]
    )
    return spark.read.schema(schema).option("basePath", target).parquet(target)


def read_log(spark: SparkSession, target: str, id_type: str = "string") -> DataFrame:
    """All rows ever ingested, with batch, accepted and reason."""
    doc_schema = T.StructType.fromDDL(
        f"id {id_type}, title string, description string, category string, price double, "
        "brand string, rating double, attributes map<string,string>, product_type string, "
        "embedding array<float>, seq bigint"
    )
    return _log(spark, target, doc_schema)


def current_catalog(log: DataFrame) -> DataFrame:
    """Last accepted version per id. Versions are cut per task before the shuffle."""
    versions = log.where(F.col("accepted"))
    newest = top_k(versions, 1, ["id"], [F.col("batch").desc(), F.col("seq").desc()])
    return newest.drop("rank", "reason", "accepted")


def ingest_stats(log: DataFrame, batch_no: int | None = None) -> DataFrame:
    rows = log if batch_no is None else log.where(F.col("batch") == batch_no)
    return rows.agg(*_measures(_STATS))


def rejects(log: DataFrame) -> DataFrame:
    return log.where(~F.col("accepted")).select("batch", "id", "reason")


def reject_sample(log: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` errors."""
    return rejects(log).orderBy("batch", "id", "reason").limit(n)


def sample_documents(docs: DataFrame, n: int = 3) -> DataFrame:
    return docs.orderBy("id").limit(n)


def compact(log: DataFrame, path: str) -> DataFrame:
    """Write the current catalog as the first batch of a new target.

    Returns one row (n, without_vector, min_dim, max_dim), taken as it is
    written; ``verify_ingest`` takes it in place of a pass over the catalog.
    """
    rows = current_catalog(log).drop("batch").withColumns(
        {"reason": F.lit(None).cast("string"), "accepted": F.lit(True)}
    )
    rows, seen = _observed(rows, _FACTS)
    rows.write.mode("overwrite").partitionBy("accepted").parquet(f"{path.rstrip('/')}/batch=0")
    return _one_row(log.sparkSession, seen.get, _FACTS)


def verify_ingest(docs: DataFrame, expected: int | None = None, k: int = 3, facts: DataFrame | None = None) -> DataFrame:
    """One row: count, dimensions, rows without vector, and whether sampled rows find themselves.

    ``self_score`` is the lowest best score of the sampled rows searched by
    their own vector: 1 when the search answers. ``ok`` sums all up. ``facts``
    are those of ``compact``, if ``docs`` is what it wrote.
    """
    facts = docs.agg(*_measures(_FACTS)) if facts is None else facts
    sample = sample_documents(docs, k).select(F.col("id").alias("query_id"), "embedding")
    own = search_vector(docs.select("id", "embedding"), sample, top_k=k).where(F.col("rank") == 1)
    self_score = own.agg(F.min("score").alias("self_score"))
    wanted = F.lit(expected).cast("bigint")
    return (
        facts.withColumn("one", F.lit(1))
        .join(self_score.withColumn("one", F.lit(1)), "one")
        .select(
            "n", wanted.alias("expected"), "without_vector", "min_dim", "max_dim", "self_score",
            (
                (F.coalesce(wanted, F.col("n")) == F.col("n"))
                & (F.col("without_vector") == 0)
                & (F.col("min_dim") == F.col("max_dim"))
                & (F.coalesce("self_score", F.lit(0.0)) == 1.0)
            ).alias("ok"),
        )
    )
