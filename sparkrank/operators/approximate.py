"""Approximate nearest neighbours: sign codes of hyperplane bands, then exact re-ranking."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.functions.ranking import rank_hits, top_k as cut
from sparkrank.functions.sizing import broadcast_if_within, join_small
from sparkrank.functions.vectors import norm, unit_score
from sparkrank.operators.nearest import (
    QUERY_BYTES, assert_dimension, query_matrix_bytes, score_pairs, search_vector,
)

BITS = 6
BANDS = 32


def hyperplanes(dim: int, bits: int, bands: int, seed: int) -> np.ndarray:
    """(dim, bands * bits) normals with components in [-1, 1), drawn by counter."""
    flat = [
        int(hashlib.md5(f"{seed}|{plane}|{axis}".encode()).hexdigest()[:8], 16)
        for axis in range(dim)
        for plane in range(bands * bits)
    ]
    return np.asarray(flat, dtype=np.float64).reshape(dim, -1) / 2**31 - 1


def centre(vectors: DataFrame, dim: int) -> list[float]:
    """Mean of the finite vectors: ``dim`` numbers, from one aggregate."""
    finite = F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    means = vectors.where(finite).agg(*[F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(dim)])
    return [x or 0.0 for x in means.first()]


def band_codes(
    vectors: DataFrame,
    dim: int,
    bits: int = BITS,
    bands: int = BANDS,
    seed: int = 7,
    key: str = "id",
    origin: list[float] | None = None,
) -> DataFrame:
    """(key, codes): per band, which side of its ``bits`` planes a vector lies on.

    One short row per vector; the bands are unfolded where they are compared.

    The planes meet in ``origin``; put it to the centre of vectors that all
    point one way. More bits make smaller buckets: let them grow with log2 of
    the table.
    """
    shift = np.zeros(dim) if origin is None else np.asarray(origin)
    planes = hyperplanes(dim, bits, bands, seed)
    weights = 1 << np.arange(bits, dtype=np.int64)
    schema = T.StructType([vectors.schema[key], T.StructField("codes", T.ArrayType(T.LongType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            side = (flat.astype(np.float64).reshape(-1, dim) - shift) @ planes > 0
            codes = side.reshape(-1, bands, bits) @ weights
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(list(codes), pa.list_(pa.int64()))], names=[key, "codes"]
            )

    checked = assert_dimension(vectors, dim).select(key, "embedding")
    return checked.mapInArrow(encode, schema)


def unfold(codes: DataFrame, key: str = "id") -> DataFrame:
    """(key, band, code), one row per band."""
    return codes.select(key, F.posexplode("codes").alias("band", "code"))


def shared_bands(bands: DataFrame, query_bands: DataFrame) -> DataFrame:
    """(query_id, id, shared) of all pairs that meet in at least one band.

    With the query side broadcast no row of the band table moves, so a code
    that holds a third of all vectors is not one task; with ``bands`` bucketed
    by id the count is local as well.
    """
    return (
        join_small(unfold(bands), unfold(query_bands, "query_id"), ["band", "code"], "id")
        .groupBy("query_id", "id")
        .agg(F.count(F.lit(1)).alias("shared"))
    )


def search_vector_approx(
    vectors: DataFrame,
    bands: DataFrame,
    query_vectors: DataFrame,
    query_bands: DataFrame,
    top_k: int = 10,
    num_candidates: int | None = None,
    digits: int = 6,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, id, score, rank): exact scores over the rows that share a band with the query.

    All candidates are scored where they are: bands and vectors bucketed by id
    meet without a shuffle and each task passes on k rows per query.
    ``num_candidates`` keeps only the rows with the most shared bands, for less
    work and lower recall. A query that meets fewer than ``top_k`` rows is
    answered exactly.
    """
    if num_candidates is not None and num_candidates < top_k:
        raise ValueError("num_candidates must be at least top_k")
    candidates = shared_bands(bands, query_bands)
    if num_candidates is not None:
        candidates = cut(
            candidates, num_candidates, ["query_id"], [F.col("shared").desc(), F.col("id").asc()]
        )
    need, _ = query_matrix_bytes(query_vectors, top_k)
    if need == 0:
        return search_vector(vectors, query_vectors, top_k, digits)
    if need <= query_bytes:
        rows = query_vectors.select("query_id", "embedding").collect()
        scored = score_pairs(candidates, vectors, rows, top_k, digits)
    else:
        unit = F.transform("embedding", lambda x: x.cast("double") / norm(F.col("embedding")))
        queries = query_vectors.where(norm(F.col("embedding")) > 0).select(
            "query_id", unit.alias("qv")
        )
        score = unit_score(F.col("embedding"), F.col("qv"), digits)
        scored = (
            candidates.select("query_id", "id")
            .join(vectors.select("id", "embedding"), "id")
            .join(queries, "query_id")
            .select("query_id", "id", score.alias("score"))
            .where(F.col("score").isNotNull() & ~F.isnan("score"))
        )
    hits = rank_hits(scored, top_k).persist()
    found = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    short = query_vectors.join(found, "query_id", "left").where(
        F.coalesce("n", F.lit(0)) < top_k
    ).select("query_id", "embedding").persist()
    if short.isEmpty():
        return hits
    exact = search_vector(vectors, short, top_k, digits)
    return hits.join(
        broadcast_if_within(short.select("query_id")), "query_id", "left_anti"
    ).unionByName(exact)


def recall_and_share(approx: DataFrame, exact: DataFrame, pairs: DataFrame, n_pairs: int) -> DataFrame:
    """One row: share of exact hits found, and scored pairs per possible pair."""
    found = exact.join(approx.select("query_id", "id"), ["query_id", "id"], "left_semi")
    scored = pairs.agg(F.count(F.lit(1)).alias("scored"))
    return (
        exact.agg(F.count(F.lit(1)).alias("wanted"))
        .withColumn("one", F.lit(1))
        .join(found.agg(F.count(F.lit(1)).alias("found")).withColumn("one", F.lit(1)), "one")
        .join(scored.withColumn("one", F.lit(1)), "one")
        .select(
            F.round(F.col("found") / F.col("wanted"), 6).alias("recall"),
            F.round(F.col("scored") / F.lit(n_pairs), 6).alias("candidate_share"),
        )
    )
