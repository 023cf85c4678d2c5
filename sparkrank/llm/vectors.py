"""What the two vector searches share: rows that take part, query blocks, the last merge."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrank.llm.shared import kept

#: Queries that go to the driver and to every task at a time.
BLOCK = 20_000


class Queries(NamedTuple):
    """A block of queries of one dimension."""

    ids: np.ndarray
    vectors: np.ndarray


def usable(vectors: DataFrame, nonzero: bool = False) -> DataFrame:
    """(vec_id, v: array<double>, dim) of the rows that take part, each (id, vector) once.

    Rows without an id and vectors that are null or hold a null or non-finite
    component take no part, with ``nonzero`` neither do vectors of length zero.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    if nonzero:
        rows = rows.where(F.exists(v, lambda x: x != 0.0))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"), F.size("embedding").alias("dim"))


def representatives(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` smallest ids of each different vector: no other can be among as many best.

    Ids are cut to that number in every task before they are shuffled.
    """
    once = rows.dropDuplicates(["vec_id", "v"])
    inside = Window.partitionBy("v").orderBy("vec_id")
    return once.withColumn("_n", F.row_number().over(inside)).where(F.col("_n") <= most).drop("_n")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def query_blocks(queries: DataFrame, block: int = BLOCK) -> Iterator[Queries]:
    """Queries in blocks of about ``block`` rows and one dimension; one block is on the driver at a time."""
    queries = kept(queries.dropDuplicates(["vec_id", "v"]))
    for row in queries.groupBy("dim").agg(F.count("*").alias("n")).orderBy("dim").collect():
        blocks = -(-row["n"] // block)
        own = queries.where(F.col("dim") == row["dim"])
        for number in range(blocks):
            here = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == number
            found = own.where(here).select("vec_id", "v").orderBy("vec_id").toArrow().combine_chunks()
            ids = found.column("vec_id").to_numpy()
            if len(ids):
                yield Queries(ids, matrix(found.column("v").combine_chunks(), row["dim"]))


def best(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of (query_id, vec_id, score) per query; ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def union(parts: list[DataFrame], empty: DataFrame) -> DataFrame:
    whole = parts[0] if parts else empty
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def divisible(by: int) -> Column:
    return F.col("vec_id") % by == 0


def top_rows(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of flat hits the ``k`` best per query number, ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], ids[keep], scores[keep]


Search = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
