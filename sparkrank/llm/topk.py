"""Exact inner-product search over length buckets.

Vectors are sorted by length and cut into buckets. For a query whose k-th best
score so far is t, a bucket with longest vector l can only hold better ones at a
cosine of t / (|q| l) or more: the local threshold. Above one the bucket is
skipped. A high threshold confines the coordinates of a unit vector, so the
query's largest coordinates rule out most of the bucket (coordinate pruning); a
low one leaves the vectors long enough for t (length pruning). What remains is
verified by exact integer products. Starting thresholds come from a bounded
number of the longest vectors.

Components x become floor(scale * x). Vectors of different dimensions do not
meet; see ``vectors.usable`` for rows that take no part.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.shared import Batches, kept, width
from sparkrank.llm.vectors import BLOCK, Queries, best, matrix, query_blocks, representatives, top_rows, union, usable

#: The longest vectors, which set the first thresholds.
HEAD = 2_048
#: Coordinates tried per query, and the local threshold from which on they are.
FOCUS, COORDINATE_FROM = 4, 0.35
#: Queries multiplied with a bucket at a time.
ROWS = 256
#: Below this all products and sums of doubles are exact integers.
EXACT = 2.0**53
LONGEST = (1 << 63) - 1


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v, dim, length) with whole-numbered components, kept as doubles."""
    whole = F.transform("v", lambda x: F.rint(x * scale) - F.when(F.rint(x * scale) > x * scale, 1.0).otherwise(0.0))
    rows = usable(vectors).select("vec_id", whole.alias("v"), "dim")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("length", length)


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """All inner products, exact: as doubles where these are, else as Python integers cut to 64 bits."""
    bound = np.abs(q).max(initial=0) * np.abs(p).max(initial=0) * max(q.shape[1], 1)
    if bound < EXACT:
        return (q @ p.T).astype(np.int64)
    to_int = np.vectorize(int, otypes=[object])
    whole = to_int(q) @ to_int(p).T if q.size and p.size else np.zeros((len(q), len(p)), object)
    return np.clip(whole, -LONGEST, LONGEST).astype(np.int64)


class Seeded(NamedTuple):
    """Queries, their lengths and a lower bound of each k-th best score."""

    queries: Queries
    lengths: np.ndarray
    least: np.ndarray


def _seed(queries: Queries, head: np.ndarray, k: int, ids: np.ndarray | None = None) -> Seeded:
    """Bounds from the head: its k-th best among rows of other ids than the query's; without ``ids`` all are others."""
    lengths = np.sqrt((queries.vectors**2).sum(axis=1))
    least = np.full(len(queries.ids), -np.inf)
    if len(head) >= k:
        for at in range(0, len(least), ROWS):
            scores = products(queries.vectors[at : at + ROWS], head)
            if ids is not None:
                scores[queries.ids[at : at + ROWS][:, None] == ids[None, :]] = -LONGEST - 1
            kth = np.partition(scores, len(head) - k, axis=1)[:, len(head) - k]
            least[at : at + ROWS] = np.where(kth < -LONGEST, -np.inf, kth)
    return Seeded(queries, lengths, least)


def _confined(unit: np.ndarray, q: np.ndarray, cosine: float) -> np.ndarray:
    """Vectors whose coordinates allow ``cosine`` with the unit vector ``q``, by its largest coordinates."""
    left = np.arange(len(unit))
    for f in np.argsort(-np.abs(q), kind="stable")[:FOCUS]:
        room = np.sqrt(max(0.0, 1 - q[f] ** 2) * max(0.0, 1 - cosine**2)) + 1e-9
        values = unit[left, f]
        left = left[np.abs(values - q[f] * cosine) <= room] if q[f] == 0 else left[
            (values >= q[f] * cosine - room if q[f] > 0 else values <= q[f] * cosine + room)
        ]
    return left


def search_bucket(seeded: Seeded, ids: np.ndarray, p: np.ndarray, lengths: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Hits (query number, id, score) of one bucket that can be among the ``k`` best."""
    queries, qlen, least = seeded
    longest = lengths.max(initial=0)
    reach = qlen * longest * (1 + 1e-9)
    open_ = np.flatnonzero(reach >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach[open_] > 0, np.maximum(least[open_], 0) / reach[open_], 0.0)
    by_coordinate = open_[cosine >= COORDINATE_FROM]
    by_length = open_[cosine < COORDINATE_FROM]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def keep(numbers: np.ndarray, candidates: np.ndarray, scores: np.ndarray) -> None:
        own = queries.ids[numbers][:, None] == ids[candidates][None, :]
        ok = (scores >= least[numbers][:, None]) & ~own
        if ok.shape[1] > k:
            level = np.where(own, -LONGEST - 1, scores)
            ok &= scores >= np.partition(level, level.shape[1] - k, axis=1)[:, level.shape[1] - k][:, None]
        row, col = np.nonzero(ok)
        found.append(top_rows(numbers[row], ids[candidates][col], scores[row, col], k))

    with np.errstate(divide="ignore", invalid="ignore"):
        unit = np.where(lengths[:, None] > 0, p / lengths[:, None], 0.0)
    for number in by_coordinate:
        q = queries.vectors[number] / qlen[number]
        left = _confined(unit, q, max(least[number], 0) / reach[number])
        if len(left):
            keep(np.array([number]), left, products(queries.vectors[number : number + 1], p[left]))
    for at in range(0, len(by_length), ROWS):
        numbers = by_length[at : at + ROWS]
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(qlen[numbers] > 0, least[numbers] / qlen[numbers], -np.inf).min()
        left = np.flatnonzero(lengths * (1 + 1e-9) >= needed)
        if len(left):
            keep(numbers, left, products(queries.vectors[numbers], p[left]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return top_rows(*(np.concatenate(c) for c in zip(*found, strict=True)), k)


def _search(seeded: Seeded, k: int):
    def run(batches: Batches) -> Batches:
        dim = seeded.queries.vectors.shape[1]
        number = ids = scores = np.zeros(0, np.int64)
        state = seeded
        for batch in batches:
            if batch.num_rows == 0:
                continue
            hits = search_bucket(
                state, batch.column(0).to_numpy(), matrix(batch.column(1), dim), batch.column(2).to_numpy(), k
            )
            number, ids, scores = top_rows(*(np.concatenate(c) for c in zip((number, ids, scores), hits, strict=True)), k)
            counts = np.bincount(number, minlength=len(state.least))
            full = np.flatnonzero(counts == k)
            least = state.least.copy()
            least[full] = np.maximum(least[full], scores[np.cumsum(counts)[full] - 1])
            state = state._replace(least=least)
        if len(number):
            yield pa.RecordBatch.from_arrays(
                [pa.array(state.queries.ids[number]), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"]
            )

    return run


HITS = "query_id bigint, vec_id bigint, score bigint"


def search(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest integer products per query row.

    Candidates are all rows but those of the query's id; ties go to the smaller
    vec_id. Products are exact; one beyond 64 bits counts as the largest such number. ``is_query`` is a condition on vec_id. Buckets are the Arrow batches
    of partitions sorted by length; queries pass the driver in blocks of
    ``block`` rows, each of which reads the sorted vectors once.
    """
    spark = vectors.sparkSession
    rows = kept(integers(vectors, scale))
    order = [F.col("dim"), F.col("length").desc(), F.col("vec_id")]
    sorted_rows = kept(
        representatives(rows, k + 1).repartitionByRange(width(spark), *order).sortWithinPartitions(*order)
    )
    parts: list[DataFrame] = []
    for queries in query_blocks(rows.where(is_query).select("vec_id", "v", "dim"), block):
        dim = queries.vectors.shape[1]
        own = sorted_rows.where(F.col("dim") == dim).select("vec_id", "v", "length")
        longest = own.orderBy(F.col("length").desc(), "vec_id").limit(head).select("vec_id", "v").toArrow()
        seeded = _seed(queries, matrix(longest.column("v").combine_chunks(), dim), k, longest.column("vec_id").to_numpy())
        parts.append(kept(best(own.mapInArrow(_search(seeded, k), HITS), k)))
    return union(parts, best(spark.createDataFrame([], HITS), k))
