"""Exact nearest neighbours by cosine, for a table of query vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sparkrank.functions.ranking import rank_hits

QUERY_BYTES = 128 * 1024 * 1024  # broadcast limit of the query matrix
BLOCK_CELLS = 4_000_000  # similarities held at once in a task


def _unit_rows(values) -> tuple[np.ndarray, np.ndarray]:
    """(kept row numbers, unit vectors); vectors without a finite, positive length are left out."""
    if len(values) == 0:
        return np.empty(0, dtype=np.int64), np.empty((0, 0))
    m = np.asarray(values, dtype=np.float64).reshape(len(values), -1)
    largest = np.abs(m).max(axis=1, initial=0.0)
    keep = np.flatnonzero(np.isfinite(largest) & (largest > 0))
    scaled = m[keep] / largest[keep, None]
    return keep, scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


class _TopK:
    """Running k best (score, id) of each query of a matrix of unit vectors."""

    def __init__(self, unit_queries: np.ndarray, k: int, digits: int):
        self.q, self.k, self.scale = unit_queries, k, 10.0**digits
        self.floor = np.full(len(unit_queries), -np.inf)
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.ids = np.empty(0, dtype=np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, ids: np.ndarray, unit: np.ndarray, queries: np.ndarray | None = None) -> None:
        """Rows of ``unit``, for all queries or for those with the given row numbers."""
        matrix = self.q if queries is None else self.q[queries]
        rows = max(1, BLOCK_CELLS // max(1, len(matrix)))
        for at in range(0, len(ids), rows):
            cos = matrix @ unit[at : at + rows].T
            score = np.floor((1 + cos) / 2 * self.scale + 0.5) / self.scale
            bound = self.floor if queries is None else self.floor[queries]
            if score.shape[1] > self.k:
                kth = np.partition(score, score.shape[1] - self.k, axis=1)[:, score.shape[1] - self.k]
                bound = np.maximum(bound, kth)
            qi, vi = np.nonzero(score >= bound[:, None])
            self._take(qi if queries is None else queries[qi], ids[at : at + rows][vi], score[qi, vi])

    def add_pairs(self, ids: np.ndarray, unit: np.ndarray, row: np.ndarray, query: np.ndarray) -> None:
        """Only the given pairs of a row of ``unit`` and a query."""
        step = max(1, BLOCK_CELLS // max(1, unit.shape[1]))
        for at in range(0, len(row), step):
            r, q = row[at : at + step], query[at : at + step]
            cos = np.einsum("ij,ij->i", unit[r], self.q[q])
            score = np.floor((1 + cos) / 2 * self.scale + 0.5) / self.scale
            good = score >= self.floor[q]
            self._take(q[good], ids[r[good]], score[good])

    def _take(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Sorting waits until the new pairs outnumber the kept ones."""
        self.new.append((query, score, ids))
        self.waiting += len(query)
        if self.waiting > max(BLOCK_CELLS // 4, len(self.query)):
            self.prune()

    def prune(self) -> None:
        if not self.waiting:
            return
        kept = [(self.query, self.score, self.ids)] if len(self.query) else []
        self.query, self.score, self.ids = (np.concatenate(c) for c in zip(*kept, *self.new))
        self.new, self.waiting = [], 0
        order = np.lexsort((self.ids, -self.score, self.query))
        query = self.query[order]
        first = np.searchsorted(query, query, side="left")
        place = np.arange(len(query)) - first
        last = order[place == self.k - 1]
        self.floor[self.query[last]] = self.score[last]
        keep = order[place < self.k]
        self.query, self.score, self.ids = self.query[keep], self.score[keep], self.ids[keep]

    def columns(self, names: np.ndarray, id_types: list[pa.DataType]) -> dict[str, pa.Array]:
        """The kept hits; ``names`` are the query ids in row order of the matrix."""
        self.prune()
        return {
            "query_id": pa.array(names[self.query].tolist() if len(self.query) else [], id_types[0]),
            "id": pa.array(self.ids.tolist(), id_types[1]),
            "score": pa.array(self.score, pa.float64()),
        }


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.to_pylist())


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _hit_schema(query_vectors: DataFrame, vectors: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", query_vectors.schema["query_id"].dataType),
            T.StructField("id", vectors.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _scan(vectors: DataFrame, query_rows: list, schema: T.StructType, k: int, digits: int) -> DataFrame:
    """One pass over the vectors; each task keeps k rows per query."""
    kept, unit = _unit_rows([r["embedding"] for r in query_rows])
    query_ids = np.asarray([query_rows[i]["query_id"] for i in kept])
    shared = vectors.sparkSession.sparkContext.broadcast((query_ids, unit))
    id_types = [to_arrow_type(f.dataType) for f in schema.fields[:2]]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        top = _TopK(matrix, k, digits)
        for batch in batches:
            if batch.num_rows == 0 or len(matrix) == 0:
                continue
            keep, unit_rows = _unit_rows(_matrix(batch.column("embedding")))
            top.add(_ids(batch.column("id"))[keep], unit_rows)
        yield pa.RecordBatch.from_pydict(top.columns(names, id_types))

    return vectors.select("id", "embedding").mapInArrow(best, schema)


def query_matrix_bytes(query_vectors: DataFrame, top_k: int) -> tuple[int, int]:
    """(bytes of the queries with their k best, dimension)."""
    size = query_vectors.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(1)).alias("dim")
    ).first()
    return size["n"] * (size["dim"] * 8 + top_k * 32), size["dim"]


def score_pairs(
    pairs: DataFrame, vectors: DataFrame, query_rows: list, k: int, digits: int
) -> DataFrame:
    """(query_id, id, score): the k best of the given (query_id, id) pairs per query and task.

    The queries of a document travel as one list, at most as long as
    ``query_rows``, which is of checked size.
    """
    kept, unit = _unit_rows([r["embedding"] for r in query_rows])
    names = np.asarray([query_rows[i]["query_id"] for i in kept])
    order = np.argsort(names)
    shared = vectors.sparkSession.sparkContext.broadcast((names[order], unit[order]))
    schema = _hit_schema(pairs, vectors)
    id_types = [to_arrow_type(f.dataType) for f in schema.fields[:2]]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        top = _TopK(matrix, k, digits)
        for batch in batches:
            if batch.num_rows == 0 or len(matrix) == 0:
                continue
            keep, unit_rows = _unit_rows(_matrix(batch.column("embedding")))
            asked = batch.column("query_ids").take(pa.array(keep))
            row = np.repeat(np.arange(len(keep)), asked.value_lengths().to_numpy(zero_copy_only=False))
            wanted = _ids(asked.flatten())
            at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
            known = names[at] == wanted
            top.add_pairs(_ids(batch.column("id"))[keep], unit_rows, row[known], at[known])
        yield pa.RecordBatch.from_pydict(top.columns(names, id_types))

    asked = pairs.groupBy("id").agg(F.collect_list("query_id").alias("query_ids"))
    return vectors.select("id", "embedding").join(asked, "id").mapInArrow(best, schema)


def _grid(
    vectors: DataFrame, queries: DataFrame, schema: T.StructType, k: int, digits: int,
    vector_cells: int, query_cells: int,
) -> DataFrame:
    """Both sides cut by hash of their id into cells of bounded size; a pair of cells is one group.

    Nothing passes through the driver. The vectors are repeated once per query cell.
    """

    def cell(col: str, n: int):
        return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")

    def all_cells(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = vectors.select(
        "id", "embedding", cell("id", vector_cells).alias("vc"), all_cells(query_cells).alias("qc")
    )
    right = queries.select(
        "query_id", "embedding", cell("query_id", query_cells).alias("qc"),
        all_cells(vector_cells).alias("vc"),
    )
    id_types = [to_arrow_type(f.dataType) for f in schema.fields[:2]]

    def best(v: pa.Table, q: pa.Table) -> pa.Table:
        hits = _TopK(np.empty((0, 0)), k, digits)
        names = np.empty(0)
        if v.num_rows and q.num_rows:
            kept_q, unit_q = _unit_rows(q.column("embedding").to_pylist())
            kept_v, unit_v = _unit_rows(v.column("embedding").to_pylist())
            if len(kept_q) and len(kept_v):
                names = _ids(q.column("query_id"))[kept_q]
                hits = _TopK(unit_q, k, digits)
                hits.add(_ids(v.column("id"))[kept_v], unit_v)
        return pa.table(hits.columns(names, id_types))

    return left.groupBy("qc", "vc").cogroup(right.groupBy("qc", "vc")).applyInArrow(best, schema)


def assert_dimension(vectors: DataFrame, dim: int) -> DataFrame:
    """The same rows; fails at run time on a vector of another length."""
    ok = F.size("embedding") == dim
    return vectors.withColumn(
        "embedding",
        F.when(ok, F.col("embedding")).otherwise(F.raise_error(F.lit(f"vector is not of length {dim}"))),
    )


def search_vector(
    vectors: DataFrame,
    query_vectors: DataFrame,
    top_k: int = 10,
    digits: int = 6,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, id, score, rank) with score (1 + cos) / 2.

    Vectors that are zero or hold a non-finite component neither find nor are
    found. Without a query there is no hit.

    ``query_vectors`` is (query_id, embedding). While the queries and their k
    best fit ``query_bytes`` they go to every task as one matrix and the vectors
    are scanned in place; a larger query table meets the vectors cell by cell.
    """
    need, dim = query_matrix_bytes(query_vectors, top_k)
    schema = _hit_schema(query_vectors, vectors)
    if need == 0:
        return rank_hits(vectors.sparkSession.createDataFrame([], schema), top_k)
    checked = assert_dimension(vectors, dim)
    rows = query_vectors.select("query_id", "embedding")
    if need <= query_bytes:
        partial = _scan(checked, rows.collect(), schema, top_k, digits)
    else:
        partial = _grid(
            checked, rows, schema, top_k, digits,
            vector_cells=math.ceil(vectors.count() * dim * 8 / query_bytes) or 1,
            query_cells=math.ceil(need / query_bytes),
        )
    return rank_hits(partial, top_k)
