"""Inverted-file vector index: k-means cells as partitions of a table.

Vectors of length 1 are clustered by rounds of k-means, each one pass with sums
inside the tasks. The written table is partitioned by cell, so a search reads
only the folders of the cells it asks for. ``search_cells`` asks for the nearest
cells of each query; ``search_bounded`` is exact: with centre c and radius r of
a cell no member has a cosine above q·c + r, so cells below the running k-th
score of every query are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkrank.functions.ranking import rank_hits
from sparkrank.operators.nearest import (
    QUERY_BYTES, _hit_schema, _ids, _matrix, _TopK, _unit_rows, assert_dimension, query_matrix_bytes,
)
from sparkrank.sources.scratch import scratch_root, write_table

ROUNDS = 6
#: Share of the cells that a search asks for.
PROBES = 1 / 3
#: Bound of the centres, which every task holds, and rows of a cell that lie in one file.
CENTRE_BYTES = 64 * 1024 * 1024
FILE_ROWS = 200_000
#: Above the error of a cosine in double precision.
SLACK = 1e-9


@dataclass(frozen=True)
class CellIndex:
    """vectors(id, embedding, cell), partitioned by cell; centre, number of rows and radius per cell."""

    vectors: DataFrame
    centres: np.ndarray
    sizes: np.ndarray
    radii: np.ndarray


def _nearest_cell(unit: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, distance) of unit vectors; of equally near cells the first."""
    nearness = unit @ centres.T - (centres * centres).sum(axis=1) / 2
    cell = nearness.argmax(axis=1)
    best = np.maximum(0.0, 1 - 2 * nearness[np.arange(len(unit)), cell])
    return cell, np.sqrt(best)


def _round(vectors: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and sizes of the cells of ``centres``; an empty cell keeps its centre."""
    count, dim = centres.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((count, dim)), np.zeros(count, np.int64)
        for batch in batches:
            if batch.num_rows:
                _, unit = _unit_rows(_matrix(batch.column("embedding")))
                if len(unit):
                    cell, _ = _nearest_cell(unit, centres)
                    np.add.at(total, cell, unit)
                    n += np.bincount(cell, minlength=count)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"cell": pa.array(own), "n": pa.array(n[own]), "total": pa.array(list(total[own]), pa.list_(pa.float64()))}
        )

    made = vectors.select("embedding").mapInArrow(sums, "cell bigint, n bigint, total array<double>")
    means = F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(dim)])
    after, sizes = centres.copy(), np.zeros(count, np.int64)
    for row in made.groupBy("cell").agg(F.sum("n").alias("n"), means.alias("total")).collect():
        after[row["cell"]] = np.asarray(row["total"]) / row["n"]
        sizes[row["cell"]] = row["n"]
    return after, sizes


def build_cells(vectors: DataFrame, path: str, cells: int | None = None, rounds: int = ROUNDS, seed: int = 7) -> CellIndex:
    """Cluster ``vectors(id, embedding)`` and write them by cell below ``path``.

    By default there are as many cells as the square root of the rows, as long
    as the centres stay within ``CENTRE_BYTES``. The first centres are the
    vectors with the smallest hash of their id. Zero and non-finite vectors are
    left out. A cell of more than ``FILE_ROWS`` rows is written by several tasks.
    """
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    dim = max(1, size["dim"] or 1)
    checked = assert_dimension(vectors, dim).select("id", "embedding")
    wanted = cells or max(1, math.isqrt(size["n"]))
    wanted = min(wanted, max(1, CENTRE_BYTES // (8 * dim)))
    drawn = checked.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(wanted).select("embedding").collect()
    _, centres = _unit_rows([r["embedding"] for r in drawn])
    if not len(centres):
        centres = np.zeros((1, dim))
    for _ in range(rounds):
        centres, _ = _round(checked, centres)
    _, sizes = _round(checked, centres)
    id_type = to_arrow_type(vectors.schema["id"].dataType)
    files = np.maximum(1, -(-sizes // FILE_ROWS))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keep, unit = _unit_rows(_matrix(batch.column("embedding")))
            if not len(keep):
                continue
            cell, distance = _nearest_cell(unit, centres)
            rows = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": rows.column("id").cast(id_type), "embedding": rows.column("embedding"),
                    "distance": pa.array(distance), "cell": pa.array(cell), "files": pa.array(files[cell]),
                }
            )

    kinds = ", ".join(f"{c} {checked.schema[c].dataType.simpleString()}" for c in ("id", "embedding"))
    made = checked.mapInArrow(assign, f"{kinds}, distance double, cell bigint, files bigint")
    part = F.pmod(F.xxhash64("id"), F.col("files"))
    made.repartition("cell", part).drop("files").write.partitionBy("cell").mode("overwrite").parquet(f"{path}/cells")
    rows = [
        (int(c), centres[c].tolist(), int(sizes[c])) for c in range(len(centres))
    ]
    spark = vectors.sparkSession
    spark.createDataFrame(rows, "cell long, centre array<double>, n long").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    return open_cells(spark, path, made.drop("files").schema)


def open_cells(spark: SparkSession, path: str, schema=None) -> CellIndex:
    """An index written earlier; radii come from the stored distances."""
    centres = sorted(spark.read.parquet(f"{path}/centres").collect(), key=lambda r: r["cell"])
    reader = spark.read if schema is None else spark.read.schema(schema)
    vectors = reader.parquet(f"{path}/cells").withColumn("cell", F.col("cell").cast("bigint"))
    radii = np.zeros(len(centres))
    for row in vectors.groupBy("cell").agg(F.max("distance").alias("r")).collect():
        radii[row["cell"]] = row["r"]
    return CellIndex(
        vectors.drop("distance"), np.asarray([r["centre"] for r in centres]), np.asarray([r["n"] for r in centres]), radii
    )


def _read(index: CellIndex, cells: np.ndarray) -> DataFrame:
    """The rows of some cells: a filter on the partition column, so no other folder is listed or read."""
    return index.vectors.where(F.col("cell").isin([int(c) for c in cells]))


def _scan_cells(index: CellIndex, names: np.ndarray, unit: np.ndarray, asks: np.ndarray, schema, k: int, digits: int) -> DataFrame:
    """Partial hits; ``asks[query, cell]`` tells who meets whom. Queries go to every task as one matrix."""
    shared = index.vectors.sparkSession.sparkContext.broadcast((names, unit, np.packbits(asks.T, axis=1)))
    count = len(names)
    id_types = [to_arrow_type(f.dataType) for f in schema.fields[:2]]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix, asked = shared.value
        top = _TopK(matrix, k, digits)
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("cell").to_numpy()
            keep, rows = _unit_rows(_matrix(batch.column("embedding")))
            ids = _ids(batch.column("id"))[keep]
            for one in np.unique(cell[keep]):
                own = np.flatnonzero(cell[keep] == one)
                queries = np.flatnonzero(np.unpackbits(asked[one], count=count))
                top.add(ids[own], rows[own], queries)
        yield pa.RecordBatch.from_pydict(top.columns(names, id_types))

    return _read(index, np.flatnonzero(asks.any(axis=0))).select("id", "embedding", "cell").mapInArrow(best, schema)


def _probes(unit: np.ndarray, index: CellIndex, probes: int) -> np.ndarray:
    """asks[query, cell] of the ``probes`` nearest cells."""
    nearness = unit @ index.centres.T - (index.centres**2).sum(axis=1) / 2
    asks = np.zeros(nearness.shape, bool)
    chosen = np.argsort(-nearness, axis=1, kind="stable")[:, :probes]
    np.put_along_axis(asks, chosen, True, axis=1)
    return asks


def _blocks(query_vectors: DataFrame, index: CellIndex, top_k: int, query_bytes: int) -> list[DataFrame]:
    """The queries in blocks whose matrix, hits and choice of cells stay within ``query_bytes``."""
    need, _ = query_matrix_bytes(query_vectors, top_k)
    rows = query_vectors.select("query_id", "embedding")
    if need == 0:
        return []
    need += rows.count() * 8 * len(index.centres)
    parts = math.ceil(need / query_bytes)
    if parts == 1:
        return [rows]
    written = write_table(
        rows.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(parts))), scratch_root(rows.sparkSession)
    )
    return [written.where(F.col("_block") == n).drop("_block") for n in range(parts)]


def _each_block(index: CellIndex, query_vectors: DataFrame, top_k: int, query_bytes: int, scan) -> DataFrame:
    """Hits of all blocks; each is one job over the cells it asks for, and written if there are several."""
    schema = _hit_schema(query_vectors, index.vectors)
    spark = index.vectors.sparkSession
    blocks, found = _blocks(query_vectors, index, top_k, query_bytes) if index.sizes.any() else [], None
    for block in blocks:
        rows = block.collect()
        kept, unit = _unit_rows([r["embedding"] for r in rows])
        names = np.asarray([rows[i]["query_id"] for i in kept])
        if not len(names):
            continue
        if unit.shape[1] != index.centres.shape[1]:
            raise ValueError(f"query vector is not of length {index.centres.shape[1]}")
        hits = scan(names, unit, schema)
        hits = hits if len(blocks) == 1 else write_table(hits, scratch_root(spark))
        found = hits if found is None else found.unionByName(hits)
    return rank_hits(spark.createDataFrame([], schema) if found is None else found, top_k)


def search_cells(
    index: CellIndex, query_vectors: DataFrame, top_k: int = 10, probes: int | None = None, digits: int = 6,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, id, score, rank) among the ``probes`` nearest cells of each query; exact scores.

    By default a third of the cells is asked. A query can get fewer than
    ``top_k`` hits if its cells hold fewer rows. A query table beyond
    ``query_bytes`` is searched block by block.
    """
    probes = probes or math.ceil(len(index.centres) * PROBES)

    def scan(names, unit, schema):
        return _scan_cells(index, names, unit, _probes(unit, index, probes), schema, top_k, digits)

    return _each_block(index, query_vectors, top_k, query_bytes, scan)


def search_bounded(
    index: CellIndex, query_vectors: DataFrame, top_k: int = 10, probes: int | None = None, digits: int = 6,
    query_bytes: int = QUERY_BYTES, report: list | None = None,
) -> DataFrame:
    """The hits of ``nearest.search_vector``, read from fewer cells.

    The nearest cells give a k-th score per query; a cell is read afterwards
    only for queries whose bound for it reaches that score. ``report`` gets the
    share of all pairs of query and vector that were scored, per block.
    """
    probes = probes or max(1, math.ceil(len(index.centres) ** 0.5 / 2))

    def scan(names, unit, schema):
        first = _probes(unit, index, probes)
        spark = index.vectors.sparkSession
        begun = write_table(_scan_cells(index, names, unit, first, schema, top_k, digits), scratch_root(spark))
        floors = {r["query_id"]: r["score"] for r in rank_hits(begun, top_k).where(F.col("rank") == top_k).collect()}
        floor = np.asarray([floors.get(n, 0.0) for n in names.tolist()])
        cosine = np.minimum(1.0, unit @ index.centres.T + index.radii + SLACK)
        step = 10.0**digits
        bound = np.floor((1 + cosine) / 2 * step + 0.5) / step
        rest = ~first & (bound >= floor[:, None]) & (index.sizes > 0)
        if report is not None:
            report.append(float(((first | rest) * index.sizes).sum() / max(1, len(names) * index.sizes.sum())))
        if not rest.any():
            return begun
        return begun.unionByName(_scan_cells(index, names, unit, rest, schema, top_k, digits))

    return _each_block(index, query_vectors, top_k, query_bytes, scan)
