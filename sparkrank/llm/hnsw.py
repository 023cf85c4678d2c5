"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors are dealt into shards by hash; every shard is one row of flat arrays:
vectors, ids and, per level, a matrix of neighbour numbers. A search descends
from the entry point to the bottom level and widens there to a beam; the results
of all shards are merged and scored exactly. Largest inner product becomes
nearest neighbour by one more coordinate, sqrt(R^2 - |x|^2) with R the largest
length of the shard.

Building and searching work on many vectors in lock step, so that numpy does the
work: vectors are inserted in batches, each searched on the graph so far and
within its batch; links are chosen by the usual rule, which skips a candidate
that is closer to a link already chosen, so groups of near copies stay connected
to the rest. Equal vectors are one node with their smallest ids.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.shared import Batches, kept
from sparkrank.llm.vectors import BLOCK, Queries, best, matrix, query_blocks, representatives, top_rows, union, usable

#: Different vectors per shard, about; at 64 dimensions a shard is 5 MB.
SHARD = 8_192
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 96, 192
#: Vectors inserted or searched together, and candidates expanded per step.
TOGETHER, EXPAND = 256, 4
SEED = 7


class Graph(NamedTuple):
    """``x``: vectors with the added coordinate; ``links[l][i]``: neighbours of node i on level l, -1 if none.

    Node 0 is on the highest level, where every search begins.
    """

    x: np.ndarray
    links: list[np.ndarray]


def _similar(x: np.ndarray, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Products of each query with its own nodes; -inf for no node."""
    scores = np.einsum("bd,bnd->bn", q, x[nodes])
    scores[nodes < 0] = -np.inf
    return scores


def _unique(nodes: np.ndarray) -> np.ndarray:
    """Repeated nodes of a row become -1."""
    order = np.argsort(nodes, axis=1, kind="stable")
    ordered = np.take_along_axis(nodes, order, 1)
    again = np.zeros(nodes.shape, bool)
    again[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
    ordered[again] = -1
    np.put_along_axis(nodes, order, ordered, 1)
    return nodes


def beam_search(graph: Graph, q: np.ndarray, start: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` best nodes found per query (-1 if fewer) and their products, best first."""
    b, n = len(q), len(graph.x)
    seen = np.zeros((b, n + 1), bool)  # the last column takes the -1
    rows = np.arange(b)[:, None]
    nodes = np.full((b, beam), -1, np.int64)
    scores = np.full((b, beam), -np.inf, np.float32)
    nodes[:, : start.shape[1]], scores[:, : start.shape[1]] = start, _similar(graph.x, q, start)
    done = nodes < 0
    seen[rows, nodes] = True
    links, active = graph.links[level], np.arange(b)
    while len(active):
        own, at = nodes[active], np.arange(len(active))[:, None]
        waiting = np.where(done[active], -np.inf, scores[active])
        pick = np.argpartition(-waiting, EXPAND - 1, axis=1)[:, :EXPAND] if beam > EXPAND else np.tile(np.arange(beam), (len(active), 1))
        live = waiting[at, pick] > -np.inf
        done[active[:, None], pick] = True
        chosen = np.where(live, own[at, pick], -1)
        found = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(active), -1)
        found[seen[active[:, None], found]] = -1
        found = _unique(found)
        seen[active[:, None], found] = True
        new = _similar(graph.x, q[active], found)
        all_scores = np.hstack([scores[active], new.astype(np.float32)])
        all_nodes = np.hstack([own, found])
        all_done = np.hstack([done[active], found < 0])
        keep = np.argpartition(-all_scores, beam - 1, axis=1)[:, :beam]
        nodes[active], scores[active], done[active] = all_nodes[at, keep], all_scores[at, keep], all_done[at, keep]
        active = active[(~done[active]).any(axis=1)]
    order = np.argsort(-scores, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(scores, order, 1)


def choose_links(x: np.ndarray, q: np.ndarray, nodes: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` links per query from its candidates, best first, -1 if fewer.

    A candidate is taken if it is nearer to the query than to any link taken
    before; left-over places go to the best of the others.
    """
    c = nodes.shape[1]
    between = np.einsum("bcd,bed->bce", x[nodes], x[nodes])
    taken = np.zeros(nodes.shape, bool)
    number = np.zeros(len(q), np.int64)
    nearest = np.full(nodes.shape, -np.inf, np.float32)  # to any link taken
    # Products rank by distance as all vectors have the same length.
    for i in range(c):
        take = (nodes[:, i] >= 0) & (number < most) & (scores[:, i] > nearest[:, i])
        taken[:, i] = take
        number += take
        nearest[take] = np.maximum(nearest[take], between[take, i, :])
    rank = np.where(nodes < 0, 2 * c, np.where(taken, 0, c)) + np.arange(c)
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    links = np.take_along_axis(nodes, order, 1)
    if links.shape[1] < most:
        links = np.hstack([links, np.full((len(q), most - links.shape[1]), -1, links.dtype)])
    return links


def _add_back(graph: Graph, level: int, new: np.ndarray, chosen: np.ndarray) -> None:
    """Links from the chosen nodes back to the new ones; full lists are chosen anew."""
    links = graph.links[level]
    source, target = np.repeat(new, chosen.shape[1]), chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    first = np.searchsorted(target, target)
    nth = np.arange(len(target)) - first
    nodes, at = np.unique(target, return_inverse=True)
    for begin in range(0, len(nodes), TOGETHER):
        mine = slice(begin, begin + TOGETHER)
        inside = (at >= begin) & (at < begin + TOGETHER)
        extra = np.full((len(nodes[mine]), int(nth[inside].max()) + 1), -1, np.int64)
        extra[at[inside] - begin, nth[inside]] = source[inside]
        candidates = _unique(np.hstack([links[nodes[mine]], extra]))
        q = graph.x[nodes[mine]]
        scores = _similar(graph.x, q, candidates)
        order = np.argsort(-scores, axis=1, kind="stable")[:, : 4 * links.shape[1]]
        candidates, scores = np.take_along_axis(candidates, order, 1), np.take_along_axis(scores, order, 1)
        full = (candidates >= 0).sum(axis=1) > links.shape[1]
        links[nodes[mine][~full]] = candidates[~full][:, : links.shape[1]]
        if full.any():
            links[nodes[mine][full]] = choose_links(graph.x, q[full], candidates[full], scores[full], links.shape[1])


def descend(graph: Graph, q: np.ndarray, upto: int) -> np.ndarray:
    """The best node per query on the levels above ``upto``, from the entry point down."""
    at = np.zeros((len(q), 1), np.int64)
    for level in range(len(graph.links) - 1, upto, -1):
        at = beam_search(graph, q, at, level, EXPAND)[0][:, :1]
    return at


def build(
    vectors: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = SEED
) -> tuple[Graph, np.ndarray]:
    """The graph of one shard, and which vector each of its nodes is."""
    n = len(vectors)
    length = np.sqrt((vectors**2).sum(axis=1))
    top = length.max(initial=0)
    x = vectors / (top or 1.0)
    x = np.hstack([x, np.sqrt(np.maximum(0, 1 - (length / (top or 1.0)) ** 2))[:, None]]).astype(np.float32)
    level = np.minimum(np.random.default_rng(seed).exponential(1 / np.log(links), n).astype(int), 8)
    order = np.argsort(-level, kind="stable")  # the entry point and the sparse levels first
    x, level = x[order], level[order]
    most = int(level.max(initial=0))
    flat = [np.full((n, 2 * links if at == 0 else links), -1, np.int64) for at in range(most + 1)]
    graph = Graph(x, flat)
    done = 1
    while done < n:
        size = min(TOGETHER, max(1, done), n - done)
        new = np.arange(done, done + size)
        q = x[new]
        within = q @ q.T
        at = np.zeros((size, 1), np.int64)
        for l in range(most, -1, -1):
            on = np.flatnonzero(level[new] >= l)
            found, scores = beam_search(graph, q, at, l, beam if len(on) else EXPAND)
            if len(on):
                other = np.broadcast_to(new, (len(on), size)).copy()
                own = within[on].copy()
                own[:, level[new] < l] = -np.inf
                own[np.arange(len(on)), on] = -np.inf
                other[own == -np.inf] = -1
                candidates, products = np.hstack([found[on], other]), np.hstack([scores[on], own])
                best_first = np.argsort(-products, axis=1, kind="stable")[:, :beam]
                candidates = np.take_along_axis(candidates, best_first, 1)
                products = np.take_along_axis(products, best_first, 1)
                chosen = choose_links(x, q[on], candidates, products, links)
                flat[l][new[on], :links] = chosen
                _add_back(graph, l, new[on], chosen)
            at = found[:, :1]
        done += size
    return graph, order


INDEX = (
    "shard long, dim int, ids array<binary>, x binary, original binary, "
    "width array<int>, links array<binary>"
)


def _index_rows(links: int, beam: int):
    def make(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("least")
        vectors = np.array(frame["v"].tolist(), float)
        graph, order = build(vectors, links, beam)
        ids = [np.asarray(i, np.int64).tobytes() for i in frame["ids"].iloc[order]]
        return pd.DataFrame(
            {
                "shard": [key[1]], "dim": [vectors.shape[1]], "ids": [ids], "x": [graph.x.tobytes()],
                "original": [vectors[order].tobytes()], "width": [[m.shape[1] for m in graph.links]],
                "links": [[m.astype(np.int32).tobytes() for m in graph.links]],
            }
        )

    return make


def build_index(
    vectors: DataFrame, k: int, shard: int = SHARD, links: int = LINKS, beam: int = BUILD_BEAM
) -> DataFrame:
    """One row of flat arrays per shard, written to the shared folder; every usable row is in it.

    A different vector carries its ``k`` + 1 smallest ids: with the query's own
    left out no other can be among the ``k`` nearest.
    """
    rows = representatives(usable(vectors, nonzero=True), k + 1)
    nodes = kept(
        rows.groupBy("v", "dim").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    shards = max(1, -(-nodes.count() // shard))
    dealt = nodes.select("v", "dim", "ids", F.col("ids")[0].alias("least")).withColumn(
        "shard", F.pmod(F.xxhash64("v"), F.lit(shards))
    )
    return kept(dealt.groupBy("dim", "shard").applyInPandas(_index_rows(links, beam), INDEX))


def search_shard(graph: Graph, original: np.ndarray, ids: list[np.ndarray], queries: Queries, k: int, beam: int):
    """Hits (query number, id, exact score) of one shard, the ``k`` best per query."""
    held = np.array([len(i) for i in ids])
    start, flat = np.concatenate([[0], held.cumsum()]), np.concatenate(ids)
    out = []
    for at in range(0, len(queries.ids), TOGETHER):
        exact = queries.vectors[at : at + TOGETHER]
        scale = np.abs(exact).max(axis=1, keepdims=True)
        q = np.hstack([exact / scale, np.zeros((len(exact), 1))]).astype(np.float32)
        nodes = beam_search(graph, q, descend(graph, q, 0), 0, beam)[0]
        row, col = np.nonzero(nodes >= 0)
        node = nodes[row, col]
        scores = np.einsum("nd,nd->n", exact[row], original[node])
        times = held[node]
        within = np.arange(times.sum()) - np.repeat(times.cumsum() - times, times)
        row, found = np.repeat(row, times), flat[np.repeat(start[node], times) + within]
        scores = np.repeat(scores, times)
        other = found != queries.ids[at + row]
        out.append(top_rows(at + row[other], found[other], scores[other], k))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _search(queries: Queries, k: int, beam: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                ids = [np.frombuffer(i, np.int64) for i in row["ids"]]
                n = len(ids)
                links = [
                    np.frombuffer(m, np.int32).reshape(n, w).astype(np.int64)
                    for m, w in zip(row["links"], row["width"], strict=True)
                ]
                x = np.frombuffer(row["x"], np.float32).reshape(n, -1)
                original = np.frombuffer(row["original"], np.float64).reshape(n, -1)
                number, found, scores = search_shard(Graph(x, links), original, ids, queries, k, beam)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.ids[number]), pa.array(found), pa.array(scores)],
                    names=["query_id", "vec_id", "score"],
                )

    return run


HITS = "query_id bigint, vec_id bigint, score double"


def search(
    vectors: DataFrame, is_query, k: int = 20, shard: int = SHARD, beam: int = SEARCH_BEAM, block: int = BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products found per query row.

    Candidates are all rows but those of the query's id; scores are exact, in
    double precision; ties go to the smaller vec_id. Queries pass the driver in
    blocks of ``block``, each of which searches every shard once.
    """
    spark = vectors.sparkSession
    index = build_index(vectors, k, shard)
    queries = usable(vectors, nonzero=True).where(is_query)
    parts = []
    for one in query_blocks(queries, block):
        own = index.where(F.col("dim") == one.vectors.shape[1])
        hits = own.repartition("shard").mapInArrow(_search(one, k, beam), HITS)
        parts.append(kept(best(hits, k)))
    return union(parts, best(spark.createDataFrame([], HITS), k))
