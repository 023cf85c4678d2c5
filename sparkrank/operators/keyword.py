"""BM25 keyword search for a table of queries.

The documents of a bucket come to their task one by one, each with the terms
that any query asks for. Scores of all queries are summed for some documents at
a time and only the running k best per query are held, so neither disk nor
memory has a row per matching pair of query and document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sparkrank.functions.ranking import rank_hits
from sparkrank.functions.sizing import BROADCAST_BYTES, broadcast_if_within, join_small, measured_bytes
from sparkrank.functions.text import analyze
from sparkrank.operators.index import Index, idf

TIE_BREAKER = 0.3
K1 = 1.2
B = 0.75
#: Terms of all queries that every task holds, and their k best; a larger query table meets the postings in a join.
TERM_BYTES = 32 * 1024 * 1024
HIT_BYTES = 128 * 1024 * 1024
#: Scores of pairs of query and document that a task holds at once.
BLOCK_CELLS = 1_000_000


def query_terms(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, tok, qtf); a repeated term counts every time."""
    stop = list(index.stop) if index.stop is not None else None
    toks = analyze(F.col("query"), index.stem, stop)
    return (
        queries.select("query_id", F.explode(toks).alias("tok"))
        .groupBy("query_id", "tok")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def term_weights(index: Index, terms: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(query_id, field, tok, weight, avgdl): all of the score that no document changes."""
    boost = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    stats = index.field_stats.where(F.col("field").isin(list(weights)))
    return (
        index.term_stats.join(terms, "tok")
        .join(F.broadcast(stats), "field")
        .select(
            "query_id", "field", "tok", "avgdl",
            (F.col("qtf") * boost[F.col("field")] * idf(F.col("n"), F.col("df"))).alias("weight"),
        )
    )


def best_fields(scores: list[Column], tie_breaker: float) -> Column:
    """Best field plus ``tie_breaker`` times the others."""
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    total = scores[0]
    for s in scores[1:]:
        total = total + s
    return best + F.lit(tie_breaker) * (total - best)


def field_scores(
    index: Index,
    queries: DataFrame,
    fields: dict[str, float] | None = None,
    k1: float = K1,
    b: float = B,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(query_id, id, _s0, _s1, ..): weighted score per field of every document that shares a term with the query.

    Only the folders of the queries' tokens are read. The query side is
    measured, and broadcast while it is within ``broadcast_bytes``, so the
    postings are scanned in place; they are bucketed by id, so the sums per
    (query_id, id) need no shuffle either.
    """
    weights = dict(fields or index.weights)
    asked = query_terms(index, queries).persist()
    size = measured_bytes(asked)
    terms = term_weights(index, F.broadcast(asked) if size <= broadcast_bytes else asked, weights)
    saturation = F.col("tf") * (k1 + 1) / (
        F.col("tf") + k1 * ((1 - b) + b * F.col("dl") / F.col("avgdl"))
    )
    part = F.col("weight") * saturation
    per_field = [
        F.sum(F.when(F.col("field") == f, part).otherwise(0.0)).alias(f"_s{i}")
        for i, f in enumerate(weights)
    ]
    found = None
    for postings in index.postings_of(asked):  # one per build; a document counts in one of them
        joined = join_small(postings, terms, ["field", "tok"], "id", broadcast_bytes, size * 2 * len(weights))
        scored = joined.groupBy("query_id", "id").agg(*per_field)
        found = scored if found is None else found.unionByName(scored)
    return found


class _Terms:
    """The (query, weight) pairs of every numbered term, and the field of each term."""

    def __init__(self, number: np.ndarray, query: np.ndarray, weight: np.ndarray, field: np.ndarray, fields: int, queries: int):
        order = np.argsort(number, kind="stable")
        self.query, self.weight, self.field = query[order], weight[order], field
        self.starts = np.searchsorted(number[order], np.arange(len(field) + 1))
        self.fields, self.queries, self.positive = fields, queries, bool((weight > 0).all())

    def scores(self, term: np.ndarray, part: np.ndarray, doc: np.ndarray, docs: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Per field a matrix of (query, document) sums, and which pairs share a term."""
        each = self.starts[term + 1] - self.starts[term]
        at = np.repeat(self.starts[term] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        cell = (np.repeat(self.field[term], each) * self.queries + self.query[at]) * docs + np.repeat(doc, each)
        shape = (self.fields, self.queries, docs)
        sums = np.bincount(cell, self.weight[at] * np.repeat(part, each), np.prod(shape)).reshape(shape)
        if self.positive:
            return list(sums), (sums > 0).any(axis=0)
        return list(sums), np.bincount(cell, minlength=np.prod(shape)).reshape(shape).any(axis=0)


class _Best:
    """The k best (query, document, score) so far; documents come in the order of their ids."""

    def __init__(self, queries: int, k: int, digits: int):
        self.k, self.scale, self.floor = k, 10.0**digits, np.full(queries, -np.inf)
        self.kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0))
        self.new, self.waiting = [], 0

    def add(self, score: np.ndarray, found: np.ndarray, first: int) -> None:
        """Scores (query, document) of documents ``first``, ..; of equal scores the earlier document is better."""
        shown = np.where(found, np.floor(score * self.scale + 0.5) / self.scale, -np.inf)
        good = shown > self.floor[:, None]
        if shown.shape[1] > self.k and good.sum() > 2 * self.k * len(shown):
            good &= shown >= np.partition(shown, shown.shape[1] - self.k, axis=1)[:, shown.shape[1] - self.k, None]
        query, doc = np.nonzero(good)
        self.new.append((query, doc + first, score[query, doc], shown[query, doc]))
        self.waiting += len(query)
        if self.waiting > max(BLOCK_CELLS, len(self.kept[0])):
            self.prune()

    def prune(self) -> None:
        query, doc, score, shown = (np.concatenate(c) for c in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((doc, -shown, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        last = order[place == self.k - 1]
        self.floor[query[place == self.k - 1]] = shown[last]
        keep = order[place < self.k]
        self.kept = (query[place < self.k], doc[keep], score[keep], shown[keep])
        self.new, self.waiting = [], 0


def _blocks(batch: pa.RecordBatch, terms: _Terms) -> Iterator[tuple[int, int]]:
    """(first, after last) of runs of documents whose scores, and the terms they are summed from, fit a block."""
    docs = batch.num_rows
    offsets = batch.column("terms").offsets.to_numpy()
    each = np.diff(terms.starts)[batch.column("terms").flatten().field("term").to_numpy()]
    work = np.concatenate([[0], np.cumsum(each)])[offsets - offsets[0]]
    most, first = max(1, BLOCK_CELLS // max(1, terms.fields * terms.queries)), 0
    while first < docs:
        after = int(np.searchsorted(work, work[first] + 4 * BLOCK_CELLS, side="right")) - 1
        after = min(docs, first + most, max(first + 1, after))
        yield first, after
        first = after


def _near(column: pa.Array, queries: int) -> np.ndarray | None:
    """(query, document) of the second scores; the largest of several, 0 where there is none."""
    lists = column.flatten()
    if not len(lists):
        return None
    doc = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy())
    made = np.full((queries, len(column)), -np.inf)
    np.maximum.at(made, (lists.field("query").to_numpy(), doc), lists.field("near").to_numpy())
    made[np.isneginf(made)] = 0.0
    return made


def best_matches(
    index: Index,
    queries: DataFrame,
    top_k: int,
    fields: dict[str, float] | None = None,
    tie_breaker: float = TIE_BREAKER,
    k1: float = K1,
    b: float = B,
    digits: int = 4,
    boost: float = 1.0,
    near: DataFrame | None = None,
    term_bytes: int = TERM_BYTES,
) -> DataFrame | None:
    """(query_id, id, score): matches that hold the ``top_k`` best of ``boost * score`` per query by ``digits`` decimals and id.

    ``near`` (query_id, id, near) is added to the matches that it has. The
    queries' terms are collected, once measured; None if they, or ``top_k`` hits
    of each query, are too large for that. Postings are read in place, joined to
    the broadcast terms and gathered by document within its bucket.
    """
    spark, weights = queries.sparkSession, dict(fields or index.weights)
    asked = query_terms(index, queries).persist()
    names = asked.select("query_id").distinct()
    if measured_bytes(asked) * len(weights) > term_bytes or names.count() * top_k * 32 > HIT_BYTES:
        return None
    kind, id_kind = asked.schema["query_id"].dataType, index.postings.schema["id"].dataType
    schema = T.StructType([T.StructField("query_id", kind), T.StructField("id", id_kind), T.StructField("score", T.DoubleType())])
    rows = term_weights(index, F.broadcast(asked), weights).toArrow()
    if not rows.num_rows:
        return spark.createDataFrame([], schema)
    query_ids = rows["query_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    asked_by, order = query_ids.dictionary, list(weights)
    numbers: dict[tuple[str, str], int] = {}
    pairs = zip(rows["field"].to_pylist(), rows["tok"].to_pylist(), strict=True)
    number = np.array([numbers.setdefault(pair, len(numbers)) for pair in pairs])
    terms = _Terms(
        number, query_ids.indices.to_numpy().astype(np.int64), rows["weight"].to_numpy(),
        np.array([order.index(field) for field, _ in numbers]), len(order), len(asked_by),
    )
    lengths = dict(zip(rows["field"].to_pylist(), rows["avgdl"].to_pylist(), strict=True))
    vocabulary = spark.createDataFrame(
        [(field, tok, n, lengths[field]) for (field, tok), n in numbers.items()], "field string, tok string, term int, avgdl double"
    )
    shared, hybrid, id_type = spark.sparkContext.broadcast((asked_by, terms)), near is not None, to_arrow_type(id_kind)
    saturation = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * ((1 - b) + b * F.col("dl") / F.col("avgdl")))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked_by, terms = shared.value
        top, ids, seen = _Best(len(asked_by), top_k, digits), [], 0
        for whole in batches:
            if not whole.num_rows:
                continue
            ids.append(whole.column("id"))
            for first, after in _blocks(whole, terms):
                batch = whole.slice(first, after - first)
                lists = batch.column("terms")
                doc = np.repeat(np.arange(after - first), lists.value_lengths().to_numpy())
                flat = lists.flatten()
                sums, found = terms.scores(flat.field("term").to_numpy(), flat.field("part").to_numpy(), doc, after - first)
                total = sums[0]
                for more in sums[1:]:
                    total = total + more
                most = np.maximum.reduce(sums)
                score = (most + tie_breaker * (total - most)) * boost
                second = _near(batch.column("near"), len(asked_by)) if hybrid else None
                top.add(score if second is None else score + second, found, seen + first)
            seen += whole.num_rows
        top.prune()
        query, doc, score, _ = top.kept
        held = pa.chunked_array(ids).take(pa.array(doc)).combine_chunks() if ids else pa.array([], id_type)
        yield pa.RecordBatch.from_arrays([asked_by.take(pa.array(query)), held, pa.array(score)], names=["query_id", "id", "score"])

    if hybrid:
        numbered = spark.createDataFrame(
            [(q, n) for n, q in enumerate(asked_by.to_pylist())], T.StructType([T.StructField("query_id", kind), T.StructField("query", T.IntegerType())])
        )
        near = near.join(F.broadcast(numbered), "query_id").groupBy("id").agg(F.collect_list(F.struct("query", "near")).alias("near"))
        near = broadcast_if_within(near)
    made = None
    for postings in index.postings_of(asked):  # one per build; a document counts in one of them
        told = postings.join(F.broadcast(vocabulary), ["field", "tok"]).select("id", F.struct("term", saturation.alias("part")).alias("term"))
        by_doc = told.groupBy("id").agg(F.collect_list("term").alias("terms"))
        if hybrid:
            by_doc = by_doc.join(near, "id", "left")
        found = by_doc.sortWithinPartitions("id").mapInArrow(best, schema)
        made = found if made is None else made.unionByName(found)
    return made


def combined(matches: DataFrame, tie_breaker: float) -> DataFrame:
    """(query_id, id, score) of the scores per field in ``matches``."""
    per_field = [F.col(c) for c in matches.columns if c.startswith("_s")]
    return matches.select("query_id", "id", best_fields(per_field, tie_breaker).alias("score"))


def keyword_scores(
    index: Index,
    queries: DataFrame,
    fields: dict[str, float] | None = None,
    tie_breaker: float = TIE_BREAKER,
    k1: float = K1,
    b: float = B,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(query_id, id, score) of every document that shares a term with the query."""
    return combined(field_scores(index, queries, fields, k1, b, broadcast_bytes), tie_breaker)


def search_keyword(
    index: Index,
    queries: DataFrame,
    top_k: int = 10,
    fields: dict[str, float] | None = None,
    tie_breaker: float = TIE_BREAKER,
    k1: float = K1,
    b: float = B,
    digits: int = 4,
    matches: DataFrame | None = None,
) -> DataFrame:
    """(query_id, id, score, rank): the ``top_k`` best per query; ``matches`` = written ``field_scores``.

    Without ``matches`` only the best of each task leave it (``best_matches``);
    a query table too large for that has its matches summed in a join.
    """
    scored = best_matches(index, queries, top_k, fields, tie_breaker, k1, b, digits) if matches is None else None
    if scored is None:
        scored = combined(field_scores(index, queries, fields, k1, b) if matches is None else matches, tie_breaker)
    return rank_hits(scored.withColumn("score", F.round("score", digits)), top_k)
