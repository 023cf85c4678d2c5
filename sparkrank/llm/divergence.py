"""How far the word use of sources of one language lies apart, exactly and for all pairs.

The counts of a language are a matrix of groups (sources) and terms, cut into
blocks of terms. A block is held as a K-squared quadtree with K = 2: a bitmap
per level tells which quadrants hold a count at all. All pairs of groups
descend together: where both have an all-zero quadrant, its terms cost the same
difference each, so their number times that is the whole price; everything else
is followed to the leaves.

Terms go to parts by their hash and groups to tiles of ``TILE``; a cell is two
tiles of one part, so no task ever holds a whole language, source or term
vocabulary. Terms that neither tile of a cell has are priced from their number.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrank.functions.ranking import top_k
from sparkrank.functions.sizing import broadcast_if_within
from sparkrank.llm.counting import Tally, parts_of
from sparkrank.llm.shared import Batches, in_batches, kept, width

MIN_DOCUMENTS, SMOOTHING, UNIT, TERMS = 30, 5, 1_000_000_000, 50
#: Groups of a tile, and leaves of pairs that are visited at a time; they are some 50 MB.
TILE, LEAVES = 64, 1 << 20
#: Everything that parts terms becomes a space, A-Z become a-z, all other bytes stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents, summed within tasks only."""

    def rows(key, occurrences, documents) -> pa.RecordBatch:
        terms = pa.array(list(occurrences), pa.binary()).cast(pa.string())
        size = len(terms)
        columns = [pa.array([k] * size, pa.string()) for k in key]
        n = pa.array(list(occurrences.values()), pa.int64())
        d = pa.array([documents[t] for t in occurrences], pa.int64())
        return pa.RecordBatch.from_arrays([*columns, terms, n, d], names=["lang", "source", "term", "n", "d"])

    def run(batches: Batches) -> Batches:
        tally = Tally(rows)
        for batch in batches:
            for key, text in zip(zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True), batch.column(2), strict=True):
                folded = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(FOLD)
                seen = set()
                for part in parts_of(folded):
                    tally.add(key, part.split(), seen)
                yield from tally.flushed()
        yield from tally.flushed(last=True)

    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    given = in_batches(docs.select(*empty, "text"))
    return given.mapInArrow(run, "lang string, source string, term string, n bigint, d bigint")


def _share(n: str, whole: str) -> Column:
    """1 + floor(UNIT * (n + SMOOTHING) / whole), in whole numbers of up to 38 digits."""
    return F.expr(f"1 + (cast({n} + {SMOOTHING} as decimal(28, 0)) * {UNIT}) div cast({whole} as decimal(28, 0))")


class Tables(NamedTuple):
    """entries(lang, source, term, n, p, q) of kept terms and groups(lang, source, gid, v, z, p of a zero count)."""

    entries: DataFrame
    groups: DataFrame


def tables(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> Tables:
    term = Window.partitionBy("lang", "term")
    counts = (
        term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
        .withColumn("total", F.sum("n").over(term))
        .withColumn("lead", F.col("source") == F.min("source").over(term))
        .withColumn("d", F.sum("d").over(term)).where(F.col("d") >= min_documents)
    )
    counts = kept(counts.select("lang", "source", "term", "n", "total", "lead"))
    found = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.sum(F.col("lead").cast("bigint")).alias("leads"))
    lang = Window.partitionBy("lang")
    groups = (
        docs.select(*found).distinct().join(own, ["lang", "source"], "left").na.fill(0, ["own", "leads"])
        .withColumn("gid", F.row_number().over(lang.orderBy("source")).cast("bigint") - 1)
        .withColumn("groups", F.count("*").over(lang))
        .withColumn("v", F.sum("leads").over(lang))
        .withColumn("all", F.sum("own").over(lang) + F.col("v") * SMOOTHING)
        .withColumn("own", F.col("own") + F.col("v") * SMOOTHING)
    )
    groups = kept(groups.withColumn("z", F.when(F.col("v") > 0, _share("0L", "own")).otherwise(F.lit(0).cast("bigint"))))
    entries = counts.drop("lead").join(broadcast_if_within(groups.drop("leads")), ["lang", "source"])
    entries = entries.withColumn("p", _share("n", "own")).withColumn("q", _share("total", "all"))
    return Tables(entries.select("lang", "source", "gid", "groups", "term", "n", "p", "q"), groups)


class Quadtree:
    """Values of a block by group and term, with a bitmap of non-empty quadrants per level.

    The block is ``side`` rows high, a power of two, and as many squares wide as
    it needs; ``zero`` is each row's value where its count is zero. Values of
    counts above zero are never 0, which marks an empty leaf.
    """

    def __init__(self, values: np.ndarray, zero: np.ndarray):
        self.values, self.zero = values, zero
        self.levels = [values != 0]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            wide = below[0::2] | below[1::2]
            self.levels.append(wide[:, 0::2] | wide[:, 1::2])


def distances(a: Quadtree, b: Quadtree) -> np.ndarray:
    """Summed absolute differences of all rows of ``a`` and ``b``, by a joint descent.

    If both are the same tree only the part above the diagonal is complete.
    """
    side, same = len(a.values), a is b
    top = len(a.levels) - 1
    column = np.arange(a.levels[top].shape[1])
    i = j = np.zeros(len(column), np.int64)
    out, empty = np.zeros((side, side), np.int64), np.zeros((side, side), np.int64)
    for level in range(top, -1, -1):
        held = a.levels[level][i, column] | b.levels[level][j, column]
        priced = np.zeros((side >> level, side >> level), np.int64)
        np.add.at(priced, (i[~held], j[~held]), 1 << level)
        empty += priced.repeat(1 << level, 0).repeat(1 << level, 1)
        i, j, column = i[held], j[held], column[held]
        if level:
            steps = np.arange(8)
            i = (2 * i[:, None] + (steps >> 2)).ravel()
            j = (2 * j[:, None] + (steps >> 1 & 1)).ravel()
            column = (2 * column[:, None] + (steps & 1)).ravel()
            if same:
                upper = i <= j
                i, j, column = i[upper], j[upper], column[upper]
    p, q = a.values[i, column], b.values[j, column]
    p, q = np.where(p == 0, a.zero[i], p), np.where(q == 0, b.zero[j], q)
    np.add.at(out, (i, j), np.abs(p - q))
    return out + empty * np.abs(a.zero[:, None] - b.zero[None, :])


class _Cell:
    """One or two tiles of groups in one part of the terms; a block of terms is held at a time."""

    def __init__(self, key: tuple, tile: int):
        self.key, self.tile = key, tile
        self.zero = {key[2]: [], key[3]: []}
        self.sum, self.seen, self.term, self.entries, self.columns = None, 0, None, [], 0

    def header(self, gid: int, z: int) -> None:
        self.zero[gid // self.tile].append(z)

    def open(self) -> None:
        most = max(map(len, self.zero.values()))
        self.side = 1 << max(0, (most - 1).bit_length())
        self.room = max(1, LEAVES // self.side**3) * self.side
        self.zeros = {t: np.array(z + [0] * (self.side - len(z)), np.int64) for t, z in self.zero.items()}
        self.sum = np.zeros((self.side, self.side), np.int64)

    def entry(self, gid: int, term: str, p: int) -> None:
        if self.sum is None:
            self.open()
        if term != self.term:
            if self.columns == self.room:
                self.close_block()
            self.term, self.columns = term, self.columns + 1
        self.entries.append((gid, self.columns - 1, p))

    def close_block(self) -> None:
        gid, column, p = np.array(self.entries, np.int64).T
        wide = -(-self.columns // self.side) * self.side
        trees = {}
        for tile, zero in self.zeros.items():
            own = gid // self.tile == tile
            values = np.zeros((self.side, wide), np.int64)
            values[gid[own] % self.tile, column[own]] = p[own]
            trees[tile] = Quadtree(values, zero)
        i, j = self.key[2:]
        gap = np.abs(self.zeros[i][:, None] - self.zeros[j][None, :])
        # Squares are filled up with empty terms, which are taken off again.
        self.sum += distances(trees[i], trees[j]) - (wide - self.columns) * gap
        self.seen += self.columns
        self.entries, self.columns, self.term = [], 0, None

    def rows(self) -> pa.RecordBatch:
        if self.sum is None:
            self.open()
        if self.columns:
            self.close_block()
        lang, _, i, j = self.key
        a, b = np.indices((len(self.zero[i]), len(self.zero[j]))).reshape(2, -1)
        if i == j:
            a, b = a[a < b], b[a < b]
        size = len(a)
        columns = [pa.array([lang] * size, pa.string()), pa.array(a + i * self.tile), pa.array(b + j * self.tile)]
        columns += [pa.array(self.sum[a, b]), pa.array(np.full(size, self.seen, np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "sum", "seen"])


def _search(tile: int):
    """Sums of the cells of a partition that is sorted by cell, groups before entries, entries by term."""

    def run(batches: Batches) -> Batches:
        cell = None
        for batch in batches:
            for lang, part, i, j, gid, term, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = (lang, part, i, j)
                if cell is None or cell.key != key:
                    if cell is not None:
                        yield cell.rows()
                    cell = _Cell(key, tile)
                if term is None:
                    cell.header(gid, p)
                else:
                    cell.entry(gid, term, p)
        if cell is not None:
            yield cell.rows()

    return run


def pair_distances(found: Tables, parts: int, tile: int = TILE) -> DataFrame:
    """(lang, a, b, value) for every two groups a < b of a language, by their numbers."""

    def dealt(rows: DataFrame) -> DataFrame:
        own, other = F.expr(f"gid div {tile}"), F.col("other")
        every = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(groups - 1) div {tile}"))
        rows = rows.withColumn("other", F.explode(every))
        return rows.select(
            "lang", "part", F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), "gid", "term", "p"
        )

    entries = found.entries.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(parts)))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part")
    headers = found.groups.select("lang", every, "gid", "groups", F.lit(None).cast("string").alias("term"), F.col("z").alias("p"))
    cell = ["lang", "part", "i", "j"]
    rows = dealt(headers).unionByName(dealt(entries.select("lang", "part", "gid", "groups", "term", "p")))
    rows = rows.repartition(*cell).sortWithinPartitions(*cell, F.col("term").asc_nulls_first(), "gid")
    sums = rows.mapInArrow(_search(tile), "lang string, a bigint, b bigint, sum bigint, seen bigint")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("sum").alias("sum"), F.sum("seen").alias("seen"))
    sides = broadcast_if_within(found.groups.select("lang", "gid", "v", "z"))
    for side in ("a", "b"):
        sums = sums.join(sides.select("lang", F.col("gid").alias(side), "v", F.col("z").alias(f"z_{side}")), ["lang", side])
        sums = sums if side == "b" else sums.drop("v")
    rest = (F.col("v") - F.col("seen")) * F.abs(F.col("z_a") - F.col("z_b"))
    return sums.select("lang", "a", "b", (F.col("sum") + rest).alias("value"))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, terms: int = TERMS, tile: int = TILE) -> DataFrame:
    """lang, source, part, item, value and rank: distances of sources and the terms a source uses more.

    ``docs`` has text, lang and source; null counts as empty in each, other
    columns are ignored. Every row is a document, so a repeated row counts
    twice; equal values rank by item. A source without any term takes part, one
    without another source in its language has no ``pair`` row, and an empty
    table gives no row. Texts of any length are split a few megabytes at a time.
    """
    found = tables(docs, min_documents)
    made = kept(pair_distances(found, width(docs.sparkSession), tile))
    both = made.unionByName(made.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = broadcast_if_within(found.groups.select("lang", "gid", "source"))
    pairs = both.join(names.withColumnRenamed("gid", "a"), ["lang", "a"]).join(
        names.select("lang", F.col("gid").alias("b"), F.col("source").alias("item")), ["lang", "b"]
    )
    order = [F.col("value").desc(), F.col("item").asc()]
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)).alias("rank")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked)
    more = found.entries.where("n > 0 and p > q")
    more = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return pairs.unionByName(top_k(more, terms, ["lang", "source"], order).select(*columns))
