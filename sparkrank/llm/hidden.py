"""A hidden Markov language model, trained by Baum-Welch over all training documents.

A text is its words, lower-cased in A-Z, and one end. A word as frequent as
``FREQUENT`` of all training tokens emits a symbol of its own, so there are at
most 1 / FREQUENT of them whatever the corpus; any other emits the class of its
last letters, times its share of the class: counts less ``DISCOUNT`` for words
seen in training, the rest for words that are not. Counts of rare words stay a
distributed table that documents are joined with; what passes the driver are
the frequent words, the classes and the parameters, all of bounded size.

Each round of Baum-Welch adds up expected counts within tasks, then across
partitions. The forward recursion is scaled every few tokens and at the end of a
text, so likelihoods are exact for texts of any length.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.counting import Tally, parts_of
from sparkrank.llm.shared import ROWS, Batches, in_batches, kept, remainder

FOLDS, HELD_OUT = 5, 1
FREQUENT, CLASSES, LETTERS, DISCOUNT = 2e-6, 1024, 3, 0.5
STATES, ROUNDS = 8, 5
#: Chance to stay in a state, beside a move to any, before training.
STAY = 0.97
#: Share of every state's emissions that follows the frequency of the symbol.
SMOOTHED = 0.01
#: Tokens that a task runs through at a time; their arrays are some 100 MB. Long texts take fewer steps side by side.
TOKENS = 300_000
#: Tokens from one scaling to the next. An emission is at least SMOOTHED times half a token among all of training, so eight do not underflow.
SCALED = 8


#: A-Z become a-z and the white space that parts words becomes a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def words_in_parts(text: str | None) -> Iterator[list[bytes]]:
    """Words of the whole text, some megabytes at a time; the end, an empty word, comes last."""
    for part in parts_of((text or "").encode("utf-8", "surrogatepass").translate(FOLD)):
        yield part.split()
    yield [END]


END = b""


class Model(NamedTuple):
    """``first`` (states), ``moves`` (states, states) and ``emits`` (symbols, states); each sums to 1 over its outcomes."""

    first: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


def start(counts: np.ndarray, states: int = STATES) -> Model:
    """A model to begin with: states that stay, and emissions near the frequencies of the symbols."""
    rng = np.random.default_rng(len(counts))
    frequency = ((counts + 0.5) / (counts + 0.5).sum())[:, None]
    emits = frequency * np.exp(rng.normal(0, 1, (len(counts), states)))
    moves = np.full((states, states), (1 - STAY) / states) + STAY * np.eye(states)
    return Model(np.full(states, 1 / states), moves, emits / emits.sum(0))


class Batch:
    """Sequences of one symbol or more, laid out by time: the longest first, tokens of one time side by side."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        ranked = lengths[self.order]
        self.active = np.searchsorted(-ranked, -np.arange(ranked[0] if len(ranked) else 0), "left")
        self.at = np.concatenate([[0], np.cumsum(self.active)])
        rank = np.empty(len(lengths), np.int64)
        rank[self.order] = np.arange(len(lengths))
        time = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.place = self.at[time] + np.repeat(rank, lengths)
        self.symbols = np.empty(len(symbols), np.int64)
        self.symbols[self.place] = symbols
        times = np.arange(len(self.active))
        #: Times at which probabilities are scaled, among them the last one of every sequence.
        self.scaled = ((times % SCALED == SCALED - 1) | (np.diff(self.active, append=0) < 0)).tolist()

    def _steps(
        self, model: Model, now: np.ndarray | None, first: int, last: int, emits: np.ndarray | None = None,
        keep: np.ndarray | None = None,
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        """Per time: forward probabilities and, where they are scaled, scales.

        ``now`` are those of the time before ``first``, ``emits`` the emissions
        of all tokens of these times, where they are at hand. The probabilities
        are written to ``keep``, if given, a row per token.
        """
        ends, ones = self.at.tolist(), np.ones(len(model.first))
        base = ends[first]
        for t in range(first, last):
            from_, to = ends[t], ends[t + 1]
            some = np.take(model.emits, self.symbols[from_:to], 0) if emits is None else emits[from_ - base : to - base]
            out = np.empty_like(some) if keep is None else keep[from_ - base : to - base]
            if now is None:
                np.multiply(model.first, some, out=out)
            else:
                np.dot(now[: to - from_], model.moves, out=out)
                out *= some
            now, scale = out, None
            if self.scaled[t]:
                scale = now @ ones
                now /= scale[:, None]
            yield t, now, scale

    def likelihoods(self, model: Model) -> np.ndarray:
        """Logarithm (base 10) of the exact likelihood of each sequence."""
        total = np.zeros(len(self.order))
        emits = np.take(model.emits, self.symbols, 0) if len(self.symbols) <= 2 * TOKENS else None
        for t, _, scale in self._steps(model, None, 0, len(self.active), emits):
            if scale is not None:
                total[: len(scale)] += np.log10(scale)
        out = np.empty(len(total))
        out[self.order] = total
        return out

    def _blocks(self, tokens: int) -> list[int]:
        """Times at which to part the sequences so that a block has at most ``tokens``, or one time."""
        cuts, last = [0], len(self.active)
        while cuts[-1] < last:
            end = int(np.searchsorted(self.at, self.at[cuts[-1]] + tokens, "right")) - 1
            cuts.append(min(last, max(cuts[-1] + 1, end)))
        return cuts

    def expected(self, model: Model, counts: np.ndarray, tokens: int = TOKENS) -> tuple[np.ndarray, np.ndarray]:
        """Add expected emissions to ``counts`` (symbols, states); expected first states and moves.

        Forward probabilities are held for one block at a time. For more than
        one, the first sweep keeps those before each block, and they are made again.
        """
        cuts, starts = self._blocks(tokens), [None]
        moves, after, now = np.zeros_like(model.moves), None, None
        for first, last in zip(cuts[:-2], cuts[1:-1], strict=True):
            for _, now, _ in self._steps(model, now, first, last):
                pass
            starts.append(now)
        for block in range(len(cuts) - 2, -1, -1):
            first, last = cuts[block], cuts[block + 1]
            base, own = self.at[first], slice(self.at[first], self.at[last])
            alpha = np.empty((self.at[last] - base, len(model.first)))
            weight = np.take(model.emits, self.symbols[own], 0)
            ends = (self.at - base).tolist()
            for t, _, scale in self._steps(model, starts[block], first, last, weight, alpha):
                if scale is not None:
                    weight[ends[t] : ends[t + 1]] /= scale[:, None]
            beta, back = np.ones_like(alpha), np.ascontiguousarray(model.moves.T)
            for t in range(last - 1, first - 1, -1):
                here, there = ends[t], ends[t + 1]
                if after is not None:
                    np.dot(after, back, out=beta[here : here + len(after)])
                after = weight[here:there]
                after *= beta[here:there]
            # Pairs of each place with the one before: within the block, then across its start.
            active = self.active[first:last]
            later = np.arange(active[0], len(alpha))
            moves += np.take(alpha, later - np.repeat(active[:-1], active[1:]), 0).T @ weight[active[0] :]
            if block:
                moves += starts[block][: active[0]].T @ weight[: active[0]]
            alpha *= beta
            cells = self.symbols[own][:, None] * len(model.first) + np.arange(len(model.first))
            counts += np.bincount(cells.ravel(), alpha.ravel(), counts.size).reshape(counts.shape)
            begun = alpha[: active[0]].sum(0)
        return (begun if len(cuts) > 1 else np.zeros_like(model.first)), model.moves * moves


def improved(first: np.ndarray, moves: np.ndarray, emits: np.ndarray, counts: np.ndarray) -> Model:
    """The model of expected counts, its emissions mixed with the frequencies of the symbols."""
    frequency = ((counts + 0.5) / (counts + 0.5).sum())[:, None]
    held = np.maximum(emits.sum(0), 1e-300)
    moves = moves + 1e-6
    first = first + 1e-6
    return Model(first / first.sum(), moves / moves.sum(1)[:, None], (1 - SMOOTHED) * emits / held + SMOOTHED * frequency)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all words and ends of ``docs``."""

    def rows(_, occurrences, __) -> pa.RecordBatch:
        words = pa.array(list(occurrences), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(occurrences.values()), pa.int64())], names=["word", "c"])

    def run(batches: Batches) -> Batches:
        tally = Tally(rows)
        for batch in batches:
            for text in batch.column(0):
                for words in words_in_parts(text.as_py()):
                    tally.add(None, words)
                yield from tally.flushed()
        yield from tally.flushed(last=True)

    made = in_batches(docs.select("text")).mapInArrow(run, "word string, c bigint")
    return made.groupBy("word").agg(F.sum("c").alias("c"))


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-LETTERS:]) % CLASSES


def _class(word: str) -> Column:
    return (F.crc32(F.substring(F.col(word).cast("binary"), -LETTERS, LETTERS)) % CLASSES).cast("int")


class Vocabulary(NamedTuple):
    """Counts(word, c) of all training tokens, and what is small of them.

    ``own`` maps frequent words to (symbol, c); ``symbols`` counts the tokens of
    every symbol, those of the ``own`` first, then the classes; ``types`` is the
    number of words of every class.
    """

    counts: DataFrame
    tokens: int
    words: int
    own: dict[bytes, tuple[int, int]]
    symbols: np.ndarray
    types: np.ndarray

    @property
    def whole(self) -> float:
        return self.tokens + 0.5 * (self.words + 1)


def vocabulary(train: DataFrame) -> Vocabulary:
    counts = kept(word_counts(train))
    tokens, words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = F.col("c") >= tokens * FREQUENT
    own = counts.where(frequent).toArrow()
    found = sorted(zip((-c for c in own.column("c").to_pylist()), map(str.encode, own.column("word").to_pylist()), strict=True))
    own = {word: (at, -c) for at, (c, word) in enumerate(found)}
    symbols, types = np.zeros(len(own) + CLASSES), np.zeros(CLASSES)
    symbols[: len(own)] = [c for _, c in own.values()]
    rare = counts.where(~frequent).groupBy(_class("word").alias("class")).agg(F.sum("c").alias("c"), F.count("*").alias("types"))
    for row in rare.collect():
        symbols[len(own) + row["class"]], types[row["class"]] = row["c"], row["types"]
    return Vocabulary(counts, tokens, words, own, symbols, types)


def _numbered(words: list[bytes], own: dict[bytes, int]) -> tuple[np.ndarray, list[bytes]]:
    """Symbols of ``words``, and those of them that emit the symbol of their class."""
    symbols = np.fromiter(map(own.get, words, repeat(-1)), np.int32, len(words))
    at = np.flatnonzero(symbols < 0)
    others = [words[i] for i in at.tolist()]
    symbols[at] = [len(own) + class_of(word) for word in others]
    return symbols, others


def encoded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """_row, doc_id, held_out, n_tokens, symbols, base (of frequent words), rare and times (the other words) per row."""
    own, whole = known.own, known.whole
    names = ["_row", "doc_id", "held_out", "n_tokens", "symbols", "base", "rare", "times"]

    def make(batches: Batches) -> Batches:
        number = {word: at for word, (at, _) in own.items()}
        logs = np.zeros(len(own) + CLASSES)
        logs[: len(own)] = [math.log10((c + 0.5) / whole) for _, c in own.values()]
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, ROWS):
                batch = whole_batch.slice(at, ROWS)
                symbols, base, rare = [], [], []
                for text in batch.column(3):
                    parts, others = [], Counter()
                    for words in words_in_parts(text.as_py()):
                        part, few = _numbered(words, number)
                        others.update(few)
                        parts.append(part)
                    symbols.append(np.concatenate(parts))
                    base.append(float(logs[symbols[-1]].sum()))
                    rare.append(others)
                size = np.array([len(one) for one in symbols], np.int64)
                ends, flat = _offsets(size), pa.array([w for one in rare for w in one], pa.binary()).cast(pa.string())
                kinds = _offsets(np.array([len(one) for one in rare], np.int64))
                times = pa.array([n for one in rare for n in one.values()], pa.int64())
                columns = [*batch.columns[:3], pa.array(size), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(symbols)))]
                columns += [pa.array(base), pa.ListArray.from_arrays(kinds, flat), pa.ListArray.from_arrays(kinds, times)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"_row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, symbols array<int>, base double, "
        "rare array<string>, times array<bigint>"
    )
    return in_batches(docs.select("_row", "doc_id", "held_out", "text")).mapInArrow(make, schema)


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def _batches(batches: Batches, column: int) -> Iterator[tuple[list[pa.RecordBatch], Batch]]:
    """Rows of about ``TOKENS`` tokens together, and their sequences."""
    held, size = [], 0

    def closed() -> tuple[list[pa.RecordBatch], Batch]:
        arrays = [b.column(column) for b in held]
        lengths = np.concatenate([a.value_lengths().to_numpy() for a in arrays]).astype(np.int64)
        return held, Batch(np.concatenate([a.flatten().to_numpy() for a in arrays]).astype(np.int64), lengths)

    for whole in batches:
        ends = np.cumsum(whole.column(column).value_lengths().to_numpy())
        at = 0
        while at < whole.num_rows:
            done = int(ends[at - 1]) if at else 0
            until = max(at + 1, int(np.searchsorted(ends, done + TOKENS - size, "right")))
            held.append(whole.slice(at, until - at))
            size += int(ends[until - 1]) - done
            at = until
            if size >= TOKENS or at < whole.num_rows:
                yield closed()
                held, size = [], 0
    if held:
        yield closed()


def train(sequences: DataFrame, symbols: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all rows of ``sequences(symbols)``; expected counts are summed across partitions."""
    model = start(symbols, states)
    names = [f"s{k}" for k in range(states)]
    for _ in range(rounds):

        def expect(batches: Batches, model: Model = model) -> Batches:
            counts, first, moves = np.zeros_like(model.emits), np.zeros(states), np.zeros((states, states))
            for _, batch in _batches(batches, 0):
                more = batch.expected(model, counts)
                first, moves = first + more[0], moves + more[1]
            seen = np.flatnonzero(counts.any(1))
            rows = np.vstack([first, moves, counts[seen]])
            number = np.concatenate([-1 - np.arange(states + 1), seen])
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), *map(pa.array, rows.T.copy())], names=["number", *names])

        schema = ", ".join(["number bigint", *[f"{name} double" for name in names]])
        made = in_batches(sequences.select("symbols")).mapInArrow(expect, schema)
        summed = made.groupBy("number").agg(*[F.sum(name).alias(name) for name in names]).toArrow()
        number = summed.column("number").to_numpy()
        values = np.stack([summed.column(name).to_numpy() for name in names], 1)
        whole = np.zeros((states + 1 + len(symbols), states))
        whole[np.where(number < 0, -1 - number, states + 1 + number)] = values
        model = improved(whole[0], whole[1 : states + 1], whole[states + 1 :], symbols)
    return model


def likelihoods(sequences: DataFrame, model: Model) -> DataFrame:
    """``sequences`` without symbols, rare and times, with ``likelihood`` of their symbols (log10)."""
    columns = [c for c in sequences.columns if c not in ("symbols", "rare", "times")]

    def run(batches: Batches) -> Batches:
        for held, batch in _batches(batches, len(columns)):
            rows = pa.Table.from_batches(held).drop_columns(["symbols"])
            yield from rows.append_column("likelihood", pa.array(batch.likelihoods(model))).to_batches()

    fields = ", ".join(f"`{c}` {sequences.schema[c].dataType.simpleString()}" for c in columns)
    return in_batches(sequences.select(*columns, "symbols")).mapInArrow(run, f"{fields}, likelihood double")


def _rare_sums(sequences: DataFrame, known: Vocabulary) -> DataFrame:
    """(_row, rare_base, rest, unknown): of the words that are not frequent, by their counts in all training documents."""
    spark = sequences.sparkSession
    sizes = list(zip(range(CLASSES), known.symbols[len(known.own) :].tolist(), known.types.tolist(), strict=True))
    classes = F.broadcast(spark.createDataFrame(sizes, "class int, class_c double, types double"))
    every = sequences.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    every = every.select("_row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    # One long sorts faster than the words; the words decide.
    given = known.counts.select(F.xxhash64("word").alias("h"), F.col("word").alias("known"), "c")
    same = (F.xxhash64("word") == F.col("h")) & ~(F.col("word") != F.col("known"))
    rows = every.join(given, same, "left").select("_row", "times", "c", _class("word").alias("class"))
    rows = rows.repartition("_row").join(classes, "class")
    seen = F.col("c").isNotNull()
    weight = F.when(seen, F.col("c") - DISCOUNT).otherwise(DISCOUNT * F.col("types") + DISCOUNT)
    base = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(known.whole))
    return rows.groupBy("_row").agg(
        F.sum(F.col("times") * base).alias("rare_base"),
        F.sum(F.col("times") * F.log10(weight / (F.col("class_c") + DISCOUNT))).alias("rest"),
        F.sum(F.when(seen, 0).otherwise(F.col("times"))).alias("unknown"),
    )


def score_documents(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per row.

    The model learns from the documents whose checksum of the id, modulo
    ``FOLDS``, is not ``HELD_OUT`` (a null id counts as 0) and scores all. Null
    and empty texts are one end. Repeated rows are scored, and learnt from, each
    by itself; of an empty table nothing is learnt and no row comes back. All
    counts come from whole texts of all training documents. Other columns are
    ignored, whatever their names.
    """
    held_out = (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    rows = docs.select("doc_id", held_out, "text")
    known = vocabulary(rows.where("NOT held_out"))
    # Sequences of about one length together take the fewest steps.
    sequences = kept(encoded(rows.withColumn("_row", F.monotonically_increasing_id()), known).sortWithinPartitions("n_tokens"))
    model = train(sequences.where("NOT held_out"), known.symbols, states, rounds)
    scored = likelihoods(sequences, model).join(_rare_sums(sequences, known), "_row", "left").na.fill(0)
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_tokens") - F.col("unknown")).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.col("rare_base")).alias("base_score"), (F.col("likelihood") + F.col("rest")).alias("score"),
    )
