"""Best-fit packing of tokenised documents into sequences under several capacities.

A sequence has three capacities: tokens, documents and attention cost (the sum
of squared piece lengths). All three needs of a piece follow from its length, so
pieces of one length are alike and the whole table is packed from the histogram
of lengths, which has no more entries than a sequence has tokens, however many
documents there are. ``plan`` places lengths from the longest down; sequences in
the same state are one entry, and the piece goes to the state that the vector
rule prefers among those that hold it under every capacity. Pieces then look up
their place by their number among the pieces of their length. Numbers are dealt
out per (length, bucket) with offsets between buckets, so one very common length
is split over many tasks.

Defined cases: a null or empty text is the single id 0; a null doc_id is packed
like any other; repeated rows are packed as often as they occur; an empty table
gives no row.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Callable
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrank.llm.shared import Batches, in_batches, kept, texts, width

TOKENS = 2048
#: Words kept per generation in a Python worker, about 100 MB in the two.
WORDS = 400_000
#: A word of Latin letters and the punctuation after it, which the tokenizer cuts
#: off; without the one letter that lower-cases to two code points.
SIGNS = re.compile("[!-&(-/:-@\\[-`{-~]+")
LETTERS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-/:-@\\[-`{-~]+)?")


WORD_END = "</w>"


class Merges:
    """The merges of a tokenizer file for words of Latin letters or punctuation, run by tiktoken.

    They give the ids of the tokenizer itself, as tests hold, in a tenth of the
    time. A blank stands for the word end, which no word contains; it is joined
    to the last byte first, as the tokenizer's symbols are.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        # The usual printable stand-ins of bytes.
        self.byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}
        singles = [bytes([b]) for b in range(256)]
        tokens = dict.fromkeys([*singles, *(s + b" " for s in singles)])
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            tokens[self._data(left) + self._data(right)] = None
        ranks = {token: rank for rank, token in enumerate(tokens)}
        self.ids = np.zeros(len(ranks), "<u4")
        for token, number in model["vocab"].items():
            if (data := self._data(token)) in ranks:
                self.ids[ranks[data]] = number
        self.coding = tiktoken.Encoding("merges", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def _data(self, token: str) -> bytes | None:
        word = token.removesuffix(WORD_END)
        if any(c not in self.byte for c in word):
            return None
        return bytes(self.byte[c] for c in word) + b" " * token.endswith(WORD_END)

    def encode(self, word: str) -> bytes:
        return self.ids[self.coding.encode_ordinary(word + " ")].tobytes()


class Encoder:
    """Ids of a text, as little-endian 32-bit data, word by word with a bounded memory of words.

    Only for tokenizers that lower-case and whose words end at white space and
    between letters and punctuation: ids of a text are then those of its words
    in turn. Words not seen in the last two generations are encoded together.
    """

    def __init__(self, path: str, words: int = WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges(path)
        self.words, self.old, self.new = words, {}, {}

    @staticmethod
    def _parts(word: str) -> tuple[str, ...]:
        """Parts whose ids in turn are those of the word, so that fewer different ones are encoded."""
        cut = LETTERS.fullmatch(word)
        if not cut:
            return (word,)
        letters = cut[1].lower()
        return (letters, cut[2]) if cut[2] else (letters,)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Data per text; the texts of a call should fit in memory some ten times."""
        split = [text.replace("\n", " ").replace("\t", " ").split(" ") for text in texts]
        old, new = self.old, self.new
        missing = set()
        for words in split:
            for word in set(words).difference(new):
                if word in old:
                    new[word] = old[word]
                else:
                    missing.add(word)
        if missing:
            parts = {word: self._parts(word) for word in missing}
            unknown = list({part for own in parts.values() for part in own if part not in new and part not in old})
            for part in unknown:
                if LETTERS.fullmatch(part) or SIGNS.fullmatch(part):
                    new[part] = self.merges.encode(part)
            unknown = [part for part in unknown if part not in new]
            for part, got in zip(unknown, self.tokenizer.encode_batch_fast(unknown, add_special_tokens=False), strict=True):
                new[part] = np.array(got.ids, "<u4").tobytes()
            for word, own in parts.items():
                new[word] = b"".join([new[part] if part in new else old[part] for part in own])
        found = [b"".join(map(new.__getitem__, words)) for words in split]
        if len(new) > self.words:
            self.old, self.new = new, {}
        return found


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker, so that its memory outlives a task."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, tokenizer: str | None = None, tokens: int = TOKENS, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents cut into pieces of ``tokens`` ids.

    A document is its ids, no special ones, then ``end``; only the last piece may
    be shorter. ``tokenizer`` is the path of a file as ``Encoder``
    describes, by default ``word_bpe_49k.json`` of the installed vocabularies.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    last = np.array([end], "<u4").tobytes()

    def make(batches: Batches) -> Batches:
        coder = encoder(tokenizer or default_tokenizer())
        for whole in batches:
            for from_row in range(0, whole.num_rows, 256):
                batch = whole.slice(from_row, 256)
                rows = []
                for at, data in enumerate(coder.encode(texts(batch.column(1)))):
                    data += last
                    for n, start in enumerate(range(0, len(data) // 4, tokens)):
                        part = data[4 * start : 4 * (start + tokens)]
                        rows.append((at, n, start, len(part) // 4, zlib.crc32(part)))
                at, n, start, length, crc = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        pa.array(n, pa.int32()),
                        *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                    ],
                    names=names,
                )

    return in_batches(docs.select("doc_id", "text")).mapInArrow(
        make, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


class Limits(NamedTuple):
    """Capacities of a sequence and their weights in the dot product."""

    tokens: int = TOKENS
    documents: int = TOKENS
    attention: int = TOKENS * TOKENS
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25)

    def need(self, length: int) -> tuple[int, int, int]:
        return length, 1, length * length

    def shares(self, amounts: tuple[int, ...]) -> tuple[float, ...]:
        return tuple(a / c for a, c in zip(amounts, self[:3], strict=True))

    def fits(self, need: tuple[int, ...], left: tuple[int, ...]) -> int:
        """How many such pieces fit in what is left, under every capacity."""
        return min(have // one for one, have in zip(need, left, strict=True))


def residual_norm(limits: Limits, need: tuple, left: tuple) -> float:
    """Smallest is best: what stays free, as a weighted squared norm."""
    parts = limits.shares(tuple(have - one for one, have in zip(need, left, strict=True)))
    return sum(w * p * p for w, p in zip(limits.weights, parts, strict=True))


def dot_product(limits: Limits, need: tuple, left: tuple) -> float:
    """Smallest is best: the weighted product of need and free space over the free space squared.

    The product alone prefers empty sequences; divided by the free space it asks
    how much of what is free points the way of the piece, nearly full ones first.
    """
    a, b = limits.shares(need), limits.shares(left)
    product = sum(w * x * y for w, x, y in zip(limits.weights, a, b, strict=True))
    return -product / max(sum(w * y * y for w, y in zip(limits.weights, b, strict=True)), 1e-12)


RULES: dict[str, Callable[[Limits, tuple, tuple], float]] = {"norm": residual_norm, "dot": dot_product}


class Slot(NamedTuple):
    """Pieces ``first``.. of ``length`` go, ``each`` to a sequence, to ``sequence``.. at ``offset``.."""

    length: int
    first: int
    each: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], limits: Limits, rule: str) -> tuple[list[Slot], int]:
    """Slots for all pieces and the number of sequences; lengths from the longest down.

    A state is (what is left) with runs of consecutive sequences in it. Filling a
    sequence up with pieces of the same length before taking the next is what
    the rule does piece by piece, as it prefers the fuller of two sequences.
    """
    prefer = RULES[rule]
    states: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    slots, sequences, empty = [], 0, tuple(limits[:3])
    for length in sorted(histogram, reverse=True):
        need, done, count = limits.need(length), 0, histogram[length]
        ranked = sorted(
            (left for left in states if limits.fits(need, left)), key=lambda left: (prefer(limits, need, left), left)
        )
        changed: list[tuple[tuple[int, int, int], tuple[int, int]]] = []

        def put(run: tuple[int, int], left: tuple[int, int, int]) -> int:
            """Fill ``run`` (first sequence, number); the number of sequences used."""
            nonlocal done
            most = limits.fits(need, left)
            for each in (most, (count - done) % most):
                used = min(run[1], (count - done) // each) if each else 0
                if used and (each == most or count - done < most):
                    slots.append(Slot(length, done, each, run[0], empty[0] - left[0]))
                    rest = tuple(have - each * one for one, have in zip(need, left, strict=True))
                    changed.append((rest, (run[0], used)))
                    done, run = done + used * each, (run[0] + used, run[1] - used)
            return run

        for left in ranked:
            runs, over = states.pop(left), []
            for run in runs:
                run = put(run, left) if done < count else run
                if run[1]:
                    over.append(run)
            if over:
                states[left] = over
            if done == count:
                break
        if done < count:
            opened = -(-(count - done) // limits.fits(need, empty))
            put((sequences, opened), empty)
            sequences += opened
        for rest, run in changed:
            if limits.fits((1, 1, 1), rest):
                states.setdefault(rest, []).append(run)
    return slots, sequences


def best_plan(histogram: dict[int, int], limits: Limits) -> list[Slot]:
    """The plan of the rule that takes fewer sequences; the residual norm on a tie."""
    return min((plan(histogram, limits, rule) for rule in RULES), key=lambda made: made[1])[0]


def _places(slots: list[Slot]):
    by_length: dict[int, tuple[list[int], list[Slot]]] = {}
    for s in slots:
        starts, own = by_length.setdefault(s.length, ([], []))
        starts.append(s.first)
        own.append(s)

    def place(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            lengths, numbers = batch.column("length").to_pylist(), batch.column("_number").to_pylist()
            for length, number in zip(lengths, numbers, strict=True):
                starts, own = by_length[length]
                s = own[bisect.bisect_right(starts, number) - 1]
                nth, within = divmod(number - s.first, s.each)
                rows.append((s.sequence + nth, s.offset + within * length))
            sequence, offset = zip(*rows, strict=True) if rows else ((), ())
            kept_columns = [n for n in batch.schema.names if n != "_number"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept_columns), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*kept_columns, "sequence_id", "offset"],
            )

    return place


def pack_pieces(made: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``made`` (with a ``length`` of 1 to ``limits.tokens``) plus sequence_id and offset.

    Only the histogram of lengths, at most ``limits.tokens`` rows, and the plan
    made from it pass the driver.
    """
    spark = made.sparkSession
    buckets = 4 * width(spark)
    spread = F.pmod(F.xxhash64(*made.columns), F.lit(buckets)).cast("int")
    rows = kept(made.withColumn("_bucket", spread))
    counts = rows.groupBy("length", "_bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = kept(counts.withColumn("_base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = best_plan(histogram, limits)
    inside = Window.partitionBy("length", "_bucket").orderBy(*made.columns)
    numbered = (
        rows.withColumn("_in", F.row_number().over(inside))
        .join(offsets.select("length", "_bucket", "_base"), ["length", "_bucket"])
        .select(*made.columns, (F.col("_base") + F.col("_in") - 1).alias("_number"))
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema.fields)
    return numbered.mapInArrow(_places(slots), f"{schema}, sequence_id bigint, `offset` bigint")


def pack(docs: DataFrame, tokenizer: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """One row per piece of every document; see ``pieces`` and ``pack_pieces``.

    With the default limits the documents and the attention cost of 2048 tokens
    are never the scarce capacity, so sequences are as few as by tokens alone.
    """
    return pack_pieces(pieces(docs, tokenizer, limits.tokens), limits)
