"""The n best segmentations of a text into the pieces of a SentencePiece model, and back.

A word's lattice has an edge for every piece it contains. A forward Viterbi pass
gives the best score of every prefix; a search from the end (A-star) extends the
suffix whose score plus the best prefix score is highest. That estimate is
exact, so complete segmentations come out best first.

Pieces of these models hold their space mark only at the start, so a text falls
into words whose lattices share no piece, and a text's n best are combinations
of its words' n best. All but the n - 1 words with the smallest loss from best
to second best keep their best segmentation: taking a worse one of any other
word loses more than n - 1 single changes do. A model with other pieces is
treated as one lattice per text.

Scores are those of the model, added. A character without a piece of its own
costs the lowest score less ``UNKNOWN`` and becomes its bytes. Ties among
segmentations of a word go to the one the search completes first, among texts
to the change in an earlier word last. Null and empty texts have one
segmentation, without pieces and of score 0. Repeated rows come back each, an
empty table gives no row, other columns are ignored.

For a model made by merges the scores are ranks of merges, so the best sum need
not be what that model's own encoder returns; it is the best of the lattice.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.llm.shared import ROWS, Batches, in_batches, texts

MARK = "▁"
UNKNOWN = 10.0
LATIN = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
SIGNS = r"!-@\[-`{-~"
BEST = 4
#: Words kept per generation in a Python worker, and the longest that are kept.
WORDS, LONG = 400_000, 64


class Word(NamedTuple):
    """Best score, ids of the best segmentation (little-endian 32-bit), the loss of the second best, whether the ids give the word back."""

    score: float
    ids: bytes
    loss: float
    same: bool


def _tree(pieces: dict[str, tuple[float, int]]) -> dict:
    """By character: (score or None, id, tree of what can follow)."""
    nodes: dict[str, list] = {"": [None, -1, {}]}
    for name, (score, number) in sorted(pieces.items()):
        for size in range(1, len(name) + 1):
            if name[:size] not in nodes:
                nodes[name[:size]] = [None, -1, {}]
        nodes[name][:2] = score, number
    for name, node in sorted(nodes.items(), key=lambda entry: -len(entry[0])):
        if name:
            nodes[name[:-1]][2][name[-1]] = tuple(node)
    return nodes[""][2]


class Segmenter:
    """Segments with one model; remembers words up to a bound."""

    def __init__(self, path: str, words: int = WORDS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        plain = [
            i for i in range(n)
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i))
        ]
        self.pieces = {names[i]: (self.model.get_score(i), i) for i in plain}
        self.tree, self.alone = _tree(self.pieces), {p for p in self.pieces if len(p) == 1}
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if self.model.is_byte(i)}
        self.data = [name.encode() for name in names]
        for byte, i in self.bytes.items():
            self.data[i] = bytes([byte])
        self.unknown_id = self.model.unk_id()
        self.lowest = min((s for s, _ in self.pieces.values()), default=0.0) - UNKNOWN
        inside = set().union(*(set(p) for p in self.pieces)) if self.pieces else set()
        self.words_of = re.compile(self._pattern("".join(c for c in "\n\t\r" if c not in inside)))
        self.limit, self.old, self.new = words, {}, {}
        self.lists: dict[str, list[tuple[float, bytes]]] = {}

    def _pattern(self, alone: str) -> str:
        """Matches the parts of a text that no piece joins, as far as the pieces allow.

        ``alone`` are characters in no piece. Parts begin at space marks, and
        Latin letters are apart from ASCII digits and signs if no piece has the
        two side by side; next to any other character nothing is cut.
        """
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            return r"(?s:.+)"
        one = f"[{alone}]|" if alone else ""
        whole = f"{MARK}*[^{MARK}{alone}]+|{MARK}+"
        if any(re.search(f"[{LATIN}][{SIGNS}]|[{SIGNS}][{LATIN}]", p) for p in self.pieces):
            return one + whole
        other = f"(?![^{LATIN}{SIGNS}{MARK}{alone}])"
        return f"{one}{MARK}*[{LATIN}]++{other}|{MARK}*[{SIGNS}]++{other}|{whole}"

    def _lattice(self, word: str) -> tuple[list[list[tuple[int, float, int]]], list[float], list[tuple[int, float, int] | None]]:
        """For every end: (start, score, id) of the pieces that end there, the best score so far and the edge that gives it.

        An unknown character has id -1. From each start pieces are followed as
        long as there is one that begins so.
        """
        size = len(word)
        edges: list[list[tuple[int, float, int]]] = [[] for _ in range(size + 1)]
        best, by = [0.0] + [float("-inf")] * size, [None] * (size + 1)
        for start in range(size):
            before, alone, tree = best[start], False, self.tree
            for end in range(start + 1, size + 1):
                node = tree.get(word[end - 1])
                if node is None:
                    break
                score, number, tree = node
                if score is not None:
                    edge = (start, score, number)
                    edges[end].append(edge)
                    alone = alone or end == start + 1
                    if before + edge[1] > best[end]:
                        best[end], by[end] = before + edge[1], edge
            if not alone:
                edge = (start, self.lowest, -1)
                edges[start + 1].append(edge)
                if before + self.lowest > best[start + 1]:
                    best[start + 1], by[start + 1] = before + self.lowest, edge
        return edges, best, by

    def _edges(self, word: str) -> list[list[tuple[int, float, int]]]:
        return self._lattice(word)[0]

    def _spelled(self, word: str, path: list[tuple[int, int]]) -> tuple[bytes, bool]:
        """Ids of (start, id) steps in order, an unknown character as its bytes, and whether they give the word back."""
        out = []
        for start, piece in path:
            if piece >= 0:
                out.append(piece)
            else:
                for byte in word[start].encode("utf-8", "surrogatepass"):
                    out.append(self.bytes.get(byte, self.unknown_id))
        back = b"".join(map(self.data.__getitem__, out)).decode("utf-8", "replace")
        return struct.pack(f"<{len(out)}I", *out), back == word

    def _with_unknown(self, word: str, path: list[tuple[int, int]], loss: float) -> tuple[bytes, float, bool]:
        ids, same = self._spelled(word, path)
        return ids, loss, same

    def word(self, word: str) -> Word:
        """Best segmentation and the loss of the second best: a forward pass that keeps the two best scores of every prefix."""
        root, size, lowest, never = self.tree, len(word), self.lowest, float("-inf")
        best, second, alone = [0.0] + [never] * size, [never] * (size + 1), self.alone
        begun, ended = [0] * (size + 1), [-1] * (size + 1)  # start and id of the best last piece
        for start in range(size):
            first, other, tree, end = best[start], second[start], root, start
            for c in word[start:]:
                node = tree.get(c)
                if node is None:
                    break
                score, number, tree = node
                end += 1
                if score is not None:
                    score += first
                    if score > best[end]:
                        more = other + node[0]
                        second[end] = best[end] if best[end] > more else more
                        best[end], begun[end], ended[end] = score, start, number
                    elif score > second[end]:
                        second[end] = score
            if word[start] not in alone:
                end = start + 1
                if first + lowest > best[end]:
                    second[end] = max(best[end], other + lowest)
                    best[end], begun[end], ended[end] = first + lowest, start, -1
                elif first + lowest > second[end]:
                    second[end] = first + lowest
        ids, at = [], size
        while at:
            ids.append(ended[at])
            at = begun[at]
        ids.reverse()
        if -1 not in ids:  # pieces that cover the word spell it
            return Word(best[size], struct.pack(f"<{len(ids)}I", *ids), best[size] - second[size], True)
        path, at = [], size
        while at:
            path.append((begun[at], ended[at]))
            at = begun[at]
        return Word(best[size], *self._with_unknown(word, path[::-1], best[size] - second[size]))

    def nbest(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """Up to ``n`` segmentations as (score, ids), best first."""
        return [(score, ids) for score, ids, _ in self._search(word, n)]

    def _search(self, word: str, n: int) -> list[tuple[float, bytes, bool]]:
        """Those of ``nbest``, and whether the ids give the word back: A-star from the end."""
        edges, best, _ = self._lattice(word)
        # Of equal estimates the one nearest to the start goes first, so that ties
        # are completed one after the other: about n times the length steps.
        heap = [(-best[-1], len(word), 0, 0.0, ())]
        count, out = 1, []
        while heap and len(out) < n:
            _, at, _, score, steps = heapq.heappop(heap)
            if at == 0:
                path = []
                while steps:
                    step, steps = steps
                    path.append(step)
                out.append((score, *self._spelled(word, path)))
                continue
            for start, more, piece in edges[at]:
                whole = score + more
                heapq.heappush(heap, (-(whole + best[start]), start, count, whole, ((start, piece), steps)))
                count += 1
        return out

    def _known(self, words: list[str]) -> list[Word]:
        old, new, long = self.old, self.new, {}
        for word in set(words).difference(new):
            if len(word) > LONG:
                long[word] = self.word(word)
            else:
                new[word] = old[word] if word in old else self.word(word)
        found = [long[w] if w in long else new[w] for w in words] if long else list(map(new.__getitem__, words))
        if len(new) > self.limit:
            self.old, self.new = new, {}
        return found

    def _list(self, word: str, n: int) -> list[tuple[float, bytes, bool]]:
        """The n best of a word, each with whether its ids give the word back."""
        if word not in self.lists:
            if len(self.lists) > self.limit // 10:
                self.lists.clear()
            made = self._search(word, n)
            if len(word) > LONG:
                return made
            self.lists[word] = made
        return self.lists[word]

    def segment(self, text: str | None, n: int = BEST) -> list[tuple[float, bytes, bool]]:
        """Up to ``n`` segmentations of the whole text, best first: score, ids, whether they decode to the normalised text.

        A text comes back if all its words do. Worse segmentations are the best
        one with the ids of a few words exchanged.
        """
        normal = self.model.normalize(text or "")
        words = self.words_of.findall(normal)
        if not words:
            return [(0, b"", not normal)]
        scores, ids, losses, sames = zip(*self._known(words), strict=True)
        whole, total = b"".join(ids), sum(scores)
        loss = np.array(losses)
        near = np.flatnonzero(loss <= np.partition(loss, n - 2)[n - 2]) if 1 < n <= len(loss) else np.arange(len(loss) if n > 1 else 0)
        places = sorted(sorted(near[loss[near] < np.inf].tolist(), key=lambda at: (losses[at], at))[: n - 1])
        lists = [self._list(words[at], n) for at in places]
        covers = sum(map(len, words)) == len(normal)
        wrong = len(sames) - sum(sames) - sum(not sames[at] for at in places)
        starts = np.cumsum([0, *map(len, ids)])[places].tolist() if places else []
        out, heap, seen = [], [(-total, (0,) * len(places))], set()
        while heap and len(out) < n:
            score, ranks = heapq.heappop(heap)
            parts, at, same = [], 0, covers and not wrong
            for place, start, options, rank in zip(places, starts, lists, ranks, strict=True):
                same = same and options[rank][2]
                if rank:
                    parts += [whole[at:start], options[rank][1]]
                    at = start + len(ids[place])
            out.append((-score, b"".join([*parts, whole[at:]]), same))
            for i, rank in enumerate(ranks):
                if rank + 1 < len(lists[i]):
                    after = (*ranks[:i], rank + 1, *ranks[i + 1 :])
                    if after not in seen:
                        seen.add(after)
                        heapq.heappush(heap, (score + lists[i][rank][0] - lists[i][rank + 1][0], after))
        return out

    def encode(self, text: str | None, n: int = BEST) -> list[tuple[float, bytes]]:
        """Up to ``n`` segmentations of the whole text as (score, ids), best first."""
        return [(score, ids) for score, ids, _ in self.segment(text, n)]

    def decode(self, ids: bytes | list[int]) -> str:
        """Normalised text of ids: pieces joined, bytes as UTF-8, space marks as they are."""
        numbers = np.frombuffer(ids, "<u4").tolist() if isinstance(ids, bytes) else ids
        return b"".join(map(self.data.__getitem__, numbers)).decode("utf-8", "replace")

    def text(self, ids: bytes | list[int]) -> str:
        """Decoded text with spaces, without the space that the model puts in front."""
        return self.decode(ids).replace(MARK, " ").removeprefix(" ")


@cache
def segmenter(path: str) -> Segmenter:
    """One per Python worker, so that its memory outlives a task."""
    return Segmenter(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _lists(ids: tuple[bytes, ...]) -> pa.ListArray:
    """Packed ids as arrays of int, without an object per row."""
    ends = np.cumsum([0, *map(len, ids)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def encode_nbest(
    docs: DataFrame, n: int = BEST, model: str | None = None, with_ids: bool = True, packed: bool = False
) -> DataFrame:
    """doc_id, rank (from 1), score, n_pieces, ids, ids_crc32 and round_trip: up to ``n`` rows per document.

    ``ids`` is an array of int (left out unless ``with_ids``) or, ``packed``, the
    same as little-endian 32-bit numbers in a binary, which costs Spark less;
    ids_crc32 is the checksum of those bytes, and round_trip tells whether they
    decode to the normalised text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "rank", "score", "n_pieces", "ids", "ids_crc32", "round_trip"]
    ids_type = pa.binary() if packed else pa.list_(pa.int32())

    def spelled(ids: tuple[bytes, ...]) -> pa.Array:
        return pa.array(ids, ids_type) if packed else _lists(ids)

    def make(batches: Batches) -> Batches:
        coder = segmenter(model or default_model())
        for whole in batches:
            for from_row in range(0, whole.num_rows, ROWS):
                batch = whole.slice(from_row, ROWS)
                rows = []
                for at, text in enumerate(texts(batch.column(1))):
                    for rank, (score, ids, same) in enumerate(coder.segment(text, n), 1):
                        rows.append((at, rank, score, len(ids) // 4, ids, zlib.crc32(ids), same))
                at, ranks, scores, sizes, ids, sums, sames = zip(*rows, strict=True)
                made = [
                    pa.array(ranks, pa.int32()), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64()),
                    spelled(ids) if with_ids else pa.nulls(len(ids), ids_type),
                    pa.array(sums, pa.int64()), pa.array(sames, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *made], names=names)

    ids_kind = "binary" if packed else "array<int>"
    schema = f"doc_id {kind}, rank int, score double, n_pieces bigint, ids {ids_kind}, ids_crc32 bigint, round_trip boolean"
    found = in_batches(docs.select("doc_id", "text")).mapInArrow(make, schema)
    return found if with_ids else found.drop("ids")


def decode(rows: DataFrame, ids: str = "ids", model: str | None = None, text: str = "text") -> DataFrame:
    """``rows`` plus ``text``: the text that ``ids``, an array of ids or a binary of packed ones, stands for; null for null."""
    @F.pandas_udf(T.StringType())
    def to_text(column: pd.Series) -> pd.Series:
        coder = segmenter(model or default_model())
        return column.map(lambda i: None if i is None else coder.text(bytes(i) if isinstance(i, (bytes, bytearray)) else list(i)))

    return rows.withColumn(text, to_text(ids))
