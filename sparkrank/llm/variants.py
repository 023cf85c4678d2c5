"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words one edit apart, the shorter (either, if equally long) is cut into
two disjoint chunks, its halves. The edit touches one of them at most, so the
other is a gram of the longer word, in its old place if it is the first half
and shifted by the difference of the lengths, none or one, if it is the second.
So a word gives its two chunks, the longer word those of its positional grams
that a chunk within that shift can equal, and both meet in the join on the
length, the half and the gram.

Words that meet share half of their letters and differ in the rest, which is
one edit again: the same cut is applied to the rest until few words are left,
and those are verified. So a frequent beginning or ending costs no comparison of
all its words. Buckets too large for a task are cut that way by Spark before.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.counting import Tally, parts_of
from sparkrank.llm.shared import Batches, in_batches, kept

SHORTEST, FEWEST, RATIO, EVERY = 5, 3, 2, 97
RUNS = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
#: Words of a bucket that one task holds, and those that are compared one by one.
BUCKET, FEW = 100_000, 6


def runs_of(data: bytes) -> list[str]:
    """Runs of letters long enough to count, of lower-cased text."""
    return RUNS.findall(data.decode("utf-8", "surrogatepass"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n), summed within tasks only, of words of at least ``SHORTEST`` code points.

    A run whose checksum with the document's id (nothing, if null) is divisible
    by ``EVERY`` loses the code point that the checksum points to.
    """

    def rows(_, occurrences, __) -> pa.RecordBatch:
        found = [(w, n) for w, n in occurrences.items() if n]
        words, counts = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

    def run(batches: Batches) -> Batches:
        tally = Tally(rows)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for part in parts_of((text.as_py() or "").encode("utf-8", "surrogatepass").lower()):
                    words = runs_of(part)
                    tally.add(None, words)
                    hits = {w: h for w in set(words) if not (h := zlib.crc32(w.encode(), head)) % EVERY}
                    if hits:
                        counts = tally.group(None)[0]
                        for word in filter(hits.__contains__, words):
                            at = hits[word] % len(word)
                            counts[word] -= 1
                            if len(word) > SHORTEST:
                                counts[word[:at] + word[at + 1 :]] += 1
                yield from tally.flushed()
        yield from tally.flushed(last=True)

    return in_batches(docs.select("doc_id", "text")).mapInArrow(run, "word string, n bigint")


def words_of(docs: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """(word, n) of words that occur often enough in all documents together."""
    return word_counts(docs).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


def one_edit(short: str, other: str) -> bool:
    """Whether one replaced, or in ``other`` inserted, code point makes the two equal."""
    more = len(other) - len(short)
    for at, c in enumerate(short):
        if c != other[at]:
            return short[at + 1 - more :] == other[at + 1 :]
    return more == 1


def near_pairs(short: list[tuple[str, int]], long: list[tuple[str, int]], found: set[tuple[int, int]]) -> None:
    """Add (number, number) of all words one edit apart, ``short`` with ``short`` or with ``long``.

    Words of ``short`` are equally long and different, those of ``long`` are one longer.
    """
    if not short or len(short) + len(long) < 2:
        return
    size = len(short[0][0])
    if len(short) + len(long) <= FEW or size <= 1:
        for n, (word, i) in enumerate(short):
            found.update((i, j) for other, j in short[n + 1 :] if one_edit(word, other))
            found.update((i, j) for other, j in long if one_edit(word, other))
        return
    half = size // 2
    lefts, rights = {}, {}
    for word, i in short:
        lefts.setdefault(word[:half], ([], []))[0].append((word[half:], i))
        rights.setdefault(word[half:], ([], []))[0].append((word[:half], i))
    for word, i in long:
        if word[:half] in lefts:
            lefts[word[:half]][1].append((word[half:], i))
        if word[half + 1 :] in rights:
            rights[word[half + 1 :]][1].append((word[: half + 1], i))
    for group in (*lefts.values(), *rights.values()):
        near_pairs(*group, found)


def _near(batches: Batches) -> Batches:
    """Near words, both ways, of the buckets of a partition that is sorted by bucket."""

    def bucket(rows: list[tuple[str, bool, str, int]]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        sides = [(rest, i) for i, (rest, long, _, _) in enumerate(rows) if not long], [(rest, i) for i, (rest, long, _, _) in enumerate(rows) if long]
        near_pairs(*sides, found)
        if found:
            pairs = [*found, *((j, i) for i, j in found)]
            words, others = ([rows[p[side]][2] for p in pairs] for side in (0, 1))
            counts = [rows[j][3] for _, j in pairs]
            columns = [pa.array(words, pa.string()), pa.array(others, pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "other", "other_n"])

    key, held = None, []
    for batch in batches:
        for now, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != key:
                if len(held) > 1:
                    yield from bucket(held)
                key, held = now, []
            held.append(tuple(row))
    if len(held) > 1:
        yield from bucket(held)


def _cut(rows: DataFrame) -> DataFrame:
    """Every row by both halves of its rest: the shared one joins the key, the other is the new rest."""
    half = F.expr("(length(rest) - long) div 2").cast("int")
    more = F.col("long")

    def side(mark: str, shared: Column, rest: Column) -> Column:
        return F.struct(F.concat("key", F.lit(mark), shared).alias("key"), rest.alias("rest"))

    every = F.lit(1 << 30)
    left = side("<", F.substring("rest", F.lit(1), half), F.substring("rest", half + 1, every))
    right = side(">", F.substring("rest", half + more + 1, every), F.substring("rest", F.lit(1), half + more))
    return rows.withColumn("cut", F.explode(F.array(left, right))).select("cut.key", "cut.rest", "long", "word", "n")


def near_words(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(word, other, other_n): every two different words of ``words(word, n)`` one edit apart, both ways.

    Buckets of more than ``bucket`` words are cut again, until what is left of a
    word is one letter, which bounds a bucket by the alphabet. A pair can occur
    in several buckets and then in several rows.
    """
    size = F.length("word")
    own = words.select(size.cast("string").alias("key"), F.col("word").alias("rest"), F.lit(0).alias("long"), "word", "n")
    longer = own.select((size - 1).cast("string").alias("key"), "rest", F.lit(1).alias("long"), "word", "n")
    rows, found = _cut(own.unionByName(longer)), None
    while True:
        sizes = rows.groupBy(F.xxhash64("key").alias("h")).count().where(F.col("count") > bucket)
        large = kept(sizes.select("h"))
        done = large.isEmpty()
        small = rows if done else rows.join(large, F.xxhash64("key") == F.col("h"), "left_anti")
        again = None
        if not done:
            wide = rows.join(large, F.xxhash64("key") == F.col("h"), "left_semi")
            cuttable = F.length("rest") - F.col("long") > 1
            small = small.unionByName(wide.where(~cuttable))
            again = wide.where(cuttable)
        ordered = small.repartition("key").sortWithinPartitions("key").select("key", "rest", (F.col("long") == 1).alias("long"), "word", "n")
        made = ordered.mapInArrow(_near, "word string, other string, other_n bigint")
        found = made if found is None else found.unionByName(made)
        if done:
            return found
        rows = kept(_cut(again))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)`` without cycles: forms are followed to the last, by doubling."""
    at = kept(forms.select("word", F.col("form").alias("root")))
    while True:
        after = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = kept(at.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def group_variants(docs: DataFrame, fewest: int = FEWEST, ratio: int = RATIO, bucket: int = BUCKET) -> DataFrame:
    """word, form, root (string), n, n_near, form_n (long) per word.

    A word's form is the most frequent word one edit apart (the smallest in code
    points of equals) if it is ``ratio`` times as frequent; root is where forms
    lead. Null and empty texts have no words, a repeated row counts again, and a
    table without words gives no row. Columns other than doc_id and text are
    ignored. Counts at least double from word to form, so there are no cycles.
    """
    words = kept(words_of(docs, fewest))
    near = near_words(words, bucket).repartition("word").dropDuplicates(["word", "other"])
    best = F.min(F.struct(-F.col("other_n"), "other"))
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.max("other_n").alias("most"))
    formed = F.col("most") >= ratio * F.col("n")
    named = kept(
        words.join(near, "word", "left").select(
            "word", F.when(formed, F.col("best.other")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(formed, F.col("most")).alias("form_n"),
        )
    )
    ends = roots(named.where("form IS NOT NULL"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
