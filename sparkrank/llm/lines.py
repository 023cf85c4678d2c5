"""Removal of lines that many documents share.

Hashes of the lines are range-partitioned by (hash, document) and sorted by
hash, document from the largest down, and position. One pass over a partition
then meets first the document that keeps a line. A line that many documents hold
runs over several partitions, so it is never in one task; only the first and the
last hash of a partition can do so, and those are settled by sums per hash. The
result is a compressed bitmap of kept lines per document, no text.

Defined cases: a null text is one empty line and stays null; rows that share a
doc_id count as one document, each with its own bitmap; rows without an id count
as one document below all others. Repeated rows come back each. Lines come back
as they were, only whole lines go. An empty table gives no row. Columns besides
doc_id and text are not looked at, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.llm.shared import Batches, free_names, in_batches, kept, per_batch, replaced, texts, width

SPACES = b" \t\n\r\x0b\x0c"
MIN_CHARS, MIN_DOCS = 40, 5
BROADCAST_BYTES = 16 * 1024 * 1024
ROWS = 8192
#: What a row of ``_settle`` is: a line to drop, a line whose hash may go on
#: elsewhere, or the sums of such a hash in one partition (documents in ``pos``).
DROP, OPEN, SUMS = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased."""
    return line.strip(SPACES).lower()


def _long_enough(key: bytes, chars: int) -> bool:
    return len(key) >= chars and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= chars)


def row_hash(text: str) -> int:
    """The same as ``xxhash64`` of Spark."""
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)).astype(np.int64))


def _hashed(text: str, min_chars: int) -> Iterator[tuple[int, int, int, int]]:
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    for pos, line in enumerate(lines):
        if len(line) >= min_chars and _long_enough(key := line_key(line), min_chars):
            whole = xxhash.xxh3_128_digest(key)
            h1, h2 = (int.from_bytes(half, "big", signed=True) for half in (whole[:8], whole[8:]))
            yield h1, h2, pos, len(lines)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, row, pos, lines): 128 bits of hash per line with a long enough key.

    ``row`` is a hash of the text, which tells rows apart that share a doc_id,
    and ``lines`` the number of lines of that text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["h1", "h2", "doc_id", "row", "pos", "lines"]

    def make(batches: Batches) -> Batches:
        for batch in batches:
            found = []
            for at, text in enumerate(texts(batch.column(1))):
                row = row_hash(text)
                found += [(h1, h2, at, row, pos, n) for h1, h2, pos, n in _hashed(text, min_chars)]
            if found:
                h1, h2, at, *rest = (pa.array(c, pa.int64()) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([h1, h2, batch.column(0).take(at), *rest], names=names)

    return in_batches(docs.select("doc_id", "text")).mapInArrow(
        make, f"h1 bigint, h2 bigint, doc_id {kind}, row bigint, pos bigint, lines bigint"
    )


def _settle(min_docs: int):
    """One pass over a sorted partition: lines to drop, open lines and sums.

    A hash that begins inside the partition has its largest document here, and
    its lines are held back only until ``min_docs`` documents are seen; from
    then on every other line goes at once. The first hash may have begun in the
    partition before, so its lines stay open.
    """
    names = ["doc_id", "row", "pos", "lines", "h1", "h2", "what"]

    def run(batches: Batches) -> Batches:
        out: list[tuple] = []
        key, first = None, True
        docs, doc, largest, held = 0, None, None, []
        for batch in batches:
            kind = batch.column(2).type
            for h1, h2, d, row, pos, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h1, h2) != key:
                    if key is not None and first:
                        out.append((largest, 0, docs, 0, *key, SUMS))
                        first = False
                    key, docs, largest, held = (h1, h2), 0, d, []
                if docs == 0 or d != doc:
                    docs, doc = docs + 1, d
                    if docs == min_docs and not first:
                        out += [(*line, DROP) for line in held]
                        held = []
                if first:
                    out.append((d, row, pos, n, h1, h2, OPEN))
                elif docs >= min_docs:
                    out.append((d, row, pos, n, h1, h2, DROP))
                elif docs > 1:
                    held.append((d, row, pos, n, h1, h2))
            while len(out) >= ROWS:
                yield _batch(out[:ROWS], kind, names)
                out = out[ROWS:]
        if key is not None:
            out += [(*line, OPEN) for line in held]
            out.append((largest, 0, docs, 0, *key, SUMS))
            yield _batch(out, kind, names)

    return run


def _batch(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [kind, *[pa.int64()] * 5, pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def repeated_lines(hashes: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, pos, lines) of the lines to drop: all but those of the largest doc_id."""
    kind = hashes.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row bigint, pos bigint, lines bigint, h1 bigint, h2 bigint, what int"
    order = ["h1", "h2", F.col("doc_id").desc_nulls_last()]
    settled = kept(
        kept(hashes)
        .repartitionByRange(width(hashes.sparkSession), *order)
        .sortWithinPartitions(*order, "row", "pos")
        .mapInArrow(_settle(min_docs), schema)
    )
    # At most two rows per partition of the sort, whatever the data.
    sums = (
        settled.where(F.col("what") == SUMS)
        .groupBy("h1", "h2")
        .agg(F.sum("pos").alias("docs"), F.max("doc_id").alias("largest"))
        .where(F.col("docs") >= min_docs)
    )
    late = (
        settled.where(F.col("what") == OPEN)
        .join(F.broadcast(sums), ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("largest")))
    )
    columns = ["doc_id", "row", "pos", "lines"]
    return settled.where(F.col("what") == DROP).select(columns).unionByName(late.select(columns))


@F.udf(T.BinaryType(), useArrow=True)
def _bitmap(dropped: list[int], lines: int) -> bytes:
    keep = np.ones(lines, bool)
    keep[np.asarray(dropped)] = False
    return zlib.compress(np.packbits(keep).tobytes())


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, lines, dropped, keep) per document that loses a line.

    ``keep`` has one bit per line (first line = highest bit of the first byte),
    compressed by zlib. Keys of at least ``min_chars`` code points found in at
    least ``min_docs`` documents are dropped everywhere but in the largest
    doc_id; see the module for nulls and repeated ids.
    """
    return (
        repeated_lines(line_hashes(docs, min_chars), min_docs)
        .groupBy("doc_id", "row")
        .agg(F.collect_set("pos").alias("pos"), F.max("lines").alias("lines"))
        .select("doc_id", "row", "lines", F.size("pos").cast("bigint").alias("dropped"), _bitmap("pos", "lines").alias("keep"))
    )


def _kept_lines(text: str | None, keep: bytes | None) -> str | None:
    if keep is None:
        return text
    lines = (text or "").split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return "\n".join(line for line, bit in zip(lines, bits.tolist(), strict=True) if bit)


def _line_count(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def without_repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, counts: tuple[str, str] = ("n_lines", "n_dropped")
) -> DataFrame:
    """``docs`` with the kept lines as text, plus two columns, the lines before and those dropped.

    Columns of ``docs`` with a name of ``counts`` are replaced, all others stay,
    whatever their names. The bitmaps are written and measured; up to
    ``BROADCAST_BYTES`` they go to the documents, beyond it both sides are
    shuffled by document.
    """
    bitmaps = kept(keep_bitmaps(docs, min_chars, min_docs))
    size = bitmaps.agg(F.coalesce(F.sum(F.octet_length("keep") + 64), F.lit(0)).alias("b")).first()["b"]
    doc, row, dropped, keep = free_names([*docs.columns, *counts], "_doc", "_row", "_dropped", "_keep")
    side = bitmaps.select(
        F.col("doc_id").alias(doc), F.col("row").alias(row), F.col("dropped").alias(dropped), F.col("keep").alias(keep)
    )
    joined = docs.join(
        F.broadcast(side) if size <= BROADCAST_BYTES else side,
        docs["doc_id"].eqNullSafe(side[doc]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == side[row]),
        "left",
    )
    counted = joined.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in [n.lower() for n in counts]],
        _line_count(F.col("text")).alias(counts[0]),
        F.coalesce(dropped, F.lit(0)).cast("bigint").alias(counts[1]),
        keep,
    )
    at = counted.columns.index("text")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(batch.column(at).to_pylist(), batch.column(keep).to_pylist(), strict=True)
        return replaced(batch, "text", [_kept_lines(*row) for row in rows])

    return per_batch(counted, make, counted.schema).drop(keep)


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the kept lines as text, and its own columns only."""
    names = tuple(free_names(docs.columns, "n_lines", "n_dropped"))
    return without_repeated_lines(docs, min_chars, min_docs, names).select(*[f"`{c}`" for c in docs.columns])
