"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the XXH64 hashes of a
document's shingles. To find all pairs within ``radius`` differing bits, every
bit i gets a nonzero code m(i) of radius + 1 bits; table v (each nonzero vector
of as many bits) keeps the bits with <m(i), v> odd. Two fingerprints that differ
in at most ``radius`` bits pose that many equations <m(i), v> = 0, which some
nonzero v solves, so they agree on all bits that table keeps and meet there:
no pair within the radius is lost.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.components import components
from sparkrank.llm.shared import Batches, kept, numbered_rows, per_batch, rows_of, width

SEED = 42
#: A bucket of up to this many fingerprints is searched in one task; it is 3 MB.
BUCKET = 65_536
HASHED = 1 << 16


class Features(NamedTuple):
    """Shingles of ``shingle`` words, each as often as it occurs or, without ``repeats``, once."""

    shingle: int = 3
    repeats: bool = True


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprint_of(words: list[bytes], features: Features = Features()) -> int:
    """64 bits, unsigned; zero without a word."""
    if not words:
        return 0
    k, n = features.shingle, max(1, len(words) - features.shingle + 1)
    shingles = words if k == 1 else [b" ".join(words[i : i + k]) for i in range(n)]
    if not features.repeats:
        shingles = list(set(shingles))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), HASHED):
        part = shingles[at : at + HASHED]
        hashes = np.fromiter((xxhash.xxh64_intdigest(one, SEED) for one in part), np.dtype("<u8"), len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, kinds: dict[str, Features], key: str = "doc_id") -> DataFrame:
    """(``key``, a long per entry of ``kinds``) per document: its fingerprints, signed.

    The whole text counts, A-Z lower-cased, words split at ASCII white space.
    Null and empty texts get fingerprint zero. One row per input row; columns
    other than ``key`` and text are ignored.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.zeros((len(kinds), batch.num_rows), np.uint64)
        for at, text in enumerate(batch.column(1).to_pylist()):
            words = words_of(text)
            made[:, at] = [fingerprint_of(words, f) for f in kinds.values()]
        columns = [pa.array(row) for row in made.view(np.int64)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *kinds])

    kind = docs.schema[key].dataType.simpleString()
    columns = ", ".join(f"`{name}` bigint" for name in kinds)
    return per_batch(docs.select(key, "text"), make, f"`{key}` {kind}, {columns}")


def covering_masks(radius: int, level: int = 0) -> list[int]:
    """2^(radius + 1) - 1 masks of 64 bits; see the module's text.

    Codes are dealt out from the largest down, and again when used up, over a
    shuffled order of the bits (``level`` seeds it): up to a radius of 6 each
    table then keeps half of the bits or a few more. Beyond, codes are drawn.
    """
    rng = np.random.default_rng(SEED + level)
    bits, codes = rng.permutation(64).tolist(), (1 << radius + 1) - 1
    own = [codes - at % codes for at in range(64)] if radius <= 6 else (1 + rng.choice(codes, 64, False)).tolist()
    return [
        sum(1 << bit for bit, code in zip(bits, own, strict=True) if (v & code).bit_count() & 1)
        for v in range(1, codes + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def spanning_links(
    nodes: np.ndarray, fps: np.ndarray, checks: np.ndarray, radius: int, check_radius: int
) -> list[tuple[int, int]]:
    """Links that join what is within both radii: a spanning forest, not all pairs."""
    order = np.argsort(nodes, kind="stable")
    nodes, fps, checks = nodes[order], fps[order].view(np.uint64), checks[order].view(np.uint64)
    rest, links = np.arange(len(nodes)), []
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(fps[rest] ^ fps[at]) <= radius
            if check_radius < 64:
                near &= np.bitwise_count(checks[rest] ^ checks[at]) <= check_radius
            if near.any():
                found, rest = rest[near], rest[~near]
                frontier.extend(found)
                links += [(int(nodes[at]), int(nodes[x])) for x in found]
    return links


def _forest(radius: int, check_radius: int):
    """Links of the buckets of a partition that is sorted by bucket; one bucket is held at a time."""

    def links_of(nodes: np.ndarray, fps: np.ndarray, checks: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
        sizes = np.diff(starts)
        a = starts[:-1][sizes == 2]
        near = np.bitwise_count((fps[a] ^ fps[a + 1]).view(np.uint64)) <= radius
        if check_radius < 64:
            near &= np.bitwise_count((checks[a] ^ checks[a + 1]).view(np.uint64)) <= check_radius
        links = list(zip(nodes[a[near]].tolist(), nodes[a[near] + 1].tolist(), strict=True))
        for at in np.flatnonzero(sizes > 2):
            own = slice(starts[at], starts[at + 1])
            links += spanning_links(nodes[own], fps[own], checks[own], radius, check_radius)
        return links

    def run(batches: Batches) -> Batches:
        held = np.zeros((5, 0), np.int64)
        for batch in batches:
            held = np.hstack([held, np.stack([c.to_numpy() for c in batch.columns])])
            node, fp, check, fixed, part = held
            key = fp & fixed
            new = np.flatnonzero((np.diff(key) != 0) | (np.diff(fixed) != 0) | (np.diff(part) != 0)) + 1
            if len(new):
                yield _links(links_of(node, fp, check, np.concatenate([[0], new])))
                held = held[:, new[-1] :]
        if held.shape[1]:
            yield _links(links_of(*held[:3], np.array([0, held.shape[1]])))

    return run


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


NODE = ["node", "fp", "check"]


def _tables(rows: DataFrame, radius: int, level: int) -> DataFrame:
    """Every row once per mask of the level, which fixes more bits.

    The covering property holds for the bits that are still free as it does for
    all of them, so one family per level serves all buckets.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in covering_masks(radius, level)])
    more = rows.select(*NODE, "fixed", F.explode(masks).alias("mask"))
    found = more.select(*NODE, F.col("fixed").bitwiseOR(F.col("mask")).alias("fixed"))
    found = found if level == 0 else found.distinct()
    return found.withColumn("part", F.lit(0).cast("bigint"))


def _pairs_of_parts(rows: DataFrame, largest: int, bucket: int) -> DataFrame:
    """Every row once per pair of parts of its bucket that it is in."""
    parts = max(2, -(-4 * largest // bucket))
    own = F.pmod(F.xxhash64("node"), F.lit(parts))
    others = F.filter(F.sequence(F.lit(0), F.lit(parts - 1)), lambda o: o != own)
    pairs = F.transform(others, lambda o: (F.least(own, o) * parts + F.greatest(own, o) + 1).cast("bigint"))
    return rows.select(*NODE, "fixed", F.explode(pairs).alias("part"))


def _key() -> Column:
    return F.col("fp").bitwiseAND(F.col("fixed")).alias("key")


def _search(rows: DataFrame, radius: int, check_radius: int) -> DataFrame:
    """Links within the buckets of ``rows``, each searched in one task."""
    dealt = rows.repartition(width(rows.sparkSession), "fixed", "part", _key())
    ordered = dealt.sortWithinPartitions("fixed", "part", _key()).select(*NODE, "fixed", "part")
    return ordered.mapInArrow(_forest(radius, check_radius), "a bigint, b bigint")


def links_within(nodes: DataFrame, radius: int, check_radius: int = 64, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the radii.

    ``nodes`` are different (node, fp, check), all longs; a pair links if its fp
    differ in at most ``radius`` bits and its check in at most ``check_radius``.
    Every node goes to its bucket in each covering table. Sizes are counted
    first, on keys alone and with partial sums. A bucket of up to ``bucket``
    nodes is searched in one task, which returns a spanning forest of what
    links. A larger one is split again by a covering family, which fixes half of
    its free bits, so no pair is lost and no task holds more. If all its fp are
    equal (with very many different checks) it is cut into parts of even size
    instead, and each pair of parts is searched.
    """
    rows, level, found = nodes.select(*NODE, F.lit(0).cast("bigint").alias("fixed")), 0, []
    while True:
        rows = _tables(rows, radius, level)
        # Counts by a hash of the bucket are never too low, so none above the
        # bound means no large bucket; only else are buckets counted exactly.
        hashed = rows.groupBy(F.xxhash64("fixed", "part", _key()).alias("h")).count()
        if hashed.where(F.col("count") > bucket).isEmpty():
            found.append(_search(rows, radius, check_radius))
            break
        large = kept(
            rows.groupBy("fixed", _key())
            .agg(F.count("*").alias("n"), (F.min("fp") == F.max("fp")).alias("equal"))
            .where(F.col("n") > bucket)
        )
        counts = {r["equal"]: r["n"] for r in large.groupBy("equal").agg(F.max("n").alias("n")).collect()}
        if not counts:
            found.append(_search(rows, radius, check_radius))
            break
        keyed = rows.withColumn("key", _key())
        small = keyed.join(large, ["fixed", "key"], "left_anti")
        found.append(_search(small, radius, check_radius))
        again = kept(keyed.join(large, ["fixed", "key"]).select(*NODE, "fixed", "equal"))
        if True in counts:
            parts = _pairs_of_parts(again.where("equal"), counts[True], bucket)
            found.append(_search(parts, radius, check_radius))
        if False not in counts:
            break
        rows, level = again.where("not equal").select(*NODE, "fixed"), level + 1
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def near_duplicates(
    docs: DataFrame,
    features: Features = Features(),
    radius: int = 2,
    check: tuple[Features, int] | None = None,
    bucket: int = BUCKET,
) -> DataFrame:
    """doc_id, fp (long) and component_id per row of ``docs``.

    Documents link if the fingerprints of their ``features`` differ in at most
    ``radius`` bits and, with ``check``, those of the check's features in at
    most its number of bits. component_id is the smallest doc_id that can be
    reached over links, its own included; rows without an id are linked as well
    but name no component (null if nothing else does). Repeated rows stay.
    Documents of equal fingerprints are one node, so a group of exact copies,
    however large, costs as much as one document.
    """
    kinds = {"fp": features, "check": check[0]} if check else {"fp": features}
    made = fingerprints(docs, kinds)
    rows = kept(made if check else made.withColumn("check", F.lit(0).cast("bigint")))
    distinct = rows.groupBy("fp", "check").agg(F.min("doc_id").alias("least_id"))
    number = F.monotonically_increasing_id() if check else F.col("fp")
    nodes = kept(distinct.withColumn("node", number))
    roots = components(links_within(nodes, radius, check[1] if check else 64, bucket)).withColumnRenamed("node", "at")
    named = kept(
        nodes.join(roots, nodes["node"] == roots["at"], "left").select(
            "fp", "check", "least_id", F.coalesce("root", "node").alias("root")
        )
    )
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    ids = named.select("fp", "check", "root").join(names, "root")
    return rows.join(ids, ["fp", "check"]).select("doc_id", "fp", "component_id")


def dedup(docs: DataFrame, *similar, **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id.

    Arguments are those of ``near_duplicates``. All columns are kept, whatever
    their names. Of rows that repeat that doc_id one stays; rows without an id
    stay only if no document of their component has one, and then one of them.
    An empty table gives no row. Texts are not shuffled while the bitmaps of the
    rows that stay are small.
    """
    numbered = numbered_rows(docs)
    found = near_duplicates(numbered.select(F.col("_row").alias("doc_id"), F.col("_doc.text").alias("text")), *similar, **options)
    ids = numbered.select("_row", F.struct(F.col("_doc.doc_id").isNull().alias("no_id"), F.col("_doc.doc_id"), "_row").alias("first"))
    chosen = found.join(ids, found["doc_id"] == ids["_row"]).groupBy("component_id").agg(F.min("first").alias("first"))
    return rows_of(numbered, chosen.select(F.col("first._row").alias("_row")))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
