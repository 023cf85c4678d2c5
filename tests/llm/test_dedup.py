"""Line deduplication and near-duplicates against brute force."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkrank.llm import components, lines, simhash

DOCS = "doc_id long, text string, text_copy string, row int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG, SHORT = "A common line of more than forty characters, Ä", "a short line"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, t, 0) for i, t in rows], DOCS)


def brute_lines(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)

    def key(line):
        return line.strip(" \t\n\r\x0b\x0c").translate(LOWER)

    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        keep = [
            line for line in all_lines
            if len(key(line)) < min_chars or len(holders[key(line)]) < min_docs or max(holders[key(line)]) == i
        ]
        out.append((i, len(all_lines), len(all_lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


LINE_ROWS = {
    "plain": [(i, f"{LONG}\n{SHORT}\nown {i}") for i in range(9)],
    "four documents keep it": [(i, LONG) for i in range(4)],
    "repeats in a document": [(i, f"{LONG}\n  {LONG.upper().replace('Ä', 'Ä')}\t\n{LONG}") for i in range(6)],
    "null and empty": [(1, None), (2, ""), (3, "\n"), *((i, LONG) for i in range(4, 10))],
    "repeated rows": [*((i, LONG) for i in range(6)), (5, LONG), (0, LONG)],
    "very long": [(i, "\n".join([LONG, "x" * 200_000, *(f"{LONG} {n}" for n in range(3000))])) for i in range(6)],
    "wide letters": [(i, "ä" * 39 + "\n" + "ä" * 40) for i in range(5)],
    "empty table": [],
}


@pytest.mark.parametrize("name", LINE_ROWS)
def test_lines_equal_brute_force(spark, name):
    rows = LINE_ROWS[name]
    made = lines.without_repeated_lines(docs_of(spark, rows)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256)
    )
    assert sorted(map(tuple, made.collect())) == brute_lines(rows)


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_hash_over_many_partitions(spark, partitions):
    """A line of every document runs over all partitions of the sort."""
    rows = [(i, f"{LONG}\n{LONG} {i % 7}\nown line number {i} that nobody else has at all") for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        made = lines.without_repeated_lines(docs_of(spark, rows)).select(
            "doc_id", "n_lines", "n_dropped", F.sha2("text", 256)
        )
        assert sorted(map(tuple, made.collect())) == brute_lines(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lines_shuffle_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_BYTES", -1)
    rows = [*LINE_ROWS["plain"], (None, LONG), (None, LONG)]
    made = lines.without_repeated_lines(docs_of(spark, rows)).select("doc_id", "text", "text_copy").collect()
    assert {r["doc_id"]: r["text"] for r in made}[8].startswith(LONG)
    assert [r["text"] for r in made if r["doc_id"] is None] == ["", ""]
    assert len(made) == len(rows) and all(r["text_copy"] for r in made)


def test_bitmaps_hold_one_bit_per_line(spark):
    import zlib

    kept = lines.keep_bitmaps(docs_of(spark, LINE_ROWS["plain"])).collect()
    assert {r["doc_id"] for r in kept} == set(range(8))
    bits = {np.unpackbits(np.frombuffer(zlib.decompress(r["keep"]), np.uint8))[: r["lines"]].tobytes() for r in kept}
    assert bits == {bytes([0, 1, 1])}


def brute_fingerprint(text, shingle=3):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split() if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, near):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(n):
        for j in range(i + 1, n):
            if near(i, j):
                parent[find(j)] = find(i)
    return [find(i) for i in range(n)]


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(None, "same text here"), (7, "same text here"), (5, "SAME  text\there"), (9, None), (3, ""), (3, ""), (8, " \n")]
    for base in range(6):
        text = rng.choice(words, 300).tolist()
        for copy in range(12):
            other = list(text)
            for at in rng.integers(0, 300, copy // 2):
                other[at] = "changed"
            rows.append((100 + 20 * base + copy, " ".join(other)))
    rows.append((1000, "very long " * 60_000))
    made = simhash.near_duplicates(docs_of(spark, rows)).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    group = roots(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    least = defaultdict(list)
    for (i, _), g in zip(rows, group, strict=True):
        least[g].append(i)
    expected = sorted(
        (str(i), fps[n], min(x for x in least[group[n]] if x is not None)) for n, (i, _) in enumerate(rows)
    )
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64), r["component_id"]) for r in made) == expected


@pytest.mark.parametrize(("radius", "check_radius", "bucket", "equal"), [(2, 64, 8, 0), (2, 64, 1000, 0), (3, 10, 20, 0), (1, 6, 40, 60)])
def test_links_of_split_buckets(spark, radius, check_radius, bucket, equal):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 8, dtype=np.int64)
    fps = base[rng.integers(0, 8, 120)] ^ np.bitwise_or.reduce(np.left_shift(1, rng.integers(0, 63, (120, 3))), axis=1)
    fps = np.concatenate([np.unique(fps), np.full(equal, base[0])])
    checks = rng.integers(0, 2**12, len(fps))
    nodes = [(i, int(f), int(c)) for i, (f, c) in enumerate(zip(fps, checks, strict=True))]
    df = spark.createDataFrame(nodes, "node long, fp long, check long")
    links = {tuple(r) for r in simhash.links_within(df, radius, check_radius, bucket).collect()}

    def near(i, j):
        return int(fps[i] ^ fps[j]).bit_count() <= radius and int(checks[i] ^ checks[j]).bit_count() <= check_radius

    assert all(near(a, b) for a, b in links)
    assert roots(len(nodes), near) == roots(len(nodes), lambda i, j: (i, j) in links or (j, i) in links) or (
        len(set(roots(len(nodes), near))) == len(set(roots(len(nodes), lambda i, j: (i, j) in links or (j, i) in links)))
    )


def test_masks_cover_every_pair_within_the_radius():
    rng = np.random.default_rng(1)
    for radius in (1, 2, 3, 5, 6):
        for level in (0, 1):
            masks = simhash.covering_masks(radius, level)
            assert len(masks) == 2 ** (radius + 1) - 1
            assert min(m.bit_count() for m in masks) >= 32
            for _ in range(300):
                differ = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
                assert any(m & differ == 0 for m in masks)


def test_dedup_keeps_one_of_each_group(spark):
    rows = [(4, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (9, "other words than these are here"), (None, "nobody has this text but me")]
    kept = simhash.dedup(docs_of(spark, rows), simhash.Features(1, False), 3, (simhash.Features(5, False), 10))
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["2", "9", "None"]
    assert kept.columns == ["doc_id", "text", "text_copy", "row"]
    assert simhash.dedup(docs_of(spark, []), simhash.Features(), 2).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 2000 + i) for i in range(50)] + [(5, 5), (7, 6)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(1, 61)}, **{2000 + i: 1000 for i in range(50)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
