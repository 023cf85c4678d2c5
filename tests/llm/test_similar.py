"""Near-duplicates of the pipeline against the five-word similarity of every pair."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkrank.llm import similar, simhash
from sparkrank.llm.shared import forget, kept, only, recorded

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = 200


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_kept(rows, least=0.8):
    """Ids that stay, by all pairs; ids differ."""
    rows = sorted(rows)
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= least:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return sorted({rows[find(i)][0] for i in range(len(rows))})


def edited(words, kind, share, rng, new):
    """A copy in which about ``share`` of the words are new, at one place or at many."""
    n = round(len(words) * share)
    fresh = [f"{new}{x}" if x % 2 else str(rng.choice(words)) for x in range(n)]
    if kind == "appended":
        return words + fresh
    if kind == "block":
        at = int(rng.integers(0, len(words) - n))
        return words[:at] + fresh + words[at + n :]
    copy = list(words)
    for at in rng.choice(len(words), round(n / 4), replace=False):
        copy[at] = f"{new}{at}"
    return copy


def pairs(kind, n, rng):
    """Texts 2 i and 2 i + 1 are copies, their similarities lie on both sides of 0.8."""
    rows = []
    for i in range(n):
        words = [f"t{i}w{x}" for x in rng.integers(0, 150, WORDS)]
        share = (0.18, 0.24, 0.26)[i % 3] if kind == "appended" else (0.06, 0.09, 0.12)[i % 3]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited(words, kind, share, rng, f"n{i}x")))]
    return rows


@pytest.mark.parametrize("kind", ["scattered", "appended", "block"])
def test_every_kind_of_edit_equals_brute_force(spark, kind):
    rows = pairs(kind, 120, np.random.default_rng(7))
    expected = brute_kept(rows)
    assert 130 < len(expected) < 230
    kept = corpus_pipeline.near_dedup(spark, docs_of(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == expected


def test_unrelated_texts_of_one_vocabulary_stay(spark):
    """Every text is the same words in another order, in half of them behind a common beginning."""
    rng = np.random.default_rng(8)
    words = [f"w{x}" for x in range(60)]
    common = " ".join(rng.choice(words, 150))
    rows = [(i, " ".join(rng.permutation(words).tolist() * 3)) for i in range(150)]
    rows += [(1000 + i, f"{common} {' '.join(rng.choice(words, 60))}") for i in range(150)]
    assert brute_kept(rows) == [i for i, _ in rows]
    kept = corpus_pipeline.near_dedup(spark, docs_of(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, _ in rows]


@pytest.mark.parametrize("cell", [similar.CELL, 3000])
def test_large_groups_cut_into_cells(spark, cell):
    """A group of copies, a chain that drifts, and texts that are candidates but no copies."""
    rng = np.random.default_rng(9)
    base = [f"w{x}" for x in rng.integers(0, 500, WORDS)]
    rows = [(i, " ".join(edited(base, "scattered", 0.02, rng, f"g{i}x"))) for i in range(80)]
    rows += [(100 + i, " ".join(edited(base, "block", 0.16, rng, f"h{i}x"))) for i in range(30)]
    chain = [f"c{x}" for x in range(WORDS)]
    for i in range(60):
        rows.append((200 + i, " ".join(chain)))
        step = 15 if i % 10 else 40
        chain = chain[step:] + [f"c{i}y{x}" for x in range(step)]
    expected = brute_kept(rows)
    assert 10 < len(expected) < 100
    kept = similar.dedup(docs_of(spark, rows), cell)
    assert sorted(r["doc_id"] for r in kept.collect()) == expected


def test_odd_rows(spark):
    rows = [(4, "a b c"), (2, "A  b\tc"), (2, "a b c"), (None, "a b c"), (9, None), (3, ""), (5, " \n"), (None, "nobody has this")]
    kept = similar.dedup(docs_of(spark, rows))
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["2", "3", "None"]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert similar.dedup(docs_of(spark, [])).count() == 0


def test_keys_miss_as_few_as_the_formula_says():
    """Pairs of similarity 0.8: (1 - 0.8^6)^40 is 5 in a million, and a key is shared by 0.8^6 = 0.262."""
    rng, shared, met = np.random.default_rng(10), 0, 0
    for _ in range(400):
        own = rng.integers(0, 1 << 63, 500, np.uint64)
        other = own[:400]
        same = sum(a == b for a, b in zip(similar.keys_of(own), similar.keys_of(other), strict=True))
        shared, met = shared + same, met + (same > 0)
    assert met == 400 and abs(shared / (400 * similar.BANDS) - 0.8**6) < 0.02


def plain_links(sets):
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(sets)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def test_links_span_what_all_pairs_join():
    rng = np.random.default_rng(12)
    for _ in range(60):
        base = rng.choice(60, 25, replace=False)
        sets = []
        for _ in range(rng.integers(2, 40)):
            one = set(base.tolist()) - set(rng.choice(base, rng.integers(0, 8)).tolist())
            sets.append(one | set(rng.choice(60, rng.integers(0, 5)).tolist()))
        links = similar.similar_links(list(range(len(sets))), [np.array(sorted(s), np.uint64) for s in sets])
        assert all(similarity(sets[a], sets[b]) >= 0.8 for a, b in links)
        wanted = plain_links(sets)
        assert len(links) == len(sets) - len(set(wanted)) and all(wanted[a] == wanted[b] for a, b in links)


def test_groups_without_links_are_not_compared_in_pairs():
    """Templates: half of the shingles are common to all sets, and each has its own."""
    sets = [np.array([*range(10), *range(100 + 10 * i, 110 + 10 * i)], np.uint64) for i in range(8000)]
    started = time.process_time()
    assert similar.similar_links(list(range(len(sets))), sets) == []
    assert time.process_time() - started < 1.0


@pytest.mark.parametrize("i", [24627, 39640, 89557])
def test_a_pair_without_a_common_minhash_key_links(spark, i):
    """Similarity 0.8 exactly; as candidates by such keys both texts stayed."""
    words = [f"{c}{i}" for c in "abcdefghi"]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, "another text")]
    own, other = (similar.keys_of(similar.shingles_of(t)) for _, t in rows[:2])
    assert not any(a == b for a, b in zip(own, other, strict=True))
    assert brute_kept(rows) == [1, 3]
    assert sorted(r["doc_id"] for r in similar.dedup(docs_of(spark, rows)).collect()) == [1, 3]


def families(rng, n, longest):
    """Sets of hashes around common ones, of many sizes, most a little above or below similarity 0.8 to others."""
    sets = []
    for _ in range(n):
        base = rng.integers(0, 1 << 64, int(rng.integers(1, longest)), np.uint64)
        for _ in range(4):
            cut, more = (int(len(base) * x) for x in rng.uniform(0, 0.16, 2))
            sets.append(np.unique(np.concatenate([rng.permutation(base)[cut:], rng.integers(0, 1 << 64, more, np.uint64)])))
    return sets


def entry_rows(sets, common, ranks, part):
    made = [similar.entries_of(s, common, ranks, part) for s in sets]
    node = np.repeat(np.arange(len(sets)), [len(m) for m in made])
    rows = np.insert(np.concatenate(made), 1, node, axis=1)
    return rows[np.argsort(rows[:, 0], kind="stable")]


def linked_pairs(sets):
    held = [set(s.tolist()) for s in sets]
    return [(a, b) for b in range(len(held)) for a in range(b) if held[a] and similarity(held[a], held[b]) >= 0.8]


def groups_of(n, pairs):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        parent[find(a)] = find(b)
    return [find(a) for a in range(n)]


@pytest.mark.parametrize("part, longest", [(similar.PART, 60), (similar.PART, 1500), (8, 60), (1, 40), (384, 700)])
def test_candidates_lose_no_link(part, longest):
    """Any order and any number of parts: all linked pairs are joined, and few others."""
    rng = np.random.default_rng(part + longest)
    sets = families(rng, 60, longest)
    common = np.unique(rng.choice(np.concatenate(sets), 200))
    rows = entry_rows(sets, common, rng.permutation(len(common)), part)
    group, wanted = groups_of(len(sets), similar.bucket_links(rows).tolist()), linked_pairs(sets)
    assert len(wanted) > 50 and all(group[a] == group[b] for a, b in wanted)
    assert part != similar.PART or all(a // 4 == b // 4 for b in range(len(sets)) for a in range(b) if group[a] == group[b])


@pytest.mark.parametrize("close, bucket", [(16, 16_384), (2, 16_384), (3, 12)])
def test_buckets_of_any_size_and_batch(monkeypatch, close, bucket):
    """Sixty sets around one: searched in steps, as a forest, or beyond the limit all taken as candidates."""
    rng = np.random.default_rng(13)
    base = rng.integers(0, 1 << 64, 100, np.uint64)
    sets = [np.unique(np.append(rng.permutation(base)[int(rng.integers(0, 14)) :], [np.uint64(i)])) for i in range(60)]
    sets += families(rng, 10, 50)
    rows = entry_rows(sets, base[:0], np.zeros(0, np.int64), similar.PART)
    monkeypatch.setattr(similar, "CLOSE", close)
    monkeypatch.setattr(similar, "BUCKET", bucket)
    names = [f"c{x}" for x in range(rows.shape[1])]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in rows[at : at + 7].T], names=names) for at in range(0, len(rows), 7)]
    found = [(a, b) for batch in similar._candidates(iter(batches)) for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    group = groups_of(len(sets), found)
    assert all(group[a] == group[b] for a, b in linked_pairs(sets))


def test_unrelated_sets_with_a_common_passage_are_no_candidates():
    """A third of every set is common to all: known as common it comes last, else places and parities tell."""
    rng = np.random.default_rng(14)
    passage = rng.integers(0, 1 << 64, 100, np.uint64)
    sets = [np.unique(np.append(passage, rng.integers(0, 1 << 64, 200, np.uint64))) for _ in range(300)]
    for common in (passage[:0], np.sort(passage)):
        rows = entry_rows(sets, common, np.arange(len(common)), similar.PART)
        assert len(similar.bucket_links(rows)) == 0


def test_clashing_names_stay(spark):
    rows = [(1, "a b c", 5, "x", 1, 2), (2, "a b c", 6, "y", 3, 4), (3, "other", 7, "z", 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long, _doc string, node int, _bits int")
    for made in (similar.dedup(docs), simhash.dedup(docs)):
        assert made.columns == docs.columns and sorted(map(tuple, made.collect())) == [rows[0], rows[2]]


def test_bitmaps_choose_rows(spark):
    rows = spark.range(0, 1000, 1, 7).select(F.monotonically_increasing_id().alias("_row"), "id")
    wanted = kept(rows.where("id % 3 = 0 or id > 800"))
    assert only(kept(rows), wanted.select("_row"), F.col("_row")).select("id").exceptAll(wanted.select("id")).isEmpty()
    assert only(kept(rows), wanted, F.col("_row")).count() == wanted.count()


def test_forget_removes_only_its_own_tables(spark, tmp_path):
    given = str(tmp_path / "given")
    spark.range(3).write.parquet(given)
    with recorded() as made:
        one, two = kept(spark.range(5)), kept(spark.range(6))
    assert len(made) == 2
    forget(*made, spark.read.parquet(given), but=two.where("id > 1"))
    assert spark.read.parquet(given).count() == 3 and two.count() == 6
    with pytest.raises(Exception):
        one.count()
