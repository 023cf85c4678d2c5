"""Distances of sources against a plain count in Python integers."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from sparkrank.llm import counting, divergence


def plain(docs, least, top):
    rx = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    upper = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    groups, documents = {}, {}
    for text, lang, source in docs:
        words = [w.translate(upper) for w in rx.findall(text or "")]
        groups.setdefault(lang or "", {}).setdefault(source or "", Counter()).update(words)
        documents.setdefault(lang or "", Counter()).update(set(words))
    out = []
    for lang, sources in groups.items():
        terms = [t for t, d in documents[lang].items() if d >= least]

        def shares(count):
            whole = sum(count[t] for t in terms) + 5 * len(terms)
            return {t: 1 + 10**9 * (count[t] + 5) // whole for t in terms}

        p = {s: shares(c) for s, c in sources.items()}
        q = shares(sum(sources.values(), Counter()))
        for s, count in sources.items():
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in terms), o.encode(), o) for o in sources if o != s)
            more = sorted((q[t] - p[s][t], t.encode(), t) for t in terms if count[t] and p[s][t] > q[t])
            for part, ranked in (("pair", pairs), ("term", more[:top])):
                out += [(lang, s, part, item, -value, at) for at, (value, _, item) in enumerate(ranked, 1)]
    return sorted(out)


def words(rng, n):
    return " ".join(rng.choice(["The", "the", "Ünder", "ünder", "a1b", "x-y", "日本", "E", "q", "zz", "\x00k", "Ñ"]) for _ in range(n))


@pytest.mark.parametrize("tile", [1, 2, 64])
def test_audit_equals_plain(spark, tile):
    rng = random.Random(tile)
    docs = [(words(rng, rng.randint(0, 9)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "é", "c", "d", None])) for _ in range(150)]
    docs += [("", "xx", "only"), (None, "yy", "p"), ("zz", "yy", "q"), ("zz", "yy", "q"), ("the " * 3000, "en", "a")]
    table = spark.createDataFrame([(*d, 1, "n") for d in docs], "text string, lang string, source string, n int, term string")
    made = divergence.audit(table, min_documents=4, terms=3, tile=tile)
    assert made.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, made.collect())) == plain(docs, 4, 3)


def test_empty_table(spark):
    table = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(table).collect() == []


@pytest.mark.parametrize("rows,terms,share", [(1, 3, 0.5), (4, 16, 0.1), (8, 24, 0.02), (8, 8, 1.0), (16, 64, 0.0)])
def test_joint_descent_equals_dense(rows, terms, share):
    rng = np.random.default_rng(rows)
    trees, dense = [], []
    for _ in range(2):
        values = rng.integers(1, 10**9, (rows, terms)) * (rng.random((rows, terms)) < share)
        zero = rng.integers(1, 9, rows)
        trees.append(divergence.Quadtree(values, zero))
        dense.append(np.where(values == 0, zero[:, None], values))
    wanted = np.abs(dense[0][:, None] - dense[1][None]).sum(2)
    assert (divergence.distances(*trees) == wanted).all()
    own = np.abs(dense[0][:, None] - dense[0][None]).sum(2)
    assert (np.triu(divergence.distances(trees[0], trees[0]), 1) == np.triu(own, 1)).all()


def test_small_blocks_give_the_same(monkeypatch):
    rng, sums = random.Random(1), []
    entries = sorted({(f"t{rng.randint(0, 40)}", rng.randint(0, 4)): rng.randint(1, 999) for _ in range(120)}.items())
    for leaves in (1, 1 << 20):
        monkeypatch.setattr(divergence, "LEAVES", leaves)
        cell = divergence._Cell(("en", 0, 0, 0), 64)
        for gid in range(5):
            cell.header(gid, gid + 1)
        for (term, gid), p in entries:
            cell.entry(gid, term, p)
        sums.append(cell.rows().to_pydict())
    assert sums[0] == sums[1]


def test_counting_in_bounded_memory():
    tally = counting.Tally(lambda key, n, d: (key, dict(n), dict(d)), held=2)
    seen = set()
    tally.add("g", ["a", "a"], seen)
    assert list(tally.flushed()) == []
    tally.add("g", ["a", "b", "c"], seen)
    assert list(tally.flushed()) == [("g", {"a": 3, "b": 1, "c": 1}, {"a": 1, "b": 1, "c": 1})]
    assert list(tally.flushed(last=True)) == []
    data = b"aa bb cccc dd"
    for part in range(1, 15):
        assert b" ".join(counting.parts_of(data, part)) == data
