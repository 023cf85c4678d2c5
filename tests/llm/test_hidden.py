"""The hidden Markov model against sums over all paths of states, and plain counts."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkrank.llm import hidden


def some_model(symbols, states, seed=0):
    rng = np.random.default_rng(seed)
    first, moves, emits = rng.random(states), rng.random((states, states)), rng.random((symbols, states))
    return hidden.Model(first / first.sum(), moves / moves.sum(1)[:, None], emits / emits.sum(0))


def paths(model, sequence):
    """(probability, states) of every path."""
    for states in itertools.product(range(len(model.first)), repeat=len(sequence)):
        p = model.first[states[0]] * model.emits[sequence[0], states[0]]
        for a, b, s in zip(states, states[1:], sequence[1:]):
            p *= model.moves[a, b] * model.emits[s, b]
        yield p, states


SEQUENCES = [[0, 1, 2, 1], [3], [2, 2], [0, 3, 1, 2, 0, 1], [1], [3, 0, 3]]


def batch_of(sequences):
    return hidden.Batch(np.array([s for x in sequences for s in x], np.int64), np.array([len(x) for x in sequences], np.int64))


def test_likelihoods_equal_all_paths():
    model = some_model(4, 3)
    wanted = [math.log10(sum(p for p, _ in paths(model, s))) for s in SEQUENCES]
    assert np.allclose(batch_of(SEQUENCES).likelihoods(model), wanted, atol=1e-12)


@pytest.mark.parametrize("tokens", [1, 3, 7, 1000])
def test_expected_counts_equal_all_paths(tokens):
    model = some_model(4, 3)
    first, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for sequence in SEQUENCES:
        every = list(paths(model, sequence))
        whole = sum(p for p, _ in every)
        for p, states in every:
            first[states[0]] += p / whole
            for a, b in zip(states, states[1:]):
                moves[a, b] += p / whole
            for s, k in zip(sequence, states):
                emits[s, k] += p / whole
    counts = np.zeros((4, 3))
    made = batch_of(SEQUENCES).expected(model, counts, tokens)
    assert np.allclose(made[0], first) and np.allclose(made[1], moves) and np.allclose(counts, emits)


def test_long_sequences_do_not_underflow():
    model, one = some_model(4, 3), [0, 1, 2, 3] * 5000
    assert -20_000 * 2 < batch_of([one]).likelihoods(model)[0] < -1000


def fixture():
    rng = random.Random(3)
    common = ["the", "The", "of.", "é", "a b", "x" * 50]
    rows = []
    for i in range(400):
        words = [rng.choice(common) if rng.random() < 0.7 else f"w{rng.randint(0, 900)}" for _ in range(rng.randint(0, 60))]
        rows.append((i, rng.choice([" ", "\n", "\t \r"]).join(words)))
    return [*rows, (5, None), (6, ""), (None, "the end"), (7, rows[7][1]), (8, "the of. " * 40_000)]


def test_base_score_and_counts(spark):
    docs = fixture()
    table = spark.createDataFrame([(*d, 1, 2.0, "x") for d in docs], "doc_id long, text string, c int, base double, word string")
    made = hidden.score_documents(table, states=3, rounds=2).collect()

    def out(doc_id):
        return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1

    def tokens(text):
        return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [""]

    counts = Counter(t for d, text in docs if not out(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for d, text in docs:
        base = math.fsum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(text))
        wanted.append((d or -1, out(d), len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), n, round(base, 6)))
    got = [(r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in made]
    assert sorted(got) == sorted(wanted)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in made)


def test_score_is_a_probability(spark, monkeypatch):
    """Words seen and one unseen word per class: the chances of the second token sum to 1."""
    monkeypatch.setattr(hidden, "FREQUENT", 0.05)
    docs = [(i, t) for i, t in enumerate(["a b c", "a a bcd", "b xyz", "xyz q a", "", "c c a b"] * 2)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    known = hidden.vocabulary(rows)
    assert 0 < len(known.own) < known.words
    classes = len(known.own)
    seen = {r["word"].encode(): r["c"] for r in known.counts.collect()}
    model = some_model(len(known.symbols), 3)
    total = 0.0
    for word, (symbol, _) in known.own.items():
        total += 10 ** batch_of([[symbol]]).likelihoods(model)[0]
    for c in range(hidden.CLASSES):
        share = known.symbols[classes + c] + hidden.DISCOUNT
        own = [n for w, n in seen.items() if w not in known.own and hidden.class_of(w) == c]
        inside = sum(n - hidden.DISCOUNT for n in own) + hidden.DISCOUNT * known.types[c] + hidden.DISCOUNT
        assert len(own) == known.types[c]
        total += 10 ** batch_of([[classes + c]]).likelihoods(model)[0] * inside / share
    assert abs(total - 1) < 1e-9


def test_rounds_raise_the_likelihood(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(("ab cd ef gh", "ij kl mn op")[i % 2].split()) for _ in range(30))) for i in range(200)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    before, after = (hidden.score_documents(table, 2, rounds).agg({"score": "sum", "base_score": "sum"}).first() for rounds in (0, 6))
    assert after["sum(score)"] > before["sum(score)"] and after["sum(score)"] > after["sum(base_score)"]


def test_empty_table(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert hidden.score_documents(table, 2, 1).collect() == []
