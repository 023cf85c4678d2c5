"""Spelling variants against comparing every two words."""

import random
import re
import zlib
from collections import Counter

import pytest

from sparkrank.llm import variants


def plain_words(docs):
    upper = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(upper)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += len(word) >= 5
    return {w: n for w, n in counts.items() if n >= 3}


def edits(word, letters):
    for at in range(len(word) + 1):
        for c in letters:
            yield word[:at] + c + word[at:]
            if at < len(word):
                yield word[:at] + c + word[at + 1 :]
        yield word[:at] + word[at + 1 :]


def plain(docs):
    words = plain_words(docs)
    letters = set("".join(words))
    near = {w: {e for e in edits(w, letters) if e != w and e in words} for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], [ord(c) for c in o]), default=None)
        forms[w] = best if best and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def fixture(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abÀÿ" if seed else "abcde") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    base += ["aaaaa" + "a" * n for n in range(8)] + ["x" * 3000, "x" * 2999 + "y", "x" * 2999]
    rows = []
    for doc_id in range(250):
        words = [rng.choice(base) for _ in range(rng.randint(0, 40))]
        words = [rng.choice([w, w.upper(), w, w[: len(w) // 2] + rng.choice("abé") + w[len(w) // 2 :]]) for w in words]
        rows.append((doc_id, rng.choice([" ", "1", "\n", "-", "ſ"]).join(words)))
    rows += [(900, " ".join(["chain"] * 40 + ["chains"] * 15 + ["chainsy"] * 5))]
    return [*rows, rows[3], rows[3], (None, rows[5][1]), (7, None), (8, "")]


@pytest.mark.parametrize("seed,bucket", [(0, variants.BUCKET), (1, variants.BUCKET), (1, 5)])
def test_variants_equal_plain(spark, seed, bucket):
    docs = fixture(seed)
    table = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, n int, word string")
    made = variants.group_variants(table, bucket=bucket)
    assert made.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = plain(docs)
    assert len(wanted) > 100 and any(r[2] not in (r[0], r[1]) for r in wanted)
    assert sorted(map(tuple, made.collect())) == wanted


def test_empty_table(spark):
    table = spark.createDataFrame([(1, "1 2 ab")], "doc_id long, text string")
    assert variants.group_variants(table).collect() == variants.group_variants(table.limit(0)).collect() == []


def test_near_pairs_equal_all_pairs():
    rng = random.Random(5)
    for _ in range(300):
        short = list({"".join(rng.choice("abc") for _ in range(5)) for _ in range(rng.randint(0, 60))})
        long = list({"".join(rng.choice("abc") for _ in range(6)) for _ in range(rng.randint(0, 60))})
        words, found = short + long, set()
        variants.near_pairs([(w, i) for i, w in enumerate(short)], [(w, i + len(short)) for i, w in enumerate(long)], found)
        wanted = {
            (i, j) for i in range(len(short)) for j in range(i + 1, len(words))
            if words[j] in set(edits(words[i], "abc"))
        }
        assert found == wanted


def test_hot_half_is_not_compared_in_pairs():
    rng = random.Random(2)
    words = list({"prefix" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(40_000)})
    variants.near_pairs([(w, i) for i, w in enumerate(words)], [], set())
