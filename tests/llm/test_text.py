"""Personal data, segmentation and packing against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkrank.llm import packing, pieces, pii, queries

TEXTS = [
    None, "", " ", "the cat", "The  Cat!", "hello\nworld\t\r", "日本ab क़ é ǅ", "a².b x.y².z", "▁a ▁▁ b", "İ! <|endoftext|> it's",
    "don't %%% a_b 12.5", "x" * 30_000, "long words " * 20_000, "same", "same",
]


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [("ip", *m.span())] * all(int(p) <= 255 for p in m[0].split("."))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if n % 2 == 0 else (2 * d - 9 * (d > 4)) for n, d in enumerate(reversed(digits)))
        out += [("card", *m.span())] * (16 <= len(digits) <= 19 and total % 10 == 0)
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [("phone", *m.span())] * (8 <= sum(c.isdigit() for c in m[0]) <= 15)
    return out


@pytest.mark.parametrize("alphabet", ["a1@.", "a1@._%+- ", "0123456789- .+()", "012 -.", "+1 ().-9x"])
def test_spans_equal_plain_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(8000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert [s[:3] for s in pii.spans_of(text) if s.kind in pii.BASE_KINDS] == plain_spans(text)


def test_checks_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    found = {s.kind: s for s in pii.spans_of("my card 4111 1111 1111 1111, IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789")}
    assert set(found) == {"card", "iban", "ssn"} and found["card"].score == 1.0
    assert pii.spans_of("part 123-45-6789, DE88 3704 0044 0532 0130 00") == []
    assert pii.score("ip", "version 1.2.3.4", 8, 15) < pii.PRIOR["ip"] < pii.score("ip", "host 1.2.3.4", 5, 12)
    assert pii.masked("write a.b@c.de or +1 (017) 555-7713.") == "write [EMAIL] or [PHONE]."


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000, "1." * 90_000, "a@" * 90_000, "a.b@c.d_" * 20_000, "+1" * 90_000])
def test_long_runs_take_linear_time(text):
    pii.spans_of(text)


IBANS = ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947", "FR1420041010050500013M02606"]


@pytest.mark.parametrize("after", ["", ".", ", x", " thanks", " Thanks", " 12 May", " A B C D E F G H I J K L M N", " 7", " AB12 3", "\nX"])
@pytest.mark.parametrize("iban", IBANS)
def test_iban_ends_before_what_follows(iban, after):
    text = f"IBAN {iban}{after}"
    assert [s[:3] for s in pii.spans_of(text) if s.kind == "iban"] == [("iban", 5, 5 + len(iban))]
    assert pii.masked(text) == f"IBAN [IBAN]{after}"


@pytest.mark.parametrize("before, kept", [("", True), ("serial ", False), ("checksum of ", False), ("serial, bank ", True)])
def test_score_decides_the_added_kinds_and_no_base_kind(before, kept):
    text = f"{before}DE89370400440532013000"
    found = [s for s in pii.spans_of(text) if s.kind == "iban"]
    assert bool(found) == kept and (pii.masked(text) == f"{before}[IBAN]") == kept
    assert all(s.score >= pii.THRESHOLD for s in found)
    version = pii.spans_of("version 10.2.3.4")
    assert [(s.kind, s.score) for s in version] == [("ip", 0.3)] and pii.masked("version 10.2.3.4") == "version [IP]"


def test_ibans_in_a_row_and_wrong_ones():
    assert pii.masked(f"bank {' '.join(IBANS)} Thanks") == "bank [IBAN] [IBAN] [IBAN] [IBAN] Thanks"
    for text in ("DE88 3704 0044 0532 0130 00 Thanks", "XDE89 3704 0044 0532 0130 00 A", "DE89 3704 0044 0532 0130 00A B", "DE89 3704 A"):
        assert not [s for s in pii.spans_of(f"bank {text}") if s.kind == "iban"]


@pytest.mark.parametrize("text", ["AB12 " * 40_000, "AB12" * 50_000, "DE89 " + "A " * 100_000, "DE893704004405320130 00 " * 10_000])
def test_long_runs_of_iban_heads_take_linear_time(text):
    pii.spans_of(text)


def test_mask_keeps_rows_and_columns(spark):
    rows = [(i, t, "x", 1.0) for i, t in enumerate([*TEXTS, "é a@b.co"])] + [(None, "1.2.3.4", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, score double")
    made = sorted(pii.mask(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    assert [r["text"] for r in made] == [*TEXTS, "é [EMAIL]", "[IP]"] and made[0]["spans"] == "x"
    spans = {r["doc_id"]: r["spans"] for r in pii.find_spans(docs).collect()}
    assert spans[len(TEXTS)][0]["start"] == 2 and len(spans) == len(rows)


@pytest.fixture(scope="module")
def segmenter():
    return pieces.Segmenter(pieces.default_model(), words=50)


def all_scores(segmenter, text):
    edges = segmenter._edges(segmenter.model.normalize(text))

    def upto(at):
        return [0.0] if at == 0 else [s + score for start, score, _ in edges[at] for s in upto(start)]

    return sorted(upto(len(edges) - 1), reverse=True)


def test_nbest_equals_all_segmentations(segmenter):
    rng = random.Random(0)
    short = ["", " ", "the cat", "a².b", "日本ab", "é \n x"] + ["".join(rng.choice("the aion\n.²▁") for _ in range(rng.randint(1, 11))) for _ in range(120)]
    for text in short:
        got = segmenter.encode(text, 4)
        assert [s for s, _ in got] == all_scores(segmenter, text)[:4]
        assert len({ids for _, ids in got}) == len(got)
        normal = segmenter.model.normalize(text)
        assert all(segmenter.decode(ids) == normal for _, ids in got)
        assert [s for s, _ in segmenter.nbest(normal, 4)] == [s for s, _ in got]


def test_nbest_of_a_table(spark, segmenter):
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(TEXTS)] + [(None, "the", 9)], "doc_id long, text string, rank int")
    made = pieces.encode_nbest(docs, 3)
    back = pieces.decode(made).collect()
    assert all(r["round_trip"] for r in back)
    for r in back:
        if r["doc_id"] is not None and "▁" not in (TEXTS[r["doc_id"]] or ""):
            assert r["text"] == (TEXTS[r["doc_id"]] or "")
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["n_pieces"] == len(r["ids"])
    scores = defaultdict(list)
    for r in sorted(back, key=lambda r: r["rank"]):
        scores[r["doc_id"]].append(r["score"])
    assert all(s == sorted(s, reverse=True) for s in scores.values()) and len(scores) == len(TEXTS) + 1
    assert Counter(len(s) for i, s in scores.items() if i in (0, 1)) == {1: 2}
    assert pieces.encode_nbest(docs.limit(0)).count() == 0


def test_the_nbest_query_returns_its_segmentations(spark, tmp_path, segmenter):
    texts = [None, "", "the cat", "日本ab क़ é", "long words " * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    found = defaultdict(list)
    for r in pieces.decode(queries.op5_nbest_pieces(spark, str(tmp_path))).orderBy("rank").collect():
        ids = bytes(r["ids"])
        assert r["n_pieces"] == len(ids) // 4 and r["ids_crc32"] == zlib.crc32(ids) and r["text"] == segmenter.text(ids)
        found[r["doc_id"]].append((r["score"], ids))
    assert found == {i: segmenter.encode(t, 4) for i, t in enumerate(texts)}


def test_ids_are_those_of_the_tokenizer(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(3)
    parts = ["a", "B", "é", "É", "İ", "ﬁ", "'s", "'", "!", "1", "日", " ", "\n", "\xa0", "\t", "\x1c", "́", "क़", "...", "_", "×", "ß", "ǅ", "the", "Word"]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    given = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    coder = packing.Encoder(packing.default_tokenizer(), words=3000)
    every = [*odd, *given, *(t or "" for t in TEXTS)]
    got = [np.frombuffer(ids, "<u4").tolist() for at in range(0, len(every), 64) for ids in coder.encode(every[at : at + 64])]
    assert got == [e.ids for e in plain.encode_batch(every, add_special_tokens=False)]


def test_pack_places_every_piece(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)] + [(None, "a", 5), (3, "the cat", 5)], "doc_id long, text string, length int")
    made = packing.pack(docs).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for i, text in [*enumerate(TEXTS), (None, "a"), (3, "the cat")]:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected[i, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in made) == expected
    filled = defaultdict(list)
    for r in made:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(filled) == -(-sum(length for p in filled.values() for _, length in p) // 2048)
    assert packing.pack(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rule", packing.RULES)
def test_plans_respect_every_capacity(rule):
    rng = random.Random(rule)
    for trial in range(150):
        limits = packing.Limits(64, rng.choice([64, 5, 3]), rng.choice([64 * 64, 1600]))
        longest = 64 if limits.attention == 64 * 64 else 40
        histogram = Counter(rng.randint(1, longest) for _ in range(rng.randint(0, 300)))
        slots, sequences = packing.plan(dict(histogram), limits, rule)
        filled = defaultdict(list)
        for s in slots:
            following = min((t.first for t in slots if t.length == s.length and t.first > s.first), default=histogram[s.length])
            for number in range(s.first, following):
                nth, within = divmod(number - s.first, s.each)
                filled[s.sequence + nth].append((s.offset + within * s.length, s.length))
        assert len(filled) == sequences and sum(map(len, filled.values())) == sum(histogram.values())
        for places in filled.values():
            places.sort()
            assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
            lengths = [n for _, n in places]
            assert sum(lengths) <= 64 and len(lengths) <= limits.documents and sum(n * n for n in lengths) <= limits.attention
