"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

Kinds email, ip, card and phone are the base: what their pattern and check pass
is always reported and masked, with a score that context raises or lowers, so
that a reader may set a bar of its own: a missed address costs more than a masked
version number. Kinds iban and ssn are added only if their score reaches
``THRESHOLD``: an IBAN by its mod-97 check unless words beside it tell of serial
numbers or checksums and none of an account, a social security number only beside
a word that announces it. Patterns are written so that each takes time in
proportion to the text, also on endless runs of digits or letters. A null or
empty text has no span and stays as it is; repeated rows give the same spans
each, an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from sparkrank.llm.shared import per_batch, replaced

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
THRESHOLD = 0.5
#: Code points before and after a span that count as its context.
BEFORE, AFTER = 48, 16
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
RAISE, LOWER = 0.3, 0.3
HINTS = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "dial"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social security"),
}
DOUBTS = {
    "email": ("example of",),
    "ip": ("version", "release", "section", "chapter"),
    "card": ("serial", "isbn", "order", "tracking", "checksum"),
    "phone": ("serial", "isbn", "order", "version"),
    "iban": ("serial", "checksum"),
    "ssn": ("serial", "order", "part"),
}

LOCAL = "[A-Za-z0-9._%+-]"
#: A local part begins where a run of its characters begins, or right after a match.
EMAIL = re.compile(rf"(?<!{LOCAL}){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
EMAIL_HERE = re.compile(rf"{LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
#: Sixteen digits or more of a chain; shorter chains cannot pass.
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){15,}+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Only the head of a number; what follows it may belong to the text.
IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
IBAN_REST = re.compile(r"(?:\x20?[A-Z0-9]){11,30}+")
IBAN_END = re.compile(r"[A-Z0-9](?![A-Z0-9])")
#: Lengths by country, blanks left out.
IBAN_LENGTH = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGIT = re.compile(r"[0-9]")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    """The check of an IBAN: rotated by four, letters as 10 to 35, remainder 1."""
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while text.find("@", at) >= 0:
        found = (at and EMAIL_HERE.match(text, at)) or EMAIL.search(text, at)
        if not found:
            return
        yield found.span()
        at = found.end()


def _octets(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= len(DIGIT.findall(m[0])) <= 15:
            yield m.span()


def _iban_end(text: str, start: int) -> int | None:
    """Where the number that begins at ``start`` ends, if one does.

    It ends where a run of its characters does. The length of its country goes
    first, then the longest run; a country without one may end at any.
    """
    rest = IBAN_REST.match(text, start + 4)
    if not rest:
        return None
    ends = [m.end() for m in IBAN_END.finditer(text[start : rest.end() + 1]) if m.end() <= rest.end() - start]
    codes = {start + e: code for e in reversed(ends) if 15 <= len(code := text[start : start + e].replace(" ", "")) <= 34}
    if length := IBAN_LENGTH.get(text[start : start + 2]):
        longest = next(iter(codes), None)
        codes = {e: c for e, c in codes.items() if len(c) == length} | {e: c for e, c in codes.items() if e == longest}
    return next((e for e, code in codes.items() if mod97(code)), None)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := IBAN.search(text, at):
        end = _iban_end(text, m.start())
        if end:
            yield m.start(), end
        at = end or m.end()


FINDERS = {
    "email": _emails,
    "ip": _octets,
    "card": _cards,
    "phone": _phones,
    "iban": _ibans,
    "ssn": lambda text: (m.span() for m in SSN.finditer(text)),
}


def score(kind: str, text: str, start: int, end: int) -> float:
    around = f"{text[max(0, start - BEFORE) : start]} {text[end : end + AFTER]}".lower()
    value = PRIOR[kind] + RAISE * any(w in around for w in HINTS[kind]) - LOWER * any(w in around for w in DOUBTS[kind])
    return round(min(1.0, max(0.0, value)), 2)


def spans_of(text: str | None) -> list[Span]:
    """All spans, by kind as listed in ``KINDS``, then by start; code points, end exclusive."""
    if not text or not ("@" in text or DIGIT.search(text)):
        return []
    found = (Span(kind, a, b, score(kind, text, a, b)) for kind in KINDS for a, b in FINDERS[kind](text))
    return [s for s in found if s.kind in BASE_KINDS or s.score >= THRESHOLD]


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) per row of ``docs``: array of (kind, start, end, score), see ``spans_of``."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[s._asdict() for s in spans_of(t)] for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(
        docs.select("doc_id", "text"),
        make,
        f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint, score: double>>",
    )


def masked(text: str | None) -> str | None:
    """Every span replaced by its kind in brackets; of spans that overlap the first listed names it."""
    if not (found := spans_of(text)):
        return text
    out, at = [], 0
    regions: list[list] = []
    for s in sorted(found, key=lambda s: (s.start, KINDS.index(s.kind))):
        if regions and s.start < regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], s.end)
            regions[-1][2] = min(regions[-1][2], s.kind, key=KINDS.index)
        else:
            regions.append([s.start, s.end, s.kind])
    for start, end, kind in regions:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` masked; all columns and rows stay."""
    at = docs.columns.index("text")
    return per_batch(
        docs, lambda batch: replaced(batch, "text", [masked(t) for t in batch.column(at).to_pylist()]), docs.schema
    )
