"""Operator 6: personal data: regular expressions propose spans, validators confirm them, nearby words adjust the score.

Base kinds (the contract's): ``email``, ``ip`` (four parts of at most 255), ``card`` (12 to 19 digits passing Luhn), ``phone``
(``+`` and 9 to 15 digits), each leftmost and non-overlapping within its kind; a match that fails its check is dropped. Added
kinds: ``iban`` (mod-97 remainder 1, of its country's length or up to the end of the run), ``ssn`` (three-two-four digits with a valid area, group and serial) and ``local_phone``
(ten grouped digits without ``+``). Every proposal starts at its kind's score; a context word of the kind within 40 characters
before it adds 0.3, a word that speaks against it takes 0.3 away. Added spans need 0.5, so an ssn or a local phone needs context,
and they must not overlap a base span. Base spans always stay, with their score.

The searches are linear in the text: an email is looked for around each ``@``, and the digit runs use possessive quantifiers,
which cannot match differently because what follows a run is never a digit.

Defined results: a null text counts as empty and has no spans (redaction leaves it null); offsets are code points, the end is
exclusive; repeated rows give repeated results; only the id and text columns decide, other columns pass redaction unchanged
except ``n_chars``, which follows the new text where the column exists.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.common import map_rows

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "local_phone")

#: Score of a confirmed proposal before its context.
START = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.6, "iban": 0.9, "ssn": 0.4, "local_phone": 0.4}
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"), "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax"), "iban": ("iban", "account", "bank", "konto"),
    "ssn": ("ssn", "social security"), "local_phone": ("phone", "tel", "call", "mobile", "fax"),
}
AGAINST = ("version", "isbn", "order no", "ticket", "invoice", "serial")
NEAR, LEAST = 40, 0.5

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Letters and digits of an IBAN by its country; the words and numbers after it can look like more of it.
_IBAN_SIZE = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}.items() for c in codes.split()}
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _emails(text: str):
    start, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > start and text[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        start = at + 1
        if m:
            yield lo, m.end()
            start = m.end()
        at = text.find("@", start)


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) < 256


def _base(text: str):
    for a, b in _emails(text):
        yield "email", a, b
    for m in _IP.finditer(text):
        if all(map(_byte, m[0].split("."))):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield "phone", *m.span()


def _ibans(text: str):
    m = _IBAN.search(text)
    while m:
        ends = [m.end()]
        if size := _IBAN_SIZE.get(m[0][:2]):
            places = [i for i, c in enumerate(m[0], 1) if c != " "]
            if size <= len(places) and m[0][places[size - 1] :][:1] in ("", " "):
                ends.insert(0, m.start() + places[size - 1])
        end = next((e for e in ends if mod97(text[m.start() : e])), None)
        if end:
            yield "iban", m.start(), end
        m = _IBAN.search(text, end or m.start() + 1)


def _added(text: str):
    yield from _ibans(text)
    for m in _SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span()
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span()


def _score(text: str, kind: str, start: int) -> float:
    before = text[max(0, start - NEAR) : start].lower()
    s = START[kind] + 0.3 * any(w in before for w in CONTEXT[kind]) - 0.3 * any(w in before for w in AGAINST)
    return round(min(1.0, max(0.0, s)), 3)


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in order of start, kind and end."""
    if not text:
        return []
    spans = [(k, a, b, _score(text, k, a)) for k, a, b in _base(text)]
    taken: list[list[int]] = []  # the base spans' cover, disjoint and in order
    for a, b in sorted(s[1:3] for s in spans):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    last = 0
    for k, a, b in sorted(_added(text), key=lambda x: (x[1], KINDS.index(x[0]))):
        i = bisect_left(taken, [b, 0])
        if a >= last and not (i and taken[i - 1][1] > a) and (s := _score(text, k, a)) >= LEAST:
            spans.append((k, a, b, s))
            last = b
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end, score>>) for every row."""
    src = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))
    kind = "array<struct<kind: string, start: int, end: int, score: double>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find(t)] for t in b.column(1).to_pylist()]
            return pa.record_batch([b.column(0), pa.array(spans, arrow)], names=["k", "spans"])

        return work

    return map_rows(src, start, f"k long, spans {kind}").withColumnRenamed("k", id_col)


def digests(found: DataFrame) -> DataFrame:
    """The contract's counts and digests of ``find_pii``."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(number(k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redacted(text: str) -> str:
    """``text`` with every span replaced by its kind in square brackets; overlapping spans become one, named by the first."""
    out, at, spans = [], 0, find(text)
    i = 0
    while i < len(spans):
        kind, a, b, _ = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < b:
            b = max(b, spans[i][2])
            i += 1
        out += text[at:a], f"[{kind.upper()}]"
        at = b
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in the text column; same columns, same rows."""
    schema = docs.schema

    def start():
        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            at = b.schema.names.index(text_col)
            old = b.column(at).to_pylist()
            new = [t and redacted(t) for t in old]
            b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
            if length_col in b.schema.names:
                n = b.schema.names.index(length_col)
                sizes = [x if t is None or t == s else len(s) for x, t, s in zip(b.column(n).to_pylist(), old, new)]
                b = b.set_column(n, b.schema.field(n), pa.array(sizes, b.schema.field(n).type))
            return b

        return work

    return map_rows(docs, start, schema)
