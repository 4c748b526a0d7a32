"""Personal data: patterns propose spans, checks confirm them, context adjusts a score.

Candidates come from regular expressions. A span is confirmed by what its kind can be
checked for: octets of an address, length of a phone number, the Luhn digit of a card,
mod-97 of an account number. Confirmed spans of the four base kinds are always returned;
their score tells how far the words around them support them. Spans of the added kinds
(iban, and cards of 13 to 15 digits) are returned when their check passes and, for the
short cards, when a context word lifts their score over the threshold.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm import common

KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]

# Possessive quantifiers: where the rest fails, no shorter run of the same characters helps.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]")

#: Words that support a kind when they stand within NEAR characters before the span.
CONTEXT = {
    "email": ("mail", "contact", "write", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "llame"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
}
NEAR = 40
#: Score of a span by its pattern and check alone, what context adds, and the least score
#: of a span of an added kind.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "short card": 0.4}
LIFT, LEAST = 0.2, 0.5
_WORDS = {k: re.compile(r"(?<![^\W\d_])(?:" + "|".join(v) + ")", re.IGNORECASE) for k, v in CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`. Whatever place in
    the run before an @ is tried, the same domain follows: each @ is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def spans_of(text: str) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) by kind and start; places count code points."""
    found: list[tuple[str, int, int, float, bool]] = []

    def add(kind: str, start: int, end: int, base: bool, first: float) -> None:
        lifted = _WORDS[kind].search(text, max(0, start - NEAR), start) is not None
        score = min(1.0, first + LIFT * lifted)
        if base or score >= LEAST:
            found.append((kind, start, end, round(score, 2), base))

    if "@" in text:
        for a, b in _mails(text):
            add("email", a, b, True, START["email"])
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            add("ip", m.start(), m.end(), True, START["ip"])
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                long_ = len(digits) >= 16
                add("card", m.start(), m.end(), long_, START["card" if long_ else "short card"])
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                add("phone", m.start(), m.end(), True, START["phone"])
    for m in _IBAN.finditer(text):
        account = m[0].replace(" ", "")
        if 15 <= len(account) <= 34 and mod97(account):
            add("iban", m.start(), m.end(), False, START["iban"])
    return found


_SPAN = "struct<kind:string,start:long,end:long,score:double,base:boolean>"
_SPAN_ARROW = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in common.chunks(batches, "text"):
        out = []
        for text in chunk.column("text").to_pylist():
            out.append(spans_of(text) if text else [])
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int32)
        flat = [dict(zip(("kind", "start", "end", "score", "base"), s)) for x in out for s in x]
        spans = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, _SPAN_ARROW))
        yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), spans], names=["doc_id", "found"])


def find(docs: DataFrame) -> DataFrame:
    """Spans of every row of ``docs`` (doc_id, text): doc_id and found, an array of
    (kind, start, end, score, base) by kind as in KINDS, then start.

    A null or empty text has no spans. A text of any length is read in time that grows with
    it. Repeated rows are answered one by one; null ids stay. Other columns are ignored. An empty table gives an empty result."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(_find, f"doc_id long, found array<{_SPAN}>")


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    base = F.filter("found", lambda s: s["base"])
    counts = [
        F.size(F.filter(base, _is_kind(k))).cast("long").alias(f"n_{k}") for k in BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        F.size("found").cast("long").alias("n_spans"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["score"])), F.lit(0.0)).alias("max_score"),
    )


def redacted_text(text: str) -> str:
    """``text`` with a mark such as <EMAIL> for each span; of spans that overlap, the
    first and longest gives the mark and hides all that they cover."""
    parts, at = [], 0
    for kind, a, b, _, _ in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced by marks; all other columns
    and all rows stay, a null text stays null. ``n_chars``, where it is a column, follows the new text."""
    schema = docs.schema
    place = docs.columns.index("text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in common.chunks(batches, "text"):
            texts = [t and redacted_text(t) for t in chunk.column("text").to_pylist()]
            yield chunk.set_column(place, chunk.schema.field("text"), pa.array(texts, chunk.schema.field("text").type))

    out = docs.mapInArrow(replace, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
