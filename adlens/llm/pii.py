"""Personal data: expressions propose spans, checksums confirm, context scores.

Each kind's expression proposes spans; validators confirm them (octets of an
address, Luhn for cards, mod 97 for account numbers, digit counts for phones);
words near a span move its score. Confirmed base kinds are always reported;
the further kinds only from ``min_score`` on. All on whole texts, in one pass
over the table, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import SPAN, SPAN_ARROW, map_texts, read, span_count, span_string

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id")

# What follows the local part of an address; the local part is found backwards
# from the sign, so a long run of letters is read once and not once per letter.
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive runs from the first digit of a run: the same leftmost matches in
# linear time.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
                  r"(?![A-Za-z0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Words that raise the score of a kind when they stand near a span, in either case.
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "fax", "mobile"),
    "iban": ("iban", "account", "bank", "transfer"),
    "national_id": ("ssn", "social", "security", "insurance"),
}
CONTEXT_WORDS = {k: re.compile(r"\b(?:%s)\b" % "|".join(v), re.IGNORECASE)
                 for k, v in CONTEXT.items()}
WINDOW = 40
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "national_id": 0.4}
NEAR_BONUS = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if n % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(number: str) -> bool:
    """Account numbers: country and check digits moved to the end, letters as 10 to 35."""
    n = 0
    for c in number[4:] + number[:4]:
        n = int(f"{n}{int(c, 36)}") % 97
    return n == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in EMAIL_TAIL.finditer(text):
        a = m.start()
        while a > last and text[a - 1] in EMAIL_LOCAL:
            a -= 1
        if a < m.start():
            last = m.end()
            yield a, last


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [x.lstrip("0") or "0" for x in m.groups()]
        if all(len(x) <= 3 and int(x) <= 255 for x in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        number = m.group().replace(" ", "")
        if 15 <= len(number) <= 34 and mod97(number):
            yield m.span()


def national_ids(text: str) -> Iterator[tuple[int, int]]:
    for m in NATIONAL_ID.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


PROPOSERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans,
             "national_id": national_ids}


def score(kind: str, text: str, start: int, end: int) -> float:
    around = f"{text[max(0, start - WINDOW):start]} {text[end:end + WINDOW]}"
    near = CONTEXT_WORDS[kind].search(around) is not None
    return round(min(1.0, PRIOR[kind] + NEAR_BONUS * near), 3)


def spans_of(text: str | None, min_score: float) -> list[dict]:
    if not text:
        return []
    found = []
    for kind in KINDS:
        for a, b in PROPOSERS[kind](text):
            s = score(kind, text, a, b)
            if kind in BASE_KINDS or s >= min_score:
                found.append({"kind": kind, "start": a, "end": b, "value": text[a:b], "score": s})
    return found


def find_pii(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
             min_score: float = 0.6) -> DataFrame:
    """``keep`` plus ``spans`` (kind, start, end in code points, value, score).

    One row per input row, repeated rows included; null and empty texts have no
    spans; null ids stay null. Spans come by kind as listed in ``KINDS``, then
    by start. Spans of one kind never overlap; kinds may.
    """
    def scan(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        return {"spans": pa.array([spans_of(t, min_score) for t in texts], SPAN_ARROW)}

    return map_texts(docs, text_col, list(keep), f"spans {SPAN}", scan)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data in all ``documents``, by ``find_pii``; one row a document."""
    found = find_pii(read(spark, sf_dir, "documents"))
    base = list(BASE_KINDS)
    return found.select(
        "doc_id", *[span_count("spans", k).alias(f"n_{k}") for k in base],
        F.sha2(span_string("spans", base), 256).alias("base_sha256"),
        span_string("spans").alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",")
        .alias("scores"))
