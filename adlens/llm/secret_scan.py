"""Secret scan over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over the
trigrams that every match must contain. A task indexes its slice of documents
(trigram -> postings of document ordinals), intersects and unites postings as
the query says, and runs the expression only on the candidates. A rule without
mandatory trigrams (a bare character class such as the hexadecimal one) scans
every document. The index is one segment per slice of documents: nothing is
shuffled, memory is bounded by the slice, and a lost task rebuilds its own
segment only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import (SPAN, SPAN_ARROW, map_texts, packed, read, span_count,
                               span_string, text_buffer)


@dataclass(frozen=True)
class Rule:
    """``min_length`` bounds the characters of ``group`` (0: the whole match);
    shorter matches are dropped after matching, without another try."""
    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", group=2, min_length=12, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", min_length=18),
    # runs are maximal, so the bound inside finds the same matches as after it
    Rule("hex", r"[0-9a-f]{16,}", min_length=16),
)
RULES = (
    *BASE_RULES,
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]+", min_length=40),
    Rule("slack", r"(?<![A-Za-z0-9-])xox[abprs]-[A-Za-z0-9-]+", min_length=20),
    Rule("google", r"(?<![A-Za-z0-9_-])AIza[A-Za-z0-9_-]+", min_length=39),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
         min_length=40),
)

# A run of alternatives is tracked as exact strings up to this many; beyond it
# the strings collected so far become a query and a new run starts.
MAX_STRINGS = 16
MAX_CLASS = 4


def trigram_query(pattern: str, flags: int = 0):
    """The Boolean trigram query that every match of ``pattern`` satisfies.

    ``True`` (no condition), a lower-case trigram, or ``("and" | "or", parts)``.
    """
    strings, query = _walk(list(_parser.parse(pattern, flags)))
    return _all([query, _strings_query(strings)])


def _all(parts):
    flat = []
    for p in parts:
        if p is not True:
            flat += p[1] if isinstance(p, tuple) and p[0] == "and" else [p]
    flat = list(dict.fromkeys(flat))
    return True if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _any(parts):
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _strings_query(strings):
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _choices(op, arg):
    """The strings that an element can be, or None when there are too many."""
    if op is C.LITERAL:
        return {_fold(chr(arg))}
    if op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= MAX_CLASS:
        return {_fold(chr(a)) for _, a in arg}
    return None


def _fold(c: str) -> str:
    return c.lower() if c.isascii() else c


def _walk(items):
    """(strings the pattern's last exact run can be, query of all before it)."""
    run, done = {""}, []

    def cut():
        nonlocal run
        done.append(_strings_query(run))
        run = {""}

    for op, arg in items:
        if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            continue
        if op is C.SUBPATTERN:
            options = [list(arg[-1])]
        elif op is C.BRANCH:
            options = [list(x) for x in arg[1]]
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, body = arg
            exact = _exact([list(body)])
            if (low, high) == (0, 1) and exact and len(run) * (len(exact) + 1) <= MAX_STRINGS:
                run = {r + e for r in run for e in exact | {""}}
                continue
            cut()
            if low:
                strings, query = _walk(list(body))
                done += [query, _strings_query(strings)]
            continue
        else:
            options = None
        exact = _choices(op, arg) if options is None else _exact(options)
        if exact is not None and len(exact) <= MAX_STRINGS:
            if len(run) * len(exact) > MAX_STRINGS:
                cut()
            run = {r + e for r in run for e in exact}
            continue
        cut()
        if options is not None:
            done.append(_any([_all([q, _strings_query(s)]) for s, q in map(_walk, options)]))
    return run, _all(done)


def _exact(options):
    """All strings that the options can be, or None."""
    found = set()
    for items in options:
        run = {""}
        for op, arg in items:
            if op is C.SUBPATTERN:
                c = _exact([list(arg[-1])])
            elif op is C.BRANCH:
                c = _exact([list(x) for x in arg[1]])
            elif op is C.MAX_REPEAT and arg[0] == 0 and arg[1] == 1:
                c = _exact([list(arg[2])])
                c = None if c is None else c | {""}
            else:
                c = _choices(op, arg)
            if c is None or len(run) * len(c) > MAX_STRINGS:
                return None
            run = {r + e for r in run for e in c}
        found |= run
    return found


def query_trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(query_trigrams, query[1]))


class TrigramIndex:
    """Postings of one slice of documents for a vocabulary of trigrams."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, vocabulary: list[str]):
        self.docs = len(offsets) - 1
        self.postings = {t: np.empty(0, np.int64) for t in vocabulary}
        if len(data) < 3 or not vocabulary:
            return
        lower = np.arange(256, dtype=np.uint32)
        lower[65:91] += 32
        codes = lower[data]
        grams = (codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]
        ids = np.zeros(1 << 24, np.uint8 if len(vocabulary) < 255 else np.uint32)
        wide = {t: list(t.encode()) for t in vocabulary}
        for n, t in enumerate(vocabulary):
            b = wide[t][:3]
            ids[(b[0] << 16) | (b[1] << 8) | b[2]] = n + 1
        found = ids[grams]
        for back in (1, 2):  # a trigram does not span two documents
            ends = offsets[1:] - back
            found[ends[(ends >= 0) & (ends < len(found))]] = 0
        at = np.flatnonzero(found)
        doc = np.searchsorted(offsets, at, "right") - 1
        pairs = np.unique((found[at].astype(np.int64) - 1) * self.docs + doc)
        cuts = np.searchsorted(pairs, np.arange(len(vocabulary) + 1) * self.docs)
        for n, t in enumerate(vocabulary):
            self.postings[t] = pairs[cuts[n]:cuts[n + 1]] - n * self.docs

    def candidates(self, query) -> np.ndarray:
        """Ordinals of the documents that satisfy the query."""
        if query is True:
            return np.arange(self.docs)
        if isinstance(query, str):
            return self.postings[query]
        parts = [self.candidates(q) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        parts.sort(key=len)
        got = parts[0]
        for p in parts[1:]:
            got = np.intersect1d(got, p, assume_unique=True)
        return got


def _ascii_only(query):
    """Trigrams of other than ASCII letters are no byte trigrams: no condition."""
    if query is True or isinstance(query, str):
        return query if query is True or query.isascii() else True
    parts = [_ascii_only(q) for q in query[1]]
    return _all(parts) if query[0] == "and" else _any(parts)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` plus ``spans`` (kind, start, end in code points, value, score).

    One row per input row, repeated rows included; null and empty texts have no
    spans. Matches are leftmost and do not overlap within a kind. Spans come by
    start, then in the order of the rules; ties of the two cannot happen within
    a kind. Long texts are scanned whole. Null ids stay null.
    """
    queries = [_ascii_only(trigram_query(
        r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0))) for r in rules]
    vocabulary = sorted(set().union(*map(query_trigrams, queries)))
    rules = tuple(rules)

    def scan(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        column = batch.column(batch.num_columns - 1)
        data, offsets = text_buffer(column)
        index = TrigramIndex(data, offsets, vocabulary)
        texts = column.to_pylist()
        found: list[list] = [[] for _ in texts]
        for n, (rule, query) in enumerate(zip(rules, queries)):
            pattern = rule.compiled()
            for d in index.candidates(query):
                text = texts[d]
                if not text:
                    continue
                for m in pattern.finditer(text):
                    a, b = m.span(rule.group)
                    if b - a >= rule.min_length:
                        found[d].append((m.start(), n, m.end(), m.group()))
        return {"spans": pa.array(
            [[{"kind": rules[n].kind, "start": s, "end": e, "value": v, "score": 1.0}
              for s, n, e, v in sorted(x)] for x in found], SPAN_ARROW)}

    return map_texts(docs, text_col, list(keep), f"spans {SPAN}", scan)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of all ``documents``, by ``find_secrets``; one row a document."""
    found = find_secrets(read(spark, sf_dir, "documents"))
    base = [r.kind for r in BASE_RULES]
    return found.select(
        "doc_id", *[span_count("spans", k).alias(f"n_{k}") for k in base],
        F.sha2(span_string("spans", base), 256).alias("base_sha256"),
        span_string("spans").alias("spans"))


def without_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
                    mark: str = "<SECRET>") -> DataFrame:
    """The documents with every found span replaced by ``mark``; all columns and
    rows stay (null texts too). Overlapping spans become one mark."""
    found = find_secrets(packed(docs, text_col), rules, "body", ("row", "body"))
    text, spans = F.col("body"), F.col("spans")
    # merge overlapping spans, then stitch the pieces between them
    merged = F.aggregate(
        spans, F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"),
                                                   s["end"].alias("end"))))))
    stitched = F.aggregate(
        merged, F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.concat(acc["done"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                     F.lit(mark)).alias("done"), s["end"].alias("at")),
        lambda acc: F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.select(F.col("row").withField(
        text_col, F.when(F.size(spans) > 0, stitched).otherwise(text)).alias("row")).select("row.*")
