"""Importance resampling against a plain computation, and its edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adlens.llm import resampling
from adlens.llm.common import in_order

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_features(text, words):
    found = plain_words(text)
    return [zlib.crc32(" ".join(found[i:i + n]).encode()) % 10_000
            for n in range(1, words + 1) for i in range(len(found) - n + 1)]


def plain(docs, target, words=1, percent=10, least=20):
    """{id: (n_features, weight, score, rank)}"""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_features(text, words))
    for text in target:
        t.update(plain_features(text, words))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
            for b in range(10_000)]
    out, fit = {}, []
    for i, text in docs:
        found = plain_features(text, words)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = (len(found), weight, score)
        if len(plain_words(text)) >= least:
            fit.append((-score, i))
    rank = {i: n + 1 for n, (_, i) in enumerate(sorted(fit)[:percent * len(fit) // 100])}
    return {i: (*x, rank.get(i)) for i, x in out.items()}


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Alpha", "beta", "é", "x9", "gamma-ray", "日本 語", "d\x7fe"])
    return [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("words", [1, 2, 3])
def test_against_plain(spark, words, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE_BYTES", 40)
    docs, target = list(enumerate(texts(words, 150))), texts(9, 6)
    docs += [(1000, None), (1001, "")]
    got = resampling.resample(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame([(t,) for t in [*target, None]], "text string"), words=words)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == plain(docs, target, words)


@pytest.mark.parametrize("accuracy", [1, 3, 10_000])
@pytest.mark.parametrize("percent", [0, 1, 50, 100])
def test_any_sketch_gives_the_same_draw(spark, accuracy, percent):
    docs, target = list(enumerate(texts(4, 200))), texts(8, 3)
    got = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame([(t,) for t in target], "text string"),
                              percent=percent, accuracy=accuracy).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == plain(docs, target, percent=percent)


def test_bracket_is_validated(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, 5).otherwise(
        F.col("id")).cast("long").alias("score"))
    scores = sorted((5 if i < 700 else i for i in range(1000)), reverse=True)
    for draw in (1, 299, 300, 301, 999, 1000):
        for accuracy in (1, 2, 50, 10_000):
            low, high, above = resampling.bracket(rows, draw, 1000, accuracy)
            assert low <= scores[draw - 1] <= high
            assert above == sum(s > high for s in scores) < draw


def test_order_in_groups(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.7 else f"g{rng.randint(0, 5)}", rng.randint(0, 40), n)
            for n in range(600)]
    df = spark.createDataFrame(data, "g string, x long, tie long")
    got = in_order(df, [F.desc("x"), F.asc("tie")], "g").collect()
    want = {}
    for g, x, tie in sorted(data, key=lambda r: (r[0], -r[1], r[2])):
        want.setdefault(g, []).append(tie)
    assert {(r.g, r.place): r.tie for r in got} == {
        (g, i): tie for g, ties in want.items() for i, tie in enumerate(ties)}


def test_edges(spark):
    long = " ".join(f"word{n % 977}" for n in range(200_000))
    body = " ".join(["some words here"] * 10)
    rows = [(1, body), (1, body), (None, body), (2, None), (3, ""), (4, " \t"), (5, long),
            (6, body), (None, None)]
    schema = "doc_id long, text string, score string, place int, part int, tie int"
    df = spark.createDataFrame([(i, t, "s", 1, 1, 1) for i, t in rows], schema)
    target = spark.createDataFrame([("some words",), (None,)], "text string")
    got = resampling.resample(df, target, percent=100).collect()
    assert len(got) == len(rows)
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5]
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in drawn] == sorted(
        (-r.score, r.doc_id is None, r.doc_id or 0) for r in drawn)
    assert all(r.weight == 0 and r.n_features == 0 for r in got if r.doc_id in (2, 3, 4))
    assert resampling.resample(df.limit(0), target).count() == 0
    assert resampling.resample(df, target.limit(0)).count() == len(rows)
    assert resampling.resample(df.limit(0), target).columns == [
        "doc_id", "n_features", "weight", "score", "rank"]
