"""Importance resampling of a corpus towards a target's distribution.

Words are hashed into buckets; a bucket's gain is the scaled log ratio of its
smoothed shares in the target and in the corpus. The gains are one array, and a
document's weight is the sum of those of its features, in one pass over the
texts. A Gumbel variate made of the id's hash is added, so the highest scores
are a draw without replacement.

The cutoff of the draw is found without sorting the corpus: a quantile sketch
gives a bracket around it, exact counts of what lies above and inside validate
the bracket or widen it, and only its rows are sorted.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import drop, in_order, map_texts, read, save, slices

BUCKETS = 10_000
WORDS = 1                # longest run of words that is a feature
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SKETCH_ACCURACY = 10_000
SCALE = 1_000
PIECE_BYTES = 1 << 20

# every byte that is no digit, letter or part of a longer character is a blank
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
               else 32 for c in range(256))
_BLANK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def feature_buckets(raw: bytes, buckets: int = BUCKETS,
                    words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """The number of words and the buckets of the features of a text, a piece at
    a time; features are the runs of 1 to ``words`` consecutive words."""
    held: list[bytes] = []
    at = 0
    while at < len(raw):
        blank = _BLANK.search(raw, at + PIECE_BYTES)
        end = blank.start() if blank else len(raw)
        new = raw[at:end].translate(_TABLE).split()
        at = end
        made = [np.fromiter(map(zlib.crc32, new), np.uint32, len(new))]
        for n in range(2, words + 1):
            run = held[max(0, len(held) - n + 1):] + new
            many = max(0, len(run) - n + 1)
            made.append(np.fromiter(map(zlib.crc32, map(b" ".join, zip(
                *[run[i:] for i in range(n)]))), np.uint32, many))
        held = (held + new)[-(words - 1):] if words > 1 else held
        yield len(new), np.concatenate(made).astype(np.int64) % buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS,
                  words: int = WORDS) -> DataFrame:
    """(bucket, n): features of all the texts; a task hands on one row a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "body"):
            for raw in part.column(0).cast(pa.binary()).to_pylist():
                for _, found in feature_buckets(raw or b"", buckets, words):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return texts.select(F.col(text_col).cast("string").alias("body")).mapInArrow(
        run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from the counts (bucket, n) of both: an array of
    ``buckets`` numbers, which is all that reaches the driver."""
    both = corpus.select("bucket", F.col("n").alias("s")).join(
        target.select("bucket", F.col("n").alias("t")), "bucket", "full_outer")
    s, t = np.zeros(buckets), np.zeros(buckets)
    for r in both.collect():
        s[r["bucket"]], t[r["bucket"]] = r["s"] or 0, r["t"] or 0
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(SCALE * math.log(x)) for x in ratio], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, words: int = WORDS, seed: int = SEED,
           text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) for every row."""
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        made = np.zeros((batch.num_rows, 3), np.int64)
        texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
        for row, raw in zip(made, texts):
            for n, found in feature_buckets(raw or b"", len(gain), words):
                row += n, len(found), gain[found].sum()
        return dict(zip(("n_words", "n_features", "weight"), map(pa.array, made.T)))

    got = map_texts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                    "text", ["doc_id"], "n_words long, n_features long, weight long", run)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return got.withColumn("score", F.col("weight") + noise)


def bracket(rows: DataFrame, draw: int, total: int, accuracy: int = SKETCH_ACCURACY) -> tuple:
    """(low, high, above): the ``draw``-th highest score of ``rows`` lies from low
    to high, and ``above`` rows are over high; checked by exact counts. A sketch
    that misses is answered by a bracket four times as wide, at last by all."""
    at, reach = 1 - draw / total, 2 / accuracy
    while True:
        ends = [max(0.0, at - reach), min(1.0, at + reach)]
        low, high = rows.agg(F.percentile_approx("score", ends, accuracy)).first()[0]
        if ends[0] == 0.0 and ends[1] == 1.0:
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        above, inside = rows.agg(F.count_if(F.col("score") > high), F.count_if(
            F.col("score").between(low, high))).first()
        if above < draw <= above + inside:
            return low, high, above
        reach *= 4


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, words: int = WORDS, buckets: int = BUCKETS,
             seed: int = SEED, accuracy: int = SKETCH_ACCURACY, text_col: str = "text",
             id_col: str = "doc_id", target_text: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank) for every row.

    ``rank`` counts the drawn rows from 1, by score, then by smaller id; the
    others have none. Null and empty texts have no features, weight 0 and are
    never drawn (unless ``least_words`` is 0). A null id draws the variate of the
    empty name and comes last among ties; rows repeated with one id are ranked
    one by one, by features, then weight, then in any order. An empty target
    leaves weights to the corpus's own frequencies; empty documents give no rows.
    Texts are read whole; other columns are not looked at.
    """
    corpus = bucket_counts(docs, text_col, buckets, words)
    gain = gains(corpus, bucket_counts(target, target_text, buckets, words), buckets)
    # the place in the written table tells equal rows apart
    rows = save(scored(docs, gain, words, seed, text_col, id_col).withColumn(
        "tie", F.monotonically_increasing_id()), "scored")
    fit = rows.where(F.col("n_words") >= least_words)
    total = fit.count()
    draw = percent * total // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if draw:
        order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"),
                 F.asc("weight"), F.asc("tie")]
        low, high, above = bracket(fit, draw, total, accuracy)
        within = in_order(fit.where(F.col("score").between(low, high)), order)
        some = within.where(F.col("place") < draw - above)
        drawn = fit.where(F.col("score") > high).unionByName(some.select(*rows.columns))
        ranked = in_order(save(drawn, "drawn"), order).select(
            *out, (F.col("place") + 1).alias("rank"))
        rest = rows.where((F.col("n_words") < least_words) | (F.col("score") < low)).select(
            *out).unionAll(within.where(F.col("place") >= draw - above).select(*out))
    else:
        ranked, rest = None, rows.select(*out)
    rest = rest.withColumn("rank", F.lit(None).cast("long"))
    got = rest if ranked is None else ranked.unionAll(rest)
    return got.withColumnRenamed("doc_id", id_col)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` weighed towards ``benchmark``, by ``resample``."""
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


# CRC-32 in SQL: its table from the polynomial, then a fold over a word's bytes.
CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [CAST(0 AS BIGINT) FOR z IN range(8)]),
             lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c
    FROM range(256) r(i)))"""


def crc_of(text: str) -> str:
    """SQL for the CRC-32 of a non-empty text; ``t`` is the table."""
    octets = (f"[CAST('0x' || substr(hex(encode({text})), CAST(2 * p + 1 AS BIGINT), 2) AS BIGINT) "
              f"FOR p IN range(octet_length(encode({text})))]")
    return (f"xor(list_reduce(list_prepend(4294967295, {octets}), "
            "lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)), 4294967295)")


OP12_SQL = f"""
WITH {CRC_TABLE.strip()},
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
m AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM benchmark),
w AS (SELECT doc_id, unnest(words) AS word FROM d),
kinds AS (SELECT word FROM w UNION SELECT word FROM m),
bucket_of AS (SELECT word, {crc_of('word')} % 10000 AS bucket FROM kinds, crc_table),
s AS (SELECT bucket, count(*) AS n FROM w JOIN bucket_of USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM m JOIN bucket_of USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(
           CAST((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM w) + 10000) AS DOUBLE)
           / CAST((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM m) + 10000) AS DOUBLE)))
         AS BIGINT) AS g
  FROM s FULL JOIN t USING (bucket)),
weights AS (
  SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight
  FROM w JOIN bucket_of USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scores AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(
           '2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296)))
         AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
         count(*) OVER () AS n
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN placed USING (doc_id)
"""
