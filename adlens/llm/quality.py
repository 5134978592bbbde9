"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is
encoded (fixed lexical statistics, then a learned layer); a gated attention
unit weighs the passages, and a logistic unit scores the weighted mean of their
codes. Trained with Adam on a bounded, documented sample of labelled documents;
scoring is one map over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import Shared, map_texts, read, text_buffer

PASSAGE_BYTES = 600
BYTE_BINS = 128          # ASCII bytes; all others share the last
PAIR_BINS = 256          # hashed pairs of neighbouring bytes
STATS = 8
WIDTH = BYTE_BINS + PAIR_BINS + STATS
HIDDEN = 24
GATE = 16
# Bounds of the training sample: documents, and passages of all of them together
# (784 bytes each). A document is learnt from whole or not at all.
TRAIN_DOCS = 4_000
TRAIN_PASSAGES = 64_000
EPOCHS = 12
BATCH = 64
HELD_OUT = 1             # remainder of crc32(id as text) mod 3 never trained on


def passages(data: np.ndarray, offsets: np.ndarray, size: int = PASSAGE_BYTES) -> tuple[
        np.ndarray, np.ndarray]:
    """Starts and documents of the passages: cuts every ``size`` bytes of each
    text (UTF-8; counts do not mind a split character). An empty text has one
    empty passage."""
    counts = np.maximum(1, -(-np.diff(offsets) // size))
    doc = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return offsets[doc] + nth * size, doc


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``WIDTH`` lexical features for each passage, and its document."""
    starts, doc = passages(data, offsets)
    n = len(starts)
    ends = np.append(starts[1:], offsets[-1])
    if not n:
        return np.zeros((0, WIDTH), np.float32), doc
    length = np.maximum(1, ends - starts).astype(np.float32)[:, None]
    of = np.repeat(np.arange(n, dtype=np.int64), ends - starts)
    bins = np.minimum(data, BYTE_BINS - 1)
    single = np.bincount(of * BYTE_BINS + bins, minlength=n * BYTE_BINS).reshape(n, BYTE_BINS)
    pair = ((data[:-1].astype(np.uint32) * 31 + data[1:]) * np.uint32(0x9E3779B1)
            >> np.uint32(24)).astype(np.int64)
    within = of[:-1] == of[1:] if len(of) else np.zeros(0, bool)
    pairs = np.bincount((of[:-1] * PAIR_BINS + pair)[within],
                        minlength=n * PAIR_BINS).reshape(n, PAIR_BINS)
    share = lambda a, b: single[:, a:b].sum(axis=1)
    letters = share(65, 91) + share(97, 123) + single[:, 127]
    spaces = single[:, 32] + single[:, 9] + single[:, 10] + single[:, 13]
    words = np.maximum(1, spaces)
    stats = np.stack([
        np.log1p(length[:, 0]) / 7, letters / length[:, 0], share(65, 91) / np.maximum(1, letters),
        share(48, 58) / length[:, 0], spaces / length[:, 0], length[:, 0] / words / 10,
        (length[:, 0] - letters - spaces - share(48, 58)) / length[:, 0],
        (pairs > 0).mean(axis=1)], axis=1)
    out = np.concatenate([np.sqrt(single / length), np.sqrt(pairs / length), stats], axis=1)
    return out.astype(np.float32), doc


@dataclass
class Model:
    """Weights; ``mean`` and ``scale`` standardise the features."""
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def encode(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.weights["W"] + self.weights["b"])

    def score(self, x: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        w = self.weights
        h = self.encode(x)
        gate = np.tanh(h @ w["V"]) / (1 + np.exp(-(h @ w["U"])))
        logit = gate @ w["a"]
        top = np.full(docs, -np.inf, logit.dtype)
        np.maximum.at(top, doc, logit)
        e = np.exp(logit - top[doc])
        total = np.bincount(doc, e, docs)
        z = np.stack([np.bincount(doc, e * h[:, j], docs) for j in range(h.shape[1])], axis=1)
        z /= np.maximum(total, 1e-12)[:, None]
        return 1 / (1 + np.exp(-(z @ w["c"] + w["d"][0])))


def train(x: np.ndarray, doc: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS,
          seed: int = 7, rate: float = 3e-3, decay: float = 1e-4) -> Model:
    """Fit by Adam on the bags' log loss. ``doc`` (ascending) gives the bag of
    each passage, ``labels`` 0 or 1 for each bag."""
    rng = np.random.default_rng(seed)
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-2) if len(x) else (
        np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32))
    xs = (x - mean) / scale
    init = lambda *s: rng.normal(0, s[0] ** -0.5, s)
    p = {"W": init(WIDTH, HIDDEN), "b": np.zeros(HIDDEN), "V": init(HIDDEN, GATE),
         "U": init(HIDDEN, GATE), "a": init(GATE), "c": init(HIDDEN), "d": np.zeros(1)}
    rate_of_one = labels.mean() if len(labels) else 0.5
    prior = min(max(float(rate_of_one), 0.01), 0.99)
    p["d"][0] = np.log(prior / (1 - prior))
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    cuts = np.searchsorted(doc, np.arange(len(labels) + 1))
    step = 0
    if not 0 < rate_of_one < 1 or not len(labels):
        p["c"][:] = 0  # nothing to tell documents apart
        epochs = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            bags = order[at:at + BATCH]
            rows = np.concatenate([np.arange(cuts[b], cuts[b + 1]) for b in bags])
            bag = np.repeat(np.arange(len(bags)), cuts[bags + 1] - cuts[bags])
            g = _gradients(p, xs[rows], bag, labels[bags])
            step += 1
            for k in p:
                g[k] = g[k] + decay * p[k] * (k in "WVU")
                m[k] += 0.1 * (g[k] - m[k])
                s[k] += 0.001 * (g[k] ** 2 - s[k])
                p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean.astype(np.float32), scale.astype(np.float32),
                 {k: v.astype(np.float32) for k, v in p.items()})


def _gradients(p: dict, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict:
    n = len(y)
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = np.exp((t * g) @ p["a"])
    alpha = e / np.bincount(bag, e, n)[bag]
    z = np.zeros((n, h.shape[1]))
    np.add.at(z, bag, alpha[:, None] * h)
    d_out = (1 / (1 + np.exp(-(z @ p["c"] + p["d"][0]))) - y) / n
    dz = d_out[:, None] * p["c"]
    # through the weighted mean: to the codes and to the attention logits
    d_alpha = (dz[bag] * h).sum(axis=1)
    d_logit = alpha * (d_alpha - np.bincount(bag, alpha * d_alpha, n)[bag])
    d_gate = d_logit[:, None] * p["a"]
    d_t, d_g = d_gate * g * (1 - t ** 2), d_gate * t * g * (1 - g)
    dh = alpha[:, None] * dz[bag] + d_t @ p["V"].T + d_g @ p["U"].T
    d_pre = dh * (1 - h ** 2)
    return {"W": x.T @ d_pre, "b": d_pre.sum(axis=0), "V": h.T @ d_t, "U": h.T @ d_g,
            "a": (t * g).T @ d_logit, "c": z.T @ d_out, "d": np.array([d_out.sum()])}


def held_out(id_col: str):
    """Rows whose crc32(id as text) mod 3 is 1; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
        label_col: str = "quality", train_docs: int = TRAIN_DOCS,
        train_passages: int = TRAIN_PASSAGES) -> Model:
    """Train on at most ``train_docs`` labelled documents that are not held out,
    of at most ``train_passages`` passages together.

    The sample is the labelled ids of smallest hash, half of them (and of the
    passages) of each label as far as there are any; whole texts, so that a
    document that would overrun the passages is passed over, and one of more than
    half of them is never learnt from. Null labels do not count; an id labelled
    more than once has its mean label, rounded up; of an id with several texts one
    is taken. Without both labels the model gives every document the same score.
    """
    by_id = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
                         & ~held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(
        F.when(F.avg(label_col) >= 0.5, 1).otherwise(0).alias("label"))
    size = F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length(
        F.col(text_col).cast("string")), F.lit(0)) / PASSAGE_BYTES)).cast("long")
    sizes = docs.groupBy(F.col(id_col).alias("id")).agg(F.max(size).alias("passages"))
    known = by_id.join(sizes, "id").where(F.col("passages") <= train_passages // 2)
    sample = []
    for v in (0, 1):
        left = train_passages // 2
        for r in known.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(
                train_docs // 2).collect():
            if r["passages"] <= left:
                left -= r["passages"]
                sample.append((r["id"], r["label"]))
    spark = docs.sparkSession
    chosen = F.broadcast(spark.createDataFrame(sample, by_id.schema))
    bags = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        chosen, "id")

    def encode(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        x, doc = features(*text_buffer(batch.column(batch.num_columns - 1)))
        cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        return {"x": pa.array([x[a:b].astype(np.float16).tobytes()
                               for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())}

    coded = map_texts(bags, "text", ["id", "label"], "x binary", encode)
    # repeated ids: one of their texts, the same each time
    got = coded.groupBy("id").agg(F.min(F.struct("x", "label")).alias("s")).orderBy("id").collect()
    xs = [np.frombuffer(r["s"]["x"], np.float16).astype(np.float32).reshape(-1, WIDTH)
          for r in got]
    doc = np.repeat(np.arange(len(xs)), [len(x) for x in xs])
    y = np.array([r["s"]["label"] for r in got], np.float64)
    x = np.concatenate(xs) if xs else np.zeros((0, WIDTH), np.float32)
    model = train(x, doc, y)
    # the sample was balanced: shift the scores back to the labels' own rates
    counts = {r["label"]: r["n"] for r in by_id.groupBy("label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) == 2 and 0 < y.mean() < 1:
        model.weights["d"] = model.weights["d"] + np.float32(
            np.log(counts[1] / counts[0]) - np.log(y.mean() / (1 - y.mean())))
    return model


def score_documents(docs: DataFrame, model: Model, text_col: str = "text",
                    keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` plus ``score`` (0 to 1, higher: label 1 likelier), one row per
    input row. Only the text is read; null and empty texts are one empty
    passage; long texts count with every passage; repeated rows score alike."""
    shared = Shared(docs.sparkSession, model)  # about 100 kB

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        x, doc = features(*text_buffer(batch.column(batch.num_columns - 1)))
        return {"score": pa.array(shared.get().score(x, doc, batch.num_rows), pa.float64())}

    return map_texts(docs, text_col, list(keep), "score double", run)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of all ``documents``, by ``fit`` and ``score_documents``."""
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
