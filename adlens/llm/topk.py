"""Exact top-k inner-product search by MaxScore over dimension postings.

A vector of integers is a bag of signed terms: dimension d with a positive or a
negative weight. The posting list of a term holds the vectors with that sign in
d, and its bound is the largest weight in the shard. A query's term matches
with its own sign and adds to the score; a vector with the other sign only
loses. So the sum of the bounds of a set of terms limits what a vector can gain
from them. Terms are ordered by bound; as many of the smallest as together stay
below the k-th best score so far are non-essential. The postings of the others
are traversed; a vector in none of them cannot compete. The candidates are then
probed in the remaining dimensions, block by block, while their score plus the
bounds still open reaches the threshold. Vectors are cut into shards and queries
into blocks; each pair of the two is one task's group, and the shards' best are
merged with a window over k rows a shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm.common import read, save

SHARD_VECTORS = 4_096
QUERY_BLOCK = 1_024
SEED_ROWS = 256
PROBE_BLOCK = 8
LAST_ID = (1 << 63) - 1   # stands for a null id while ids are compared


class Shard:
    """Postings of one shard: for each dimension the rows with a positive and
    with a negative weight, and the largest weight of each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, numbers: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.numbers = ids[order], vectors[order], numbers[order]
        self.columns = np.ascontiguousarray(self.vectors.T)
        empty = not len(ids)
        self.above = np.zeros(vectors.shape[1], np.int64) if empty else np.maximum(
            self.vectors.max(axis=0), 0)
        self.below = np.zeros(vectors.shape[1], np.int64) if empty else np.maximum(
            -self.vectors.min(axis=0), 0)
        self.postings = {}

    def posting(self, d: int, positive: bool) -> np.ndarray:
        key = (d, positive)
        if key not in self.postings:
            column = self.columns[d]
            self.postings[key] = column > 0 if positive else column < 0
        return self.postings[key]

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best, by score, then by smaller id, of all
        rows but the one numbered ``own``."""
        bounds = np.where(query > 0, query * self.above, -query * self.below)
        order = np.argsort(bounds, kind="stable")
        order = order[query[order] != 0]
        others = self.numbers != own
        # a first threshold: whole scores of a few spread rows
        step = max(1, len(self.ids) // SEED_ROWS)
        seen = np.flatnonzero(others[::step]) * step
        scores = self.vectors[seen] @ query
        threshold = np.sort(scores)[-k] if len(scores) >= k else None
        if threshold is None:
            rows = np.flatnonzero(others)
            got = self.vectors[rows] @ query
        else:
            reach = np.cumsum(bounds[order])
            # ties on the threshold may still win by id, so they stay in
            split = int(np.searchsorted(reach, threshold, "left"))
            idle, essential = order[:split], order[split:]
            live = np.zeros(len(self.ids), bool)
            for d in essential:
                live |= self.posting(d, query[d] > 0)
            if not len(essential) or threshold <= 0:
                live[:] = True
            rows = np.flatnonzero(live & others)
            got = np.zeros(len(rows), np.int64)
            todo = np.concatenate([essential[::-1], idle[::-1]])
            still = np.concatenate([np.cumsum(bounds[todo][::-1])[::-1], [0]])
            for at in range(0, len(todo), PROBE_BLOCK):
                dims = todo[at:at + PROBE_BLOCK]
                got += query[dims] @ self.columns[dims][:, rows]
                after = still[min(at + PROBE_BLOCK, len(todo))]
                keep = got + after >= threshold
                if not keep.all():
                    rows, got = rows[keep], got[keep]
        best = np.lexsort((self.ids[rows], -got))[:k]
        return rows[best], got[best]


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, v): every row whose vector has only finite components, each as
    floor(scale * x). Rows with a null vector, or with a null or non-finite
    component, are left out; a null id keeps its row."""
    x = F.col("x")
    inner = df.select(F.col(id_col).cast("long").alias("id"),
                      F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c)
                      & (F.abs(c) != F.lit(float("inf"))))
    return inner.where(x.isNotNull() & finite).select(
        "id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for n, v in enumerate(vectors):
        out[n, :len(v)] = v
    return out


def top_k(rows: DataFrame, asked: Column, k: int = 5, shard_vectors: int = SHARD_VECTORS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k highest inner products of each row that ``asked`` holds for with the
    other rows.

    ``rows``: (id long, v array<long>). Result: query_id, rank from 1, vec_id,
    score; equal scores go to the smaller id, a null id last. Only the query's own
    row is left out: rows repeated with one id each count, and each asks on its
    own. Fewer rows than k give all of them; no rows or no queries give none. A
    shorter vector counts as padded with zeros. Scores are exact within the range
    of a long.
    """
    rows = save(rows.select("id", "v").withColumn("number", F.monotonically_increasing_id()),
                "vectors")
    queries = rows.where(asked)
    shards = max(1, -(-rows.count() // shard_vectors))
    blocks = max(1, -(-queries.count() // query_block))
    # by row: the copies of a hot vector, or of a hot id, are dealt evenly
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("number", F.lit(1)), F.lit(shards)))
    turned = queries.withColumn("block", F.pmod(F.xxhash64("number", F.lit(2)), F.lit(blocks)))
    every_block = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    every_shard = F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))
    last = F.coalesce("id", F.lit(LAST_ID).cast("long")).alias("id")
    left = dealt.select("number", "shard", "v", last, F.explode(every_block).alias("block"))
    right = turned.select("number", "block", "v", F.explode(every_shard).alias("shard"))

    def run(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(mine) and len(theirs):
            width = max(mine["v"].map(len).max(), theirs["v"].map(len).max())
            shard = Shard(mine["id"].to_numpy(), matrix(mine["v"], width),
                          mine["number"].to_numpy())
            for own, query in zip(theirs["number"].to_numpy(), matrix(theirs["v"], width)):
                at, scores = shard.search(own, query, k)
                found += [(own, shard.ids[a], s) for a, s in zip(at, scores)]
        return pd.DataFrame(found, columns=["query", "vec_id", "score"])

    part = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInPandas(
        run, "query long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(queries.select(F.col("number").alias("query"), F.col("id").alias("query_id")),
                       "query").select(
        "query_id", "rank", F.when(F.col("vec_id") != LAST_ID, F.col("vec_id")).alias("vec_id"),
        "score")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th vector of ``embeddings`` against all, by ``top_k``."""
    rows = quantised(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(rows, F.col("id") % 50 == 0)


OP8_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS number, CAST(vec_id AS BIGINT) AS id,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.number AS query, q.id AS query_id, c.id AS vec_id,
         CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id % 50 = 0 AND c.number <> q.number),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST)
                        AS INTEGER) AS rank, vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
