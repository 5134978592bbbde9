"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import drop, save


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that an edge to another node names; root is
    the component's smallest node.

    Each round points the neighbours of a node at the smallest node among them.
    Rounds grow with the logarithm of the graph. Nothing is collected: minima
    are pre-aggregated, and joined from written tables, so that a node with
    very many neighbours is split. Null ends, loops and repeated edges are
    ignored; no edges give no rows.
    """
    u, v = F.col("u"), F.col("v")
    now = save(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                            F.col(a).alias("x"), F.col(b).alias("y")).where(
        "x is not null and y is not null and u <> v").select("u", "v").distinct(), "edges")
    mark = _fingerprint(now)
    while mark[0]:
        both = now.unionAll(now.select(v.alias("u"), u.alias("v")))
        least = save(both.groupBy("u").agg(F.least(F.min("v"), u).alias("m")), "star_minima")
        large = save(both.where(v > u).join(least, "u").select(
            v.alias("u"), F.col("m").alias("v")).distinct(), "large_star")
        below = save(large.groupBy("u").agg(F.min("v").alias("m")), "star_minima")
        small = large.join(below, "u").where(v > F.col("m")).select(
            v.alias("u"), F.col("m").alias("v"))
        after = save(small.unionAll(below.select("u", F.col("m").alias("v"))).distinct(), "edges")
        for t in (now, least, large, below):
            drop(t)
        now, before, mark = after, mark, _fingerprint(after)
        if mark == before:
            break
    return now.select(u.alias("node"), v.alias("root")).unionAll(
        now.select(v.alias("node"), v.alias("root")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]
