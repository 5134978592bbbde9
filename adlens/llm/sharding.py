"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A partial partition is a tuple of shard sums. Differencing takes the two
partial partitions with the largest spread and adds them in opposite order, so
that large parts meet small ones, until one partition is left. Groups are dealt
over buckets by hash; every bucket is differenced in its own task, which leaves
one partial partition (a few numbers) a bucket; those are differenced in the
same way, level by level, in tasks of at most ``FANOUT`` of them. A level only
relabels the shards of the level below, so a group's shard follows by joining
the small relabelling tables. Nothing but (key, size) of a group is moved.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm.common import drop, read, save

# Groups differenced in one task (about 100 bytes each), and partial
# partitions combined in one task of the next level.
GROUPS_PER_BUCKET = 50_000
FANOUT = 256


def differencing(parts: list[tuple[int, ...]], shards: int) -> tuple[list[list[int]], list[int]]:
    """Combine partial partitions into one.

    ``parts``: each a tuple of at most ``shards`` sums (missing ones are 0).
    Returns, for each part, the final shard of each of its slots, and the final
    sums, largest first. Ties go by the part's position, so the result depends
    on the order of ``parts`` only.
    """
    # a heap entry: -spread, tie, sums (descending), and for each sum the chain
    # of the (part, slot) pairs in it, as nested pairs joined in constant time
    heap = []
    for n, sums in enumerate(parts):
        slots = sorted(((s, (n, k)) for k, s in enumerate(sums)), key=lambda x: (-x[0], x[1]))
        slots += [(0, None)] * (shards - len(slots))
        heap.append((slots[-1][0] - slots[0][0], n, slots))
    heapq.heapify(heap)
    tie = len(parts)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        joined = []
        for (x, left), (y, right) in zip(a, reversed(b)):
            chain = left if right is None else right if left is None else (left, right, None)
            joined.append((x + y, chain))
        joined.sort(key=lambda x: -x[0])
        heapq.heappush(heap, (joined[-1][0] - joined[0][0], tie, joined))
        tie += 1
    places = [[0] * len(p) for p in parts]
    final = heap[0][2] if heap else [(0, None)] * shards
    for shard, (_, chain) in enumerate(final):
        todo = [chain] if chain else []
        while todo:
            link = todo.pop()
            if len(link) == 3:
                todo += link[:2]
            else:
                places[link[0]][link[1]] = shard
    return places, [s for s, _ in final]


def _combine(df: DataFrame, bucket: str, shards: int) -> DataFrame:
    """Difference the parts of each bucket: one row for every part's slot
    (bucket, id, slot, shard, total), ``total`` being the bucket's sum of that shard."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        parts = [tuple(int(x) for x in s) for s in pdf["sums"]]
        places, sums = differencing(parts, shards)
        rows = [(key[0], i, slot, shard, sums[shard])
                for i, p in zip(pdf["id"], places) for slot, shard in enumerate(p)]
        # an unused shard has no row of its own; it counts as 0 above
        return pd.DataFrame(rows, columns=["bucket", "id", "slot", "shard", "total"])

    return df.select(F.col(bucket).alias("bucket"), F.col("id"), F.col("sums")).groupBy(
        "bucket").applyInPandas(
        run, "bucket long, id string, slot int, shard int, total long")


def shard_groups(groups: DataFrame, shards: int, key: str = "key", size: str = "size",
                 per_bucket: int = GROUPS_PER_BUCKET, fanout: int = FANOUT) -> DataFrame:
    """(key, shard) for distinct string keys with their sizes.

    Shards are numbered by descending bytes. A group larger than a shard's fair
    part gets a shard that little else joins; groups are never split. Equal
    sizes are placed by key. Empty input: no rows.
    """
    items = groups.select(F.col(key).alias("id"), F.col(size).cast("long").alias("size"))
    buckets = max(1, -(-items.count() // per_bucket))
    level = items.select("id", F.array("size").alias("sums"),
                         F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("b"))
    placed = save(_combine(level, "b", shards), "shard_level")
    where = placed.select(F.col("id").alias("key"), "bucket", "shard")
    used = [placed]
    while buckets > 1:
        parents = -(-buckets // fanout)
        # of a bucket's slots that hold anything (empty ones may go anywhere)
        sums = (placed.groupBy("bucket", "shard").agg(F.max("total").alias("total"))
                .groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("shard", "total")))
                                       .alias("at")))
        up = sums.select(
            F.col("bucket").cast("string").alias("id"),
            F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: F.coalesce(F.element_at(
                F.map_from_entries("at"), k), F.lit(0).cast("long"))).alias("sums"),
            F.floor(F.col("bucket") / F.lit(fanout)).cast("long").alias("b"))
        placed = save(_combine(up, "b", shards), "shard_level")
        used.append(placed)
        relabel = placed.select(F.col("id").cast("long").alias("bucket"),
                                F.col("slot").alias("shard"),
                                F.col("bucket").alias("parent"), F.col("shard").alias("to"))
        where = where.join(relabel, ["bucket", "shard"]).select(
            "key", F.col("parent").alias("bucket"), F.col("to").alias("shard"))
        buckets = parents
    out = save(where.select("key", "shard"), "shard_of_group")
    for t in used:
        drop(t)
    return out


def number_rows(df: DataFrame, group: str, order: list[str], out: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within each value of ``group``, without one task a group.

    Rows are dealt over parts of their group by hash of ``order``; a part's
    first number is the count of rows in the parts before it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    counts = dealt.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    # at most (groups x parts) rows
    starts = counts.select(F.col(group).alias("g"), F.col("part").alias("p"), F.coalesce(
        F.sum("n").over(before), F.lit(0)).alias("start"))
    local = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)) - 1
    numbered = dealt.withColumn("local", local)
    return numbered.join(starts, (numbered[group] == starts["g"])
                         & (numbered["part"] == starts["p"])).withColumn(
        out, (F.col("start") + F.col("local")).cast("long")).drop(
        "part", "local", "g", "p", "start")


ROW_OVERHEAD = 8


def shard_documents(docs: DataFrame, shards: int = 24, text_col: str = "text",
                    id_col: str = "doc_id") -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row.

    Rows of equal text form a group and share a shard (a null text counts as
    the empty one, of 0 bytes and checksum 0). Size is the text's bytes plus
    ``ROW_OVERHEAD``. Repeated rows each get a slot of their own; null ids keep
    their rows. Slots follow a hash order, equal rows in any order. Only the
    text's hash, never the text, is shuffled.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.sha2(body, 256).alias("key"))
    rows = save(rows, "shard_rows")
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"))
    where = shard_groups(groups, shards)
    placed = rows.join(where, "key")
    return number_rows(placed, "shard", ["doc_id", "key"]).select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", "shard", "slot")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 24 shards of near equal bytes, by ``shard_documents``."""
    got = shard_documents(read(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))
