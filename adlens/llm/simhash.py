"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into k // 2 + 1 segments, fewer than the k + 1 that would
leave one equal: of two fingerprints that differ in at most k bits, one segment
differs in at most one. Each segment is indexed once for each of its bits, with
that bit deleted, so such a pair has a variant in common and meets in an equality
join; no link is lost.

Links are verified on whole fingerprints. Since a document's class is what is
asked, a variant's members are not compared pair by pair: first each with the
least one of its variant; then, in the variants that still hold several classes,
members of different classes. A variant of too many members for one task is not
compared at all: its members outside its largest class look up every fingerprint
within k bits of their own, by equality, whatever the group's size.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import drop, map_texts, read, save
from adlens.llm.components import components

BITS = 64
DISTANCE = 3
WORDS = 3
SEED = 42
PIECE_BYTES = 1 << 20    # of one text, split into words at once
GROUP = 4_096            # members of one variant compared in one task

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(raw: bytes, words: int = WORDS) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, a piece at a time.

    A-Z lowered; words are runs of bytes other than x20 and x09 to x0D. Fewer
    words than a shingle's make one of all; no words none.
    """
    import xxhash
    low = raw.lower()  # of bytes: A-Z only
    held: list[bytes] = []
    any_made, at = False, 0
    while at < len(low):
        blank = _BLANK.search(low, at + PIECE_BYTES)
        end = blank.start() if blank else len(low)
        held += low[at:end].split()
        at = end
        n = len(held) - words + 1
        if n > 0:
            any_made = True
            made = map(xxhash.xxh64_intdigest,
                       map(b" ".join, zip(*[held[i:] for i in range(words)])), repeat(SEED))
            yield np.fromiter(made, np.uint64, n)
            held = held[n:]
    if held and not any_made:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(raw: bytes, words: int = WORDS) -> int:
    """The bits set in over half the shingle hashes, signed; 0 without words."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(raw, words):
        for a in range(0, len(hashes), 1 << 14):
            octets = hashes[a:a + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = WORDS, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint long) for every row."""
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
        return {"fingerprint": pa.array([fingerprint(t or b"", words) for t in texts],
                                        pa.int64())}

    return map_texts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                     "text", ["doc_id"], "fingerprint long", run)


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def variant_masks(distance: int) -> list[int]:
    """The bits that each variant keeps: a segment without one of its bits."""
    cuts = np.linspace(0, BITS, distance // 2 + 2).astype(int).tolist()
    return [sum(1 << b for b in range(low, high) if b != gone)
            for low, high in zip(cuts, cuts[1:]) for gone in range(low, high)]


def variants(nodes: DataFrame, distance: int) -> DataFrame:
    """(sig, fingerprint): one row for each deletion variant."""
    kept = [F.xxhash64(F.lit(i), F.col("fingerprint").bitwiseAND(F.lit(signed(mask)).cast("long")))
            for i, mask in enumerate(variant_masks(distance))]
    return nodes.select(F.explode(F.array(*kept)).alias("sig"), "fingerprint")


def near(a: str, b: str, distance: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _crossing(members: DataFrame, distance: int) -> DataFrame:
    """(x, y): roots linked by members (sig, fingerprint, root) of one variant.

    A task holds one variant at a time and gives a pair of roots once for each
    lot of variants that it reads, not once for each pair of members.
    """
    def links(table: pa.Table) -> pa.RecordBatch:
        sig, root = table["sig"].to_numpy(), table["root"].to_numpy()
        prints = table["fingerprint"].to_numpy().view(np.uint64)
        found, live, step = [np.zeros((2, 0), np.int64)], np.arange(len(sig)), 1
        while len(live):  # rows of one variant, ``step`` apart
            live = live[live + step < len(sig)]
            live = live[sig[live] == sig[live + step]]
            a, b = live, live + step
            good = (root[a] != root[b]) & (np.bitwise_count(prints[a] ^ prints[b]) <= distance)
            if good.any():
                x, y = root[a[good]], root[b[good]]
                found.append(np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1))
            step += 1
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()),
                                           pa.array(pairs[1], pa.int64())], ["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last, unfinished variant
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            sig = table["sig"].to_numpy()
            cut = int(np.searchsorted(sig, sig[-1]))
            if cut:
                yield links(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield links(pa.Table.from_batches(held))

    return members.select("sig", "fingerprint", "root").repartition("sig").sortWithinPartitions(
        "sig").mapInArrow(run, "x long, y long").distinct()


def neighbours(prints: DataFrame, distance: int) -> DataFrame:
    """(fingerprint, other): every value within ``distance`` bits of each."""
    flips = [sum(1 << b for b in bits) for n in range(1, distance + 1)
             for bits in itertools.combinations(range(BITS), n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.array(flips, np.uint64)
        for batch in batches:
            for own in batch.column(0).to_numpy().view(np.uint64):
                other = (masks ^ own).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(other), own).view(np.int64)), pa.array(other)],
                    ["fingerprint", "other"])

    return prints.select("fingerprint").mapInArrow(run, "fingerprint long, other long")


def fingerprint_classes(prints: DataFrame, distance: int = DISTANCE,
                        group: int = GROUP) -> DataFrame:
    """(fingerprint, root) for distinct fingerprints: the least one reachable."""
    # by fingerprint, in as many parts as there are tasks: each row becomes ``BITS``
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members_of = variants(prints.repartition(parts, "fingerprint"), distance)
    several = save(members_of.groupBy("sig").agg(
        F.min("fingerprint").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "variants")
    # the same join at every size; its small side's keys are distinct and well spread
    members = save(members_of.join(several.hint("shuffle_hash"), "sig"), "members")
    first = components(members.where(
        (F.col("fingerprint") != F.col("least")) & near("fingerprint", "least", distance)).select(
        "fingerprint", "least").distinct(), "fingerprint", "least")
    roots = save(prints.select("fingerprint").join(
        first.select(F.col("node").alias("fingerprint"), "root"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")), "roots")
    rooted = members.select("sig", "fingerprint", "n").join(roots, "fingerprint")
    mixed = rooted.groupBy("sig").agg(F.min("root").alias("p"), F.max("root").alias("q")).where(
        "p <> q").select("sig")
    unsettled = save(rooted.join(mixed, "sig"), "unsettled")
    crossing = _crossing(unsettled.where(F.col("n") <= group), distance)
    # of larger variants, all but the members of the largest class
    large = unsettled.where(F.col("n") > group)
    largest = large.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("size")).groupBy(
        "sig").agg(F.max_by("root", F.struct("size", "root")).alias("main"))
    alone = large.join(largest, "sig").where("root <> main").select("fingerprint", "root").distinct()
    other = roots.select(F.col("fingerprint").alias("other"), F.col("root").alias("y"))
    around = neighbours(alone, distance).join(other, "other").join(
        alone.select("fingerprint", F.col("root").alias("x")), "fingerprint").where(
        "x <> y").select("x", "y").distinct()
    top = components(crossing.unionAll(around), "x", "y")
    out = save(roots.join(top.select(F.col("node").alias("root"), F.col("root").alias("top")),
                          "root", "left").select(
        "fingerprint", F.coalesce("top", "root").alias("root")), "classes")
    for t in (several, members, roots, unsettled):
        drop(t)
    return out


def link_documents(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS,
                   text_col: str = "text", id_col: str = "doc_id",
                   group: int = GROUP) -> DataFrame:
    """(id, fingerprint, component_id) for every row.

    ``fingerprint``: 16 lowercase hex digits; null, empty and blank texts have
    all zeros, which link like any others. Texts are read whole, however long.
    ``component_id``: the smallest id reachable by links of at most ``distance``
    bits, the row's own included. A null id is no component's name: it takes the
    smallest id of the others, or stays null without any. Repeated rows link with
    each other. An empty table gives none; other columns are not looked at.
    """
    rows = save(fingerprints(docs, words, text_col, id_col), "fingerprints")
    nodes = save(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "prints")
    classes = fingerprint_classes(nodes, distance, group)
    with_id = nodes.join(classes, "fingerprint")
    names = with_id.groupBy("root").agg(F.min("least_id").alias("name"))
    named = save(with_id.join(names, "root").select("fingerprint", "name"), "named")
    for t in (nodes, classes):
        drop(t)
    return rows.join(named, "fingerprint").select(
        F.col("doc_id").alias(id_col),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("name").alias("component_id"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents``, by ``link_documents``."""
    return link_documents(read(spark, sf_dir, "documents"))
