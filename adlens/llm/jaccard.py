"""N-gram Jaccard join by PartEnum signatures.

Two shingle sets within a size band that are similar enough differ in at most k
shingles. The shingle domain is cut into first-level partitions, enough that
one of them holds at most one difference; each is cut again into second-level
partitions, and a signature is made of every subset that leaves one of those
out. The subset that leaves the difference out is equal in both sets, so they
share a signature: no link is lost. A signature stands for its band, partition
and subset, and for the shingles of the set that fall in there.

Partitions may be empty in both sets. Spare partitions make up for them: a set
with no more of them than spare ones shares a signature of some shingles; only
sets with more (very few) also emit their empty subsets.

Links are verified on whole sets. Since a document's class is what is asked, not
every pair of copies is compared: first each document with the one set it
shares most signatures with; then, in each signature that still holds several
classes, the pairs of a spanning forest, nearest first; last, all pairs of one
signature and different classes that remain. Before a pair is verified an exact
bound is applied: two sets differ by at least the difference of their counts in
hash buckets. Only pairs that cannot be links, or that connect what is
connected already, are never verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm.common import (SLICE_BYTES, drop, map_texts, packed, read, save, slices,
                               text_buffer)
from adlens.llm.components import components

WORDS = 4
SIMILARITY = 85          # percent
SECOND_LEVEL = 2
BUCKETS = 512            # of the counts that bound a pair's difference
COUNT_MAX = 255          # counts are cut off here, which keeps the bound valid
GROUP_BLOCK = 4_096      # members of one signature compared in one task
PAIRS_HELD = 1 << 18     # pairs that a comparison holds at once

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


class _Powers:
    """The multiplier's powers and those of its inverse, kept while a task runs."""

    def __init__(self):
        self.rows = (np.zeros(0, np.uint64),) * 2

    def __reduce__(self):
        return _Powers, ()  # the rows do not travel

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.rows[0]) <= n:
            made = []
            for base in (_MULTIPLIER, _INVERSE):
                row = np.full(max(n, SLICE_BYTES) + 1, np.uint64(base))
                row[0] = 1
                with np.errstate(over="ignore"):
                    made.append(np.multiply.accumulate(row))
            self.rows = tuple(made)
        return self.rows


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[
        np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the n + 1 offsets.

    Words are runs of bytes other than blanks (x20, x09 to x0D), A-Z lowered.
    A text of fewer words has one shingle of all of them; of none, none.
    """
    docs = len(offsets) - 1
    none = np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    if not len(data):
        return none
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    letter = ~((low == 32) | ((low >= 9) & (low <= 13)))
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    starts = offsets[:-1][(np.diff(offsets) > 0)]
    first[starts] = letter[starts]
    last[starts[1:] - 1] = letter[starts[1:] - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(begin):
        return none
    # hash of each word: the polynomial of its bytes, from running sums
    powers, inverse = _POWERS.upto(len(low))
    with np.errstate(over="ignore"):
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
        sums = np.concatenate([np.zeros(1, np.uint64),
                               np.cumsum(values[low] * powers[:len(low)], dtype=np.uint64)])
        word = mix((sums[end] - sums[begin]) * inverse[begin]
                   + (end - begin).astype(np.uint64))
        doc = np.searchsorted(offsets, begin, "right") - 1
        counts = np.bincount(doc, minlength=docs)
        # whole shingles, in documents with enough words
        at = np.arange(len(word))
        after = np.cumsum(counts)[doc]
        full = at + words <= after
        seed = [np.uint64(2 * i + 1) * np.uint64(0xD6E8FEB86659FD93) for i in range(words)]
        padded = np.concatenate([word, np.zeros(words, np.uint64)])
        total = np.zeros(len(word), np.uint64)
        for i in range(words):
            total += mix(padded[i:i + len(word)] + seed[i])
        # short documents: their words, whatever stands behind them
        short = (at == np.cumsum(counts)[doc] - counts[doc]) & (counts[doc] < words)
        for n in np.flatnonzero(short):
            total[n] = np.uint64(counts[doc[n]])
            for i in range(counts[doc[n]]):
                total[n] += mix(word[n + i:n + i + 1] + seed[i])[0]
        use = full | short
        shingle, doc = mix(total[use]), doc[use]
    ends = np.cumsum(np.bincount(doc, minlength=docs)).tolist()
    for a, b in zip([0, *ends[:-1]], ends):
        shingle[a:b].sort()
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])
    return shingle[new], np.concatenate([
        np.zeros(1, np.int64), np.cumsum(np.bincount(doc[new], minlength=docs))])


def set_keys(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit key of each whole set (0 of an empty one)."""
    with np.errstate(over="ignore"):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
            mix(sets ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)])
        size = np.diff(offsets)
        keys = mix(running[offsets[1:]] - running[offsets[:-1]] + size.astype(np.uint64))
    return np.where(size > 0, keys, np.uint64(0)).view(np.int64)


class Bands:
    """Size bands for a similarity: every pair that may link lies in one.

    Band j holds the sizes from ``low[j]`` to ``high[j]``; its pairs are those
    whose smaller set is under ``low[j + 1]``, so a size is in one or two bands.
    """

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        ratio = (100 / percent) ** 2
        self.low = [1]
        while self.low[-1] <= largest:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * ratio)))
        self.high = [(b - 1) * 100 // percent for b in self.low[1:]]

    def shape(self, j: int) -> tuple[int, int]:
        """(first-level partitions, spare ones) of band j."""
        k = most_differences(self.low[j + 1] - 1 + self.high[j], self.percent)
        if not k:
            return 1, 0
        needed = k // 2 + 1
        per_subset = self.low[j] / needed * (SECOND_LEVEL - 1) / SECOND_LEVEL
        empty = needed * SECOND_LEVEL * float(np.exp(-per_subset))
        spare = int(np.ceil(empty + 4 * np.sqrt(empty)))
        return needed + spare, spare


def most_differences(sizes, percent: int = SIMILARITY):
    """Most shingles that two linked sets, of so many together, can differ in."""
    return (100 - percent) * sizes // (100 + percent)


def signatures(sets: np.ndarray, offsets: np.ndarray, percent: int = SIMILARITY) -> tuple[
        np.ndarray, np.ndarray]:
    """PartEnum signatures of each set, and the set of each signature."""
    size = np.diff(offsets)
    if not len(sets):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bands = Bands(percent, int(size.max()))
    out, owner = [], []
    with np.errstate(over="ignore"):
        value = mix(sets ^ np.uint64(0xE7037ED1A0B428DB))
        for j, (low, high) in enumerate(zip(bands.low, bands.high)):
            who = np.flatnonzero((size >= low) & (size <= high))
            if not len(who):
                continue
            parts, spare = bands.shape(j)
            n = size[who]
            local = np.repeat(np.arange(len(who)), n)
            at = np.repeat(offsets[who] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            where = mix(sets[at] + np.uint64(j + 1) * np.uint64(_MULTIPLIER))
            tag = mix(np.arange(parts * SECOND_LEVEL, dtype=np.uint64)
                      + (np.uint64(j + 1) << np.uint64(40)))
            if parts == 1:  # no difference allowed: the whole set is the signature
                sums = np.zeros(len(who), np.uint64)
                np.add.at(sums, local, value[at])
                out.append(mix(sums + tag[0]))
                owner.append(who)
                continue
            first = (where >> np.uint64(33)) % np.uint64(parts)
            second = where % np.uint64(SECOND_LEVEL)
            cell = ((local * parts + first.astype(np.int64)) * SECOND_LEVEL
                    + second.astype(np.int64))
            cells = len(who) * parts * SECOND_LEVEL
            sums = np.zeros(cells, np.uint64)
            np.add.at(sums, cell, value[at])
            shape = (len(who), parts, SECOND_LEVEL)
            sums = sums.reshape(shape)
            count = np.bincount(cell, minlength=cells).reshape(shape)
            # leaving each second-level partition out in turn
            sums = sums.sum(axis=2, keepdims=True, dtype=np.uint64) - sums
            count = count.sum(axis=2, keepdims=True) - count
            odd = (count == 0).any(axis=2).sum(axis=1) > spare
            use = (count > 0) | odd[:, None, None]
            made = mix(sums + count.astype(np.uint64) * np.uint64(_MULTIPLIER)
                       + tag.reshape(1, parts, SECOND_LEVEL))
            out.append(made[use])
            owner.append(np.repeat(who, use.sum(axis=(1, 2))))
    return np.concatenate(out).view(np.int64), np.concatenate(owner)


def bucket_counts(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many shingles of each set fall in each of the ``BUCKETS``."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    cell = doc * BUCKETS + (sets >> np.uint64(33)).astype(np.int64) % BUCKETS
    counts = np.bincount(cell, minlength=(len(offsets) - 1) * BUCKETS)
    return np.minimum(counts, COUNT_MAX).astype(np.uint8).reshape(-1, BUCKETS)


def wide_counts(sets: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Counts of each set in as many buckets as it has shingles, up to the next
    power of two: a sharper bound, kept for pairs that pass the first."""
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        width = 1 << max(6, (b - a - 1).bit_length())
        counts = np.bincount((sets[a:b] >> np.uint64(20)).astype(np.int64) & (width - 1),
                             minlength=width)
        out.append(counts.astype(np.uint16).tobytes() if counts.max(initial=0) > COUNT_MAX
                   else counts.astype(np.uint8).tobytes())
    return out


def wide_difference(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """The same lower bound from two wide counts; the wider one is folded."""
    rows = []
    for raw, n in ((a, n_a), (b, n_b)):
        width = 1 << max(6, (n - 1).bit_length())
        rows.append(np.frombuffer(raw, np.uint8 if len(raw) == width else np.uint16)
                    .astype(np.int64))
    width = min(map(len, rows))
    p, q = (r.reshape(-1, width).sum(axis=0) for r in rows)
    return int(np.abs(p - q).sum())


def differences(counts: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A lower bound of how many shingles the sets of each pair differ in."""
    out = np.zeros(len(left), np.int64)
    for at in range(0, len(left), 16_384):
        p, q = counts[left[at:at + 16_384]], counts[right[at:at + 16_384]]
        out[at:at + 16_384] = (np.maximum(p, q) - np.minimum(p, q)).sum(axis=1, dtype=np.int64)
    return out


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _sized(docs: DataFrame, keep: list[str], text_col: str, words: int) -> DataFrame:
    """``keep``, n_shingles, node (the set's key; null of an empty set), buckets."""
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sets, offsets = shingle_sets(*text_buffer(batch.column(batch.num_columns - 1)), words)
        size = np.diff(offsets)
        buckets = bucket_counts(sets, offsets)
        return {"n_shingles": pa.array(size, pa.int64()),
                "node": pa.array(set_keys(sets, offsets), pa.int64(), mask=size == 0),
                "buckets": pa.array([b.tobytes() for b in buckets], pa.binary()),
                "wide": pa.array(wide_counts(sets, offsets), pa.binary())}

    return map_texts(docs, text_col, keep,
                     "n_shingles long, node long, buckets binary, wide binary", run)


def _per_set(docs: DataFrame, text_col: str, words: int, schema: str, fn) -> DataFrame:
    """Rows made of each set by ``fn(keys, sets, offsets)``; copies that a task
    meets again are left out there, before any shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "body"):
            sets, offsets = shingle_sets(*text_buffer(part.column(0)), words)
            keys = set_keys(sets, offsets)
            fresh = np.zeros(len(keys), bool)
            for n, key in enumerate(keys.tolist()):
                if offsets[n] < offsets[n + 1] and key not in seen:
                    seen.add(key)
                    fresh[n] = True
            size = np.where(fresh, np.diff(offsets), 0)
            sets = sets[np.repeat(fresh, np.diff(offsets))]
            yield from fn(keys[fresh], sets, np.concatenate(
                [np.zeros(1, np.int64), np.cumsum(size[fresh])]))

    return docs.select(F.col(text_col).cast("string").alias("body")).mapInArrow(run, schema)


def _signature_rows(docs: DataFrame, text_col: str, words: int, percent: int) -> DataFrame:
    def fn(keys, sets, offsets):
        made, owner = signatures(sets, offsets, percent)
        yield pa.RecordBatch.from_arrays(
            [pa.array(made, pa.int64()), pa.array(keys[owner], pa.int64())], ["sig", "node"])

    return _per_set(docs, text_col, words, "sig long, node long", fn)


def _set_rows(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    def fn(keys, sets, offsets):
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), _lists(sets.view(np.int64), offsets, pa.int64())],
            ["node", "members"])

    return _per_set(docs, text_col, words, "node long, members array<long>", fn)


def _may_link(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and wide bucket counts allow a link."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"),
                                  F.col("wide").alias(f"of_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("of_a", "of_b", "n_a", "n_b")]
            good = pa.array([wide_difference(p, q, m, n) <= most_differences(m + n, percent)
                             for p, q, m, n in zip(*columns)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    return pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select(
        "a", "b", "n_a", "n_b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _count_rows(column: pa.Array) -> np.ndarray:
    return text_buffer(column)[0].reshape(-1, BUCKETS)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    of = lambda x: sets.select(F.col("node").alias(x), F.col("members").alias(f"set_{x}"))
    both = pairs.select("a", "b").join(of("b"), "b").join(of("a"), "a")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return both.where(100 * shared >= percent * union).select("a", "b")


def near_pairs(key, root, n, side, counts, percent: int,
               held: int = PAIRS_HELD) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows (left, right) of one key, next to one another, with different roots
    that may link, and the lower bound of their difference. Rows of one ``side``
    are not paired unless it is 0. Given in parts of about ``held`` pairs."""
    found: list[tuple[np.ndarray, ...]] = []
    size = 0
    live = np.arange(len(key))
    step = 1
    while len(live):
        live = live[live + step < len(key)]
        live = live[key[live] == key[live + step]]
        b = live + step
        a = live[(root[live] != root[b]) & ((side[live] == 0) | (side[live] != side[b]))]
        least = differences(counts, a, a + step)
        good = least <= most_differences(n[a] + n[a + step], percent)
        found.append((a[good], a[good] + step, least[good]))
        size += int(good.sum())
        step += 1
        if size >= held:
            yield tuple(map(np.concatenate, zip(*found)))
            found, size = [], 0
    if size:
        yield tuple(map(np.concatenate, zip(*found)))


def spanning_pairs(key, root, left, right, apart) -> np.ndarray:
    """Which of the pairs make a spanning forest of the roots of each key, nearest
    pairs first: each class takes its nearest pair to another, until none is left."""
    label = np.unique(np.stack([key, root]), axis=1, return_inverse=True)[1].ravel()
    parent = np.arange(int(label.max(initial=-1)) + 1)
    chosen = []
    order = np.lexsort((right, left, apart))
    left, right = left[order], right[order]
    while True:
        a, b = parent[label[left]], parent[label[right]]
        live = np.flatnonzero(a != b)
        if not len(live):
            return order[np.unique(np.concatenate([*chosen, np.zeros(0, np.int64)]))]
        first = np.full(len(parent), len(order))
        np.minimum.at(first, a[live], live)
        np.minimum.at(first, b[live], live)
        pick = np.unique(first[first < len(order)])
        chosen.append(pick)
        for x, y in zip(a[pick].tolist(), b[pick].tolist()):
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        while (parent[parent] != parent).any():
            parent = parent[parent]


def _open_pairs(members: DataFrame, percent: int, block: int, spanning: bool) -> DataFrame:
    """Pairs of members (sig, g, node, root, n, buckets), g of them with one
    signature, that have different roots and may link; all, or a spanning forest of each signature.

    Large signatures are cut into blocks, and each pair of blocks is compared
    on its own: members of different blocks, or those within one. Pairs leave a
    task in bounded parts; a forest takes in such a part at a time, which gives the
    forest of all of them. A pair found in several signatures is combined before
    the shuffle.
    """
    cut = members.withColumn("blocks", F.ceil(F.col("g") / block)).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    keyed = cut.select(F.xxhash64("sig", F.least("own", "other"),
                                  F.greatest("own", "other")).alias("key"),
                       "node", "root", "n", "buckets",
                       F.signum(F.col("own") - F.col("other")).cast("long").alias("side"))
    sorted_rows = keyed.repartition("key").sortWithinPartitions("key", "node")

    def compare(batch: pa.Table) -> Iterator[pa.RecordBatch]:
        key, node, root, n, side = (batch[c].to_numpy()
                                    for c in ("key", "node", "root", "n", "side"))
        counts = _count_rows(batch["buckets"].combine_chunks())
        forest: tuple[np.ndarray, ...] = ()
        for part in near_pairs(key, root, n, side, counts, percent):
            if not spanning:
                yield named(node, *part[:2])
                continue
            pairs = tuple(map(np.concatenate, zip(forest, part))) if forest else part
            use = spanning_pairs(key, root, *pairs)
            forest = tuple(x[use] for x in pairs)
        if forest:
            yield named(node, *forest[:2])

    def named(node, left, right) -> pa.RecordBatch:
        a, b = node[left], node[right]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()),
                                           pa.array(pairs[1], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last, unfinished key
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            key = table["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from compare(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield from compare(pa.Table.from_batches(held))

    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


class _Classes:
    """The verified links so far, and what they connect."""

    def __init__(self, docs: DataFrame, text_col: str, words: int, percent: int):
        self.docs, self.text_col, self.words, self.percent = docs, text_col, words, percent
        self.sets = self.links = self.roots = self.tried = None

    def verify(self, pairs: DataFrame) -> None:
        """Add the links among new pairs (a, b) and connect them."""
        if self.roots is not None and pairs.isEmpty():
            return
        named = pairs.select(F.col("a").alias("node")).unionAll(
            pairs.select(F.col("b").alias("node"))).distinct()
        if self.sets is not None:
            named = save(named.join(self.sets, "node", "left_anti"), "named")
        if self.sets is None or not named.isEmpty():
            more = save(_set_rows(self.docs, self.text_col, self.words).join(named, "node")
                        .dropDuplicates(["node"]), "shingle_sets")
            self.sets = more if self.sets is None else self.sets.unionAll(more)
        new = save(_linked(pairs, self.sets, self.percent), "links")
        self.links = new if self.links is None else self.links.unionAll(new)
        self.tried = pairs if self.tried is None else self.tried.unionAll(pairs)
        if self.roots is None:
            self.roots = save(components(new), "roots")
        else:  # connect what was connected before
            ends = self.rooted(self.rooted(new, "a", "x"), "b", "y")
            above = components(ends.select("x", "y"), "x", "y").select(
                F.col("node").alias("root"), F.col("root").alias("top"))
            known = self.roots.unionAll(
                new.select(F.col("a").alias("node"), F.col("a").alias("root"))).unionAll(
                new.select(F.col("b").alias("node"), F.col("b").alias("root"))).groupBy(
                "node").agg(F.min("root").alias("root"))
            self.roots = save(known.join(above, "root", "left").select(
                "node", F.coalesce("top", "root").alias("root")), "roots")

    def rooted(self, df: DataFrame, node: str, out: str) -> DataFrame:
        """``df`` with the root of its column ``node``."""
        of = self.roots.select(F.col("node").alias(node), F.col("root").alias("found"))
        return df.join(of, node, "left").withColumn(out, F.coalesce("found", node)).drop("found")


def link_documents(docs: DataFrame, percent: int = SIMILARITY, words: int = WORDS,
                   text_col: str = "text", id_col: str = "doc_id",
                   block: int = GROUP_BLOCK) -> DataFrame:
    """(id, n_shingles, component_id) for every row.

    ``component_id``: the smallest id reachable by links, the row's own
    included; documents of equal sets are linked. Null and text without words
    have no shingles, no links and their own id. A null id is no component's
    name: it takes the smallest id of the others, or stays null without any.
    Repeated rows link with each other. Sets are told apart by 64-bit keys of
    their shingles' 64-bit hashes.
    """
    return _linked_rows(docs, percent, words, text_col, id_col, block).select(
        F.col("doc_id").alias(id_col), "n_shingles",
        F.coalesce("name", "doc_id").alias("component_id"))


def _linked_rows(docs: DataFrame, percent: int, words: int, text_col: str, id_col: str,
                 block: int = GROUP_BLOCK) -> DataFrame:
    """(doc_id, n_shingles, node, root, name) for every row: the set's key, its
    component and the smallest id in that; null for a row without words. Where
    ids repeat, several components may have one name."""
    rows = save(_sized(docs.select(F.col(id_col).alias("doc_id"),
                                   F.col(text_col).alias("text")),
                       ["doc_id"], "text", words), "shingle_rows")
    nodes = save(rows.where("node is not null").groupBy("node").agg(
        F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets"),
        F.first("wide").alias("wide"),
        F.min("doc_id").alias("doc_id")), "shingle_nodes")
    # every signature's smallest set, beside the others
    least = F.min("node").over(Window.partitionBy("sig").orderBy("node").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    stars = save(_signature_rows(docs, text_col, words, percent).withColumn("a", least).where(
        F.col("a") != F.col("node")).select("sig", "a", F.col("node").alias("b")), "stars")
    classes = _Classes(docs, text_col, words, percent)
    # one comparison a document: with the one it shares most signatures with
    nearest = stars.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")).groupBy("b").agg(
        F.max_by("a", F.struct("shared", "a")).alias("a"))
    classes.verify(save(_may_link(nearest, nodes, percent), "pairs"))

    members = stars.select("sig", F.col("b").alias("node")).unionAll(
        stars.select("sig", F.col("a").alias("node"))).distinct()

    def unsettled() -> DataFrame:
        """Members of the signatures that hold several classes."""
        with_root = classes.rooted(members, "node", "root")
        several = with_root.groupBy("sig").agg(
            F.min("root").alias("p"), F.max("root").alias("q"),
            F.count(F.lit(1)).alias("g")).where("p <> q").select("sig", "g")
        return with_root.join(several, "sig")

    of_node = nodes.select("node", "n", "buckets")
    # each document in one such signature: the largest it has, then the one of
    # least hash, which copies mostly have in common
    for order in (F.struct("g", "sig"), F.struct(F.xxhash64("sig"), "sig")):
        picked = unsettled().groupBy("node", "root").agg(
            F.max_by(F.struct("sig", "g"), order).alias("s")).select(
            "s.sig", "s.g", "node", "root").join(of_node, "node")
        found = save(_open_pairs(picked, percent, block, True).join(
            classes.tried, ["a", "b"], "left_anti"), "pairs")
        classes.verify(save(_may_link(found, nodes, percent), "pairs"))
    found = save(_open_pairs(unsettled().join(of_node, "node"), percent, block, False),
                 "open_pairs")
    rest = found.join(classes.tried, ["a", "b"], "left_anti")
    classes.verify(save(_may_link(rest, nodes, percent), "pairs"))
    rooted_nodes = nodes.select("node", "doc_id").join(
        classes.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted_nodes.groupBy("root").agg(F.min("doc_id").alias("name"))
    named = save(rooted_nodes.select("node", "root").join(names, "root").select(
        "node", "root", "name"), "component_of")
    for t in (stars, nodes, found, classes.sets, classes.tried):
        drop(t)
    return rows.select("doc_id", "n_shingles", "node").join(named, "node", "left")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classes of all ``documents``, by ``link_documents``."""
    return link_documents(read(spark, sf_dir, "documents"))


def one_of_each(docs: DataFrame, percent: int = SIMILARITY, words: int = WORDS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without those linked to one of smaller id.

    Of rows repeated with one id in one group, one stays: the one of least set
    key, then of least text; an id repeated in several groups has one in each.
    Documents without words stay, whatever else has their id; so do rows without
    an id, which no group can name.
    """
    linked = _linked_rows(docs, percent, words, text_col, id_col)
    kept = linked.where(F.col("doc_id") == F.col("name")).groupBy("root").agg(
        F.min("doc_id").alias("id"), F.min("node").alias("node")).select("id", "node")

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sets, offsets = shingle_sets(*text_buffer(batch.column(batch.num_columns - 1)), words)
        return {"node": pa.array(set_keys(sets, offsets), pa.int64(),
                                 mask=np.diff(offsets) == 0)}

    named = packed(docs.where(F.col(id_col).isNotNull()), text_col)
    rows = map_texts(named.select("row", F.col("row")[id_col].alias("id"), "body"), "body",
                     ["row", "id", "body"], "node long", run)
    # combined before the shuffle, so an id of many rows does not meet in one task
    one = rows.join(kept, ["id", "node"]).groupBy("id", "node").agg(
        F.min_by("row", F.struct("body", F.xxhash64("row"))).alias("row"))
    return one.select("row.*").unionAll(rows.where("node is null").select("row.*")).unionAll(
        docs.where(F.col(id_col).isNull()))
