"""Benchmark decontamination by q-gram lemma filtering.

An item of m characters found with at most e edits shares at least
m + 1 - q (e + 1) of its q-grams with the text, on diagonals (text position
minus item position) that differ by at most e. Shared q-grams are counted in
diagonal bands that overlap by e, so one band holds all of a match's; bands that
reach the bound are regions, and a region is verified by an alignment banded to
its diagonals. An item's commonest q-grams are not looked up, and its bound is
less by their number. The filter loses no match within the budget.

The benchmark is the stated query set: it is cut into blocks of bounded size,
and each block is one map over whole texts, without a shuffle. Of several blocks
one at a time is sent out; its matches are written before the next.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import Shared, map_texts, packed, read, save

Q = 5
EDIT_RATE = 0.15         # edits allowed, as a share of the item's characters
LEAST_SHARED = 4         # q-grams: a short item's budget shrinks until it needs these
LOOKED_UP = 3            # a part of the q-grams needed, one in so many, must be rare ones
HITS_AT_ONCE = 1 << 16   # shared q-grams counted at once
BLOCK_CHARS = 2_000_000  # characters of one block of items
CELLS_A_HIT = 16         # bands are counted in a dense table of at most so many cells
INDEX_BITS = 20          # leading bits of a hash that find its postings
CANDIDATES_AT_ONCE = 256

# lower case for the code points below; beyond them only equal characters match
_LOWER_UPTO = 0x3000


def lower_table() -> np.ndarray:
    """Lower case and one kind of blank, for each code point up to a bound."""
    table = np.arange(_LOWER_UPTO, dtype=np.uint32)
    for i in range(_LOWER_UPTO):
        c = chr(i)
        if c.isspace():
            table[i] = 32
        elif len(c.lower()) == 1:
            table[i] = ord(c.lower())
    return table


def normalise(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts end to end, lower case, runs of blanks as one;
    each one's position in its own text; and the n + 1 offsets."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
    low = np.where(codes < _LOWER_UPTO, table[np.minimum(codes, _LOWER_UPTO - 1)], codes)
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
    keep[starts[:-1][lengths > 0]] = True  # the first of a text, whatever came before it
    at = np.flatnonzero(keep)
    offsets = np.searchsorted(at, starts)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    return low[at], at - starts[doc], offsets


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 32-bit hash of the q code points from each position on (by doubling)."""
    base = np.uint32(0x9E3779B1)
    with np.errstate(over="ignore"):
        power = {1: base}
        piece = {1: (codes ^ (codes >> np.uint32(7))) * np.uint32(0x85EBCA6B) + np.uint32(1)}
        n = 1
        while 2 * n <= q:
            h = piece[n]
            piece[2 * n] = h[:-n] * power[n] + h[n:] if len(h) > n else h[:0]
            power[2 * n] = power[n] * power[n]
            n *= 2
        out, have = piece[n], n
        while have < q:
            n = max(k for k in piece if k <= q - have)
            size = max(0, len(codes) - have - n + 1)
            out = out[:size] * power[n] + piece[n][have:have + size]
            have += n
        out = out ^ (out >> np.uint32(15))
        return out * np.uint32(0x2C1B3C6D)


def budget(m: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """Edits allowed for an item of m characters; 0 if it is too short for the bound."""
    return max(0, min(int(rate * m), (m + 1 - LEAST_SHARED) // q - 1))


@dataclass
class Items:
    """One block of the benchmark: its texts and their q-grams, sorted by hash."""
    ids: list
    codes: list[np.ndarray]
    edits: np.ndarray
    needed: np.ndarray
    least: np.ndarray
    own: tuple[np.ndarray, np.ndarray]
    hashes: np.ndarray
    starts: np.ndarray
    item: np.ndarray
    shift: np.ndarray        # of a posting: length less offset, and a half
    per_band: np.ndarray     # of an item: bands a diagonal
    slot: np.ndarray         # of leading bits: the first hash that has them, or -1
    deepest: int             # most hashes of one slot
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    q: int

    @classmethod
    def build(cls, ids: list, texts: list[str], table: np.ndarray, q: int = Q,
              rate: float = EDIT_RATE) -> "Items":
        low, _, offsets = normalise([t.strip() for t in texts], table)
        codes = [low[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        edits = np.array([budget(len(c), q, rate) for c in codes], np.int64)
        use = np.flatnonzero([len(c) > 0 for c in codes])
        ids, codes, edits = [ids[i] for i in use], [codes[i] for i in use], edits[use]
        parts = [gram_hashes(c, q) for c in codes]
        hashes = np.concatenate([*parts, np.zeros(0, np.uint32)])
        item = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        offset = np.concatenate([*map(np.arange, map(len, parts)), np.zeros(0, np.int64)])
        needed = np.array([len(c) + 1 for c in codes], np.int64) - q * (edits + 1)
        # of each item, leave out the commonest q-grams of the block, and need fewer
        least = np.minimum(needed, np.maximum(LEAST_SHARED, needed // LOOKED_UP))
        _, kind, times = np.unique(hashes, return_inverse=True, return_counts=True)
        order = np.lexsort((offset, -times[kind], item))
        sizes = np.array([len(p) for p in parts], np.int64)
        nth = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        looked_up = order[nth >= np.maximum(needed - least, 0)[item[order]]]
        order = looked_up[np.argsort(hashes[looked_up], kind="stable")]
        # items of fewer than q characters: their hashes by length, sorted
        short = {}
        for m in range(1, q):
            rows = np.array([i for i, c in enumerate(codes) if len(c) == m], np.int64)
            if len(rows):
                own = np.concatenate([gram_hashes(codes[i], m) for i in rows])
                by = np.argsort(own, kind="stable")
                short[m] = own[by], rows[by]
        # all q-grams of all items, sorted by item and hash
        keys = (item.astype(np.uint64) << np.uint64(32)) | hashes
        by = np.argsort(keys, kind="stable")
        own = keys[by], offset[by]
        distinct, starts = np.unique(hashes[order], return_index=True)
        lengths = np.array([len(c) for c in codes], np.int64)
        slot = np.full(1 << INDEX_BITS, -1, np.int32)
        lead = (distinct >> np.uint32(32 - INDEX_BITS)).astype(np.int64)
        slot[lead[::-1]] = np.arange(len(distinct), dtype=np.int32)[::-1]
        deepest = int(np.bincount(lead).max(initial=1)) if len(lead) else 1
        return cls(ids, codes, edits, needed, least, own, distinct,
                   np.append(starts, len(order)), item[order].astype(np.int32),
                   (lengths[item[order]] - offset[order] + 0.5).astype(np.float32),
                   1.0 / (edits + 1),
                   slot, deepest, short, q)

    def regions(self, low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(doc, item, first diagonal, last diagonal) of the runs of bands that
        share enough q-grams; diagonals relative to the document."""
        grams = gram_hashes(low, self.q)
        kind = self.slot[grams >> np.uint32(32 - INDEX_BITS)]
        at = np.flatnonzero(kind >= 0)
        kind, wanted = kind[at], grams[at]
        known = self.hashes[kind] == wanted if len(at) else np.zeros(0, bool)
        for _ in range(self.deepest - 1):
            other = np.flatnonzero(~known)
            kind[other] = np.minimum(kind[other] + 1, len(self.hashes) - 1)
            known[other] = self.hashes[kind[other]] == wanted[other]
        at, first = at[known], self.starts[kind[known]]
        count = self.starts[kind[known] + 1] - first
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[at]
        whole = at + self.q <= offsets[doc + 1]  # not across two documents
        at, first, count, doc = at[whole], first[whole], count[whole], doc[whole]
        if not len(at):
            return (np.zeros(0, np.int64),) * 4
        lengths = self.lengths()
        # whole documents, or stretches of a long one that overlap by the longest match
        span = int((lengths + self.edits).max())
        ends = np.cumsum(count)
        found, a = [], 0
        while a < len(at):
            b = int(np.searchsorted(ends, ends[a] - count[a] + HITS_AT_ONCE, "right"))
            b = max(b, a + 1)
            if b < len(at):
                cut = int(np.searchsorted(doc, doc[b], "left"))  # where that document begins
                b = cut if cut > a else max(b, int(np.searchsorted(at, at[a] + 2 * span)))
            found.append(self._bands(at[a:b] - offsets[doc[a:b]], first[a:b], count[a:b],
                                     doc[a:b], lengths))
            if b < len(at) and doc[b] == doc[b - 1]:
                b = max(a + 1, int(np.searchsorted(at, at[b] - span)))
            a = b
        doc, item, low_d, high_d = map(np.concatenate, zip(*found))
        # one region of those that overlap or meet
        order = np.lexsort((low_d, item, doc))
        doc, item, low_d, high_d = doc[order], item[order], low_d[order], high_d[order]
        if len(found) == 1 or not len(doc):
            return doc, item, low_d, high_d
        pair = doc * len(self.codes) + item
        group = np.cumsum(np.append(0, pair[1:] != pair[:-1]))
        unit = int(high_d.max() - low_d.min()) + 2
        reach = np.maximum.accumulate(high_d - low_d.min() + group * unit)
        new = np.append(True, low_d[1:] - low_d.min() + group[1:] * unit > reach[:-1] + 1)
        begin = np.flatnonzero(new)
        return doc[begin], item[begin], low_d[begin], np.maximum.reduceat(high_d, begin)

    def _bands(self, place: np.ndarray, first: np.ndarray, count: np.ndarray,
               doc: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """The regions of some q-grams: their places in the document, their first
        postings and how many of these there are."""
        items = len(self.codes)
        own = doc - doc[0]
        # each document has as many bands of an item as its last place needs
        top = np.zeros(int(own[-1]) + 1, np.int64)
        np.maximum.at(top, own, place)
        bands = ((top[:, None] + lengths) // (self.edits + 1) + 3).ravel()
        base = np.cumsum(bands) - bands + 1
        cells = int(base[-1] + bands[-1])
        # narrow numbers where they do, for speed
        kind = np.int32 if cells < 1 << 31 else np.int64
        post = np.arange(int(count.sum()), dtype=np.int32)
        post += np.repeat((first - np.cumsum(count) + count).astype(np.int32), count)
        band = np.repeat(place.astype(np.float64), count)
        band += self.shift[post]
        pair = self.item[post]
        band *= self.per_band[pair]
        if len(top) > 1:
            pair += np.repeat((own * items).astype(np.int32), count)
        key = base.astype(kind)[pair]
        key += band.astype(kind)
        # a band takes the cells of two, so that one of them holds all of a match
        if cells <= CELLS_A_HIT * HITS_AT_ONCE:
            shared = np.bincount(key, minlength=cells + 1)
            shared[:-1] += shared[1:]
            key = np.flatnonzero(shared >= max(1, int(self.least.min())))
            shared = shared[key]
        else:
            key, shared = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        pair = np.searchsorted(base, key + 1, "right") - 1  # the first key of a pair is base - 1
        own, item = np.divmod(pair, items)
        band = key - base[pair] + 1
        good = shared >= self.least[item]
        own, item, band, pair, key = own[good], item[good], band[good], pair[good], key[good]
        if not len(key):
            return (np.zeros(0, np.int64),) * 4
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1] + 1) | (pair[1:] != pair[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(key)) - 1
        item = item[begin]
        width = self.edits[item] + 1
        low_d = (band[begin] - 1) * width - lengths[item]
        high_d = band[end] * width + self.edits[item] - lengths[item]
        return own[begin] + doc[0], item, low_d, high_d

    def enough(self, grams: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray,
               low_d: np.ndarray, high_d: np.ndarray) -> np.ndarray:
        """Whether all q-grams of each region's item, the commonest too, reach its
        bound in a band of the region; the document's own q-grams are those of
        ``grams`` from begin to end."""
        keys, offset = self.own
        lengths = self.lengths()
        start = begin + np.maximum(0, low_d)
        size = np.maximum(0, np.minimum(end, begin + high_d + lengths[item]) - start)
        out = np.zeros(len(item), bool)
        ends = np.cumsum(size)
        a = 0
        while a < len(item):  # some regions at a time
            b = max(a + 1, int(np.searchsorted(ends, ends[a] - size[a] + HITS_AT_ONCE, "right")))
            of = np.repeat(np.arange(a, b), size[a:b])
            at = np.arange(len(of)) + np.repeat(
                start[a:b] - np.cumsum(size[a:b]) + size[a:b], size[a:b])
            key = (item[of].astype(np.uint64) << np.uint64(32)) | grams[at]
            first = np.searchsorted(keys, key, "left")
            known = np.flatnonzero(first < len(keys))
            known = known[keys[first[known]] == key[known]]
            of, at, first = of[known], at[known], first[known]
            count = np.searchsorted(keys, key[known], "right") - first
            hit = np.repeat(np.arange(len(of)), count)
            post = np.arange(len(hit)) + np.repeat(first - np.cumsum(count) + count, count)
            of = of[hit]
            diagonal = at[hit] - begin[of] - offset[post]
            inside = (diagonal >= low_d[of]) & (diagonal <= high_d[of])
            of, diagonal = of[inside], diagonal[inside]
            order = np.lexsort((diagonal, of))
            of, diagonal = of[order], diagonal[order]
            # as many as needed, the last within the budget of the first
            last = np.arange(len(of)) + self.needed[item[of]] - 1
            good = np.flatnonzero(last < len(of))
            last = last[good]
            good = good[(of[last] == of[good])
                        & (diagonal[last] - diagonal[good] <= self.edits[item[of[good]]])]
            out[of[good]] = True
            a = b
        return out

    def exact(self, low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, position) of the items that are shorter than a q-gram."""
        items, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for m, (hashes, rows) in self.short.items():
            grams = gram_hashes(low, m)
            first = np.searchsorted(hashes, grams, "left")
            count = np.searchsorted(hashes, grams, "right") - first
            doc = np.searchsorted(offsets, np.arange(len(grams)), "right") - 1
            count[np.arange(len(grams)) + m > offsets[doc + 1]] = 0
            at = np.repeat(np.arange(len(grams)), count)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            item = rows[first[at] + nth]
            own = np.array([self.codes[i] for i in item], np.uint32).reshape(-1, m)
            same = (low[at[:, None] + np.arange(m)] == own).all(axis=1)
            items.append(item[same])
            places.append(at[same])
        return np.concatenate(items), np.concatenate(places)

    def verbatim(self, item: np.ndarray, low: np.ndarray, begin: np.ndarray, end: np.ndarray,
                 low_d: np.ndarray, high_d: np.ndarray) -> np.ndarray:
        """The first diagonal on which each row's document holds its item without
        an edit; the document's length where there is none."""
        out = end - begin
        for n, i in enumerate(item):
            pattern = self.codes[i]
            a = begin[n] + max(0, low_d[n])
            text = low[a:min(end[n], begin[n] + high_d[n] + len(pattern))]
            if len(text) >= len(pattern):
                at = np.flatnonzero(text[:len(text) - len(pattern) + 1] == pattern[0])
                for p in at.tolist():
                    if np.array_equal(text[p:p + len(pattern)], pattern):
                        out[n] = a + p - begin[n]
                        break
        return out

    def lengths(self) -> np.ndarray:
        return np.array([len(c) for c in self.codes], np.int64)

    def align(self, item: np.ndarray, low: np.ndarray, begin: np.ndarray, end: np.ndarray,
              low_d: np.ndarray, high_d: np.ndarray) -> tuple[np.ndarray, ...]:
        """Least edits between each row's item and any stretch of its document that
        stays within its diagonals, and the stretch (start and end)."""
        sizes = np.array([len(self.codes[i]) for i in item], np.int64)
        order = np.argsort(-sizes, kind="stable")  # rows drop out at the end
        sizes, begin, end = sizes[order], begin[order], end[order]
        low_d, high_d = low_d[order], high_d[order]
        pattern = np.zeros((len(item), int(sizes[0])), np.uint32)
        for n, i in enumerate(item[order]):
            pattern[n, :sizes[n]] = self.codes[i]
        width = int((high_d - low_d).max()) + 1
        unit = np.int64(1 << 32)
        step = np.arange(width, dtype=np.int64) * unit
        # a cell is edits * unit + the diagonal it began on
        cells = np.tile(np.arange(width, dtype=np.int64), (len(item), 1))
        barred = low_d[:, None] + np.arange(width) > high_d[:, None]
        cells[barred] = unit * (1 << 20)
        pad = np.append(low, np.uint32(0xFFFFFFFF))
        place = begin[:, None] + low_d[:, None] + np.arange(width)
        for n in range(int(sizes[0])):
            live = int(np.searchsorted(-sizes, -n, "left"))  # rows of more than n characters
            at = place[:live] + n
            outside = (at < begin[:live, None]) | (at >= end[:live, None])
            same = pad[np.where(outside, len(low), at)] == pattern[:live, n:n + 1]
            old = cells[:live]
            new = old + np.where(same, 0, unit)
            new[:, :-1] = np.minimum(new[:, :-1], old[:, 1:] + unit)
            new[barred[:live]] = unit * (1 << 20)
            cells[:live] = np.minimum.accumulate(new - step, axis=1) + step
        best = cells.argmin(axis=1)
        value = cells[np.arange(len(item)), best]
        start = np.maximum(low_d + value % unit, 0)
        stop = np.minimum(low_d + best + sizes, end - begin)
        out = np.empty((3, len(item)), np.int64)
        out[:, order] = value // unit, start, stop
        return tuple(out)


MATCH = "matches array<struct<item_id:{0},start:int,end:int,edits:int>>"


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               keep: tuple[str, ...] = ("doc_id",), item_col: str = "item_id",
               item_text: str = "text", q: int = Q, rate: float = EDIT_RATE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``keep`` plus ``matches``: item_id, start and end (code points), edits.

    One row per input row, repeated rows included; null and empty texts have no
    matches and null ids stay null. Case and runs of blanks do not count.
    Items with a null or blank text match nothing; those too short for the
    bound match exactly; items repeated with id and text count once. An item
    clipped at an end matches while the part left out is within its budget.
    Of overlapping regions of one item
    the best match is given (ties: the leftmost); matches come by item order,
    then start. An empty benchmark gives empty lists.
    """
    items = benchmark.select(F.col(item_col).alias("item"),
                             F.col(item_text).cast("string").alias("body")).where(
        F.col("body").isNotNull()).distinct()
    chars = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, -(-int(chars) // block_chars))
    id_type = items.schema["item"].dataType
    arrow_type = pa.list_(pa.struct([
        ("item_id", arrow_type_of(id_type)), ("start", pa.int32()), ("end", pa.int32()),
        ("edits", pa.int32())]))
    names = [f"own_{n}" for n in range(len(keep))]
    found = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)],
                        F.col(text_col).cast("string").alias("own_text"))
    kind = MATCH.format(id_type.simpleString())
    table = lower_table()
    spark = docs.sparkSession

    def matches_of(df: DataFrame, carried: list[str], b: int) -> tuple[DataFrame, Shared]:
        rows = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == b).orderBy(
            "item", "body").collect()
        shared = Shared(spark, (Items.build([r["item"] for r in rows], [r["body"] for r in rows],
                                            table, q, rate), table))

        def scan(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            index, lower = shared.get()
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            return {"matches": pa.array(matches_in(texts, index, lower), arrow_type)}

        return map_texts(df, "own_text", carried, kind, scan), shared

    if blocks == 1:
        found = matches_of(found, names, 0)[0]
    else:
        base = save(found.withColumn("nth", F.monotonically_increasing_id()), "leak_texts")
        parts = []
        for b in range(blocks):  # one bounded block at a time
            got, shared = matches_of(base, ["nth"], b)
            parts.append(save(got.where(F.size("matches") > 0).withColumn("b", F.lit(b)),
                              "leak_matches"))
            shared.destroy()
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionAll(part)
        by_row = rows.groupBy("nth").agg(F.flatten(F.transform(F.sort_array(F.collect_list(
            F.struct("b", "matches"))), lambda x: x["matches"])).alias("matches"))
        none = F.array().cast(by_row.schema["matches"].dataType)
        found = base.join(by_row, "nth", "left").withColumn(
            "matches", F.coalesce("matches", none))
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "matches")


def arrow_type_of(kind):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def matches_in(texts: list[str], index: Items, table: np.ndarray) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in texts]
    low, place, offsets = normalise(texts, table)
    doc, item, low_d, high_d = index.regions(low, offsets)
    grams = gram_hashes(low, index.q)
    last = np.maximum(offsets[doc], offsets[doc + 1] - index.q + 1)
    keep = index.enough(grams, offsets[doc], last, item, low_d, high_d)
    doc, item, low_d, high_d = doc[keep], item[keep], low_d[keep], high_d[keep]
    begin, end = offsets[doc], offsets[doc + 1]
    start = index.verbatim(item, low, begin, end, low_d, high_d)
    edits, stop = np.zeros(len(item), np.int64), start + index.lengths()[item]
    rest = np.flatnonzero(start >= end - begin)
    for a in range(0, len(rest), CANDIDATES_AT_ONCE):
        k = rest[a:a + CANDIDATES_AT_ONCE]
        edits[k], start[k], stop[k] = index.align(item[k], low, begin[k], end[k], low_d[k],
                                                  high_d[k])
    good = np.flatnonzero((edits <= index.edits[item]) & (stop > start))
    for k in good[np.argsort(item[good], kind="stable")]:
        a, b = begin[k] + start[k], begin[k] + stop[k] - 1
        out[doc[k]].append({"item_id": index.ids[item[k]], "start": int(place[a]),
                            "end": int(place[b]) + 1, "edits": int(edits[k])})
    item, at = index.exact(low, offsets)
    for i, a in zip(item, at):
        out[np.searchsorted(offsets, a, "right") - 1].append({
            "item_id": index.ids[i], "start": int(place[a]),
            "end": int(place[a + len(index.codes[i]) - 1]) + 1, "edits": 0})
    return out


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each place where a document holds a benchmark item."""
    found = find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    return find_leaks(packed(docs, text_col), benchmark, "body", ("row",)).where(
        F.size("matches") == 0).select("row.*")
