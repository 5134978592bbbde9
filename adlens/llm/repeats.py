"""Removal of repeated passages with a sampled suffix array.

A byte goes when a string of ``length`` bytes that covers it also starts
anywhere else. Of all suffixes only anchored ones are sorted: in every window
of that length the position whose ``gram`` bytes hash lowest (the leftmost of
equal ones) is an anchor, which depends on the window's bytes alone. Two equal
windows therefore have anchors at the same place, and every repeated window is
seen at a pair of anchors with equal grams. About one byte in 75 is an anchor.

1. Anchors are counted by gram and by neighbourhood (all bytes of the windows
   around them), first within a slice of texts, so equal suffixes are one row
   before anything is shuffled. A neighbourhood met twice is repeated as a
   whole. An anchor whose gram is nowhere else is dropped.
2. One suffix of each neighbourhood whose gram has others is range-partitioned
   by its leading bytes, at splitters that Spark samples. Suffixes of one gram
   are neighbours in a bucket; only a gram with more than ``run_bound`` of them
   is split further, by the bytes that follow and precede it.
3. Buckets are sorted by multikey quicksort, eight bytes at a time, and the
   windows that suffixes of one gram share are found there. Those of a split
   gram are compared across the buckets' boundaries, with an aggregate.
4. The spans so found are joined back to every anchor, then to its text.

Texts are told apart by 128 bits of their SHA-256, neighbourhoods by 128 bits of
hashes (two of 64), windows of one gram by 64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm.common import (SLICE_BYTES, byte_lengths, drop, read, save, slices,
                               text_buffer)

LENGTH = 200
GRAM = 48
SUFFIXES_PER_BUCKET = 10_000
RUN_BOUND = 20_000       # suffixes of one gram that one bucket may hold
BUCKET_COLUMN_BYTES = 8

_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


_BYTE_VALUES = _scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE[0]))


def window_hashes(data: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A hash of the ``size`` bytes from each position on (by doubling)."""
    base = np.uint64(_BASE[which])
    with np.errstate(over="ignore"):
        piece, power, n = _BYTE_VALUES[data], base, 1
        out, out_size = None, 0
        left = size
        # size in binary, smallest part first: out covers the last bytes
        while True:
            if left & 1:
                if out is None:
                    out, out_size = piece, n
                else:
                    length = max(0, len(data) - n - out_size + 1)
                    out = piece[:length] * _power(base, out_size) + out[n:n + length]
                    out_size += n
            left >>= 1
            if not left:
                return _scramble(out)
            piece = piece[:-n] * power + piece[n:] if len(piece) > n else piece[:0]
            power = power * power
            n *= 2


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def sliding_least(hashes: np.ndarray, size: int) -> np.ndarray:
    """The position of the least (leftmost) of each ``size`` hashes in a row, by
    their upper 32 bits."""
    low = np.uint64(0xFFFFFFFF)
    best = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    n = 1
    while n < size:
        step = min(n, size - n)
        best = np.minimum(best[:-step], best[step:])
        n += step
    return (best & low).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position in the buffer, gram hash) of the anchors of all windows
    that lie within one text."""
    hashes = window_hashes(data, gram)
    windows = len(data) - length + 1
    if windows <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    least = sliding_least(hashes, length - gram + 1)[:windows]
    inside = np.zeros(len(data) + 1, np.int64)
    ends = offsets[1:] - length + 1
    whole = ends > offsets[:-1]
    inside[offsets[:-1][whole]] += 1
    inside[ends[whole]] -= 1
    at = least[np.cumsum(inside)[:windows] > 0]
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]  # they never step back
    at = at[new]
    return np.searchsorted(offsets, at, "right") - 1, at, hashes[at]


def span_hash(data: np.ndarray, begin: np.ndarray, end: np.ndarray,
              powers: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes and its length."""
    with np.errstate(over="ignore"):
        # running hash; a stretch is the difference, scaled back by its power
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
            _BYTE_VALUES[data] * powers[0][:len(data)], dtype=np.uint64)])
        return _scramble((sums[end] - sums[begin]) * powers[1][begin]
                         + (end - begin).astype(np.uint64) * np.uint64(_BASE[0]))


def power_rows(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the second base and of its inverse, from 0 to ``size``."""
    rows = []
    for base in (_BASE[1], pow(_BASE[1], -1, 1 << 64)):
        row = np.full(size + 1, np.uint64(base))
        row[0] = 1
        with np.errstate(over="ignore"):
            rows.append(np.multiply.accumulate(row))
    return rows[0], rows[1]


def text_keys(texts: pa.Array) -> np.ndarray:
    """Two 64-bit integers of each text's SHA-256."""
    joined = b"".join(hashlib.sha256(t or b"").digest()[:16]
                      for t in texts.cast(pa.binary()).to_pylist())
    return np.frombuffer(joined, ">i8").astype(np.int64).reshape(-1, 2)


KEY = ["t1", "t2"]


def with_key(text: str) -> list:
    """The same two integers as columns."""
    digest = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)
    # conv gives an unsigned number; its upper half wraps into the negative ones
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    return [half(1).alias("t1"), half(17).alias("t2")]


def reach(at: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, gram: int):
    """The neighbourhood of each anchor: all windows that hold its gram."""
    return np.maximum(first, at - (length - gram)), np.minimum(last, at + length)


def _fresh_texts(batches: Iterator[pa.RecordBatch], length: int):
    """Slices of texts long enough for a window, without those a task met before."""
    seen: set[bytes] = set()
    for part in slices(batches, "body"):
        part = part.filter(pa.array(byte_lengths(part.column(0)) >= length))
        if not part.num_rows:
            continue
        keys = text_keys(part.column(0))
        use = []
        for n, key in enumerate(map(bytes, keys)):
            if key not in seen:
                seen.add(key)
                use.append(n)
        if use:
            yield keys[use], part.column(0).take(pa.array(use))


def _anchor_rows(docs: DataFrame, length: int, gram: int, counted: bool) -> DataFrame:
    """(gram, near, t1, t2, pos) of each anchor of each text of a task; if
    ``counted``, one of each neighbourhood in a slice, and their number n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = power_rows(0)
        for keys, texts in _fresh_texts(batches, length):
            data, offsets = text_buffer(texts)
            if len(powers[0]) <= len(data):
                powers = power_rows(max(len(data), SLICE_BYTES))
            doc, at, grams = anchors(data, offsets, length, gram)
            begin, end = reach(at, offsets[doc], offsets[doc + 1], length, gram)
            # where in its neighbourhood the anchor stands is part of it
            near = _scramble(span_hash(data, begin, end, powers)
                             ^ ((at - begin).astype(np.uint64) << np.uint64(1)))
            n = np.ones(len(at), np.int64)
            if counted:
                order = np.lexsort((near, grams))
                new = np.ones(len(at), bool)
                new[1:] = ((grams[order[1:]] != grams[order[:-1]])
                           | (near[order[1:]] != near[order[:-1]]))
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at)))
                pick = order[first]
                doc, at, grams, near = doc[pick], at[pick], grams[pick], near[pick]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (grams.view(np.int64), near.view(np.int64), keys[doc, 0],
                                       keys[doc, 1], (at - offsets[doc]).astype(np.int32), n)],
                ["gram", "near", *KEY, "pos", "n"])

    body = docs.select(F.col("text").cast("string").alias("body"))
    return body.mapInArrow(run, "gram long, near long, t1 long, t2 long, pos int, n long")


def _texts_once(docs: DataFrame, length: int) -> DataFrame:
    """(t1, t2, body): the texts long enough, each once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _fresh_texts(batches, length):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), texts], [*KEY, "body"])

    body = docs.select(F.col("text").cast("string").alias("body"))
    return body.mapInArrow(run, "t1 long, t2 long, body string")


def _suffixes(texts: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, near, big, lead, suffix, before): the bytes around each wanted
    anchor; ``lead`` the gram, ``suffix`` from it on, ``before`` reversed."""
    by_text = wanted.groupBy(*KEY).agg(F.collect_list(F.struct(
        "pos", "gram", "near", "big")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "body"):
            rows = []
            for text, found in zip(part.column("body").cast(pa.binary()).to_pylist(),
                                   part.column("at").to_pylist()):
                for a in found:
                    p = a["pos"]
                    suffix = text[p:p + length]
                    before = text[max(0, p - (length - gram)):p][::-1]
                    rows.append((a["gram"], a["near"], a["big"], suffix[:gram], suffix, before))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(),
                    pa.binary()))], ["gram", "near", "big", "lead", "suffix", "before"])

    return texts.join(by_text, KEY).select("body", "at").mapInArrow(
        run, "gram long, near long, big boolean, lead binary, suffix binary, before binary")


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Multikey quicksort of byte rows of equal width: sort by the first eight
    bytes, then only what is still equal by the next eight, and so on."""
    width = -(-rows.shape[1] // BUCKET_COLUMN_BYTES) * BUCKET_COLUMN_BYTES
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, :rows.shape[1]] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="quicksort")
    group = np.zeros(len(rows), np.int64)  # of each place in the order
    group[1:] = np.cumsum(words[order[1:], 0] != words[order[:-1], 0])
    for c in range(1, words.shape[1]):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        inner = np.lexsort((words[order[tied], c], group[tied]))
        order[tied] = order[tied[inner]]
        step = np.zeros(len(rows), bool)
        step[1:] = group[1:] != group[:-1]
        word = words[order[tied], c]
        same = (np.diff(tied, prepend=-2) == 1) & ~step[tied]
        step[tied[1:]] |= same[1:] & (word[1:] != word[:-1])
        group = np.cumsum(step)
    return order


def _byte_rows(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_buffer(column)
    size = np.diff(offsets)
    out = np.zeros((len(size), width), np.uint8)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(data)) - offsets[row]] = data
    return out, size


def _merge_starts(owner: np.ndarray, start: np.ndarray, length: int) -> tuple[
        np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by windows (ascending by owner, start)."""
    new = np.ones(len(start), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1 if len(start) else first
    return owner[first], start[first], start[last] + length


def compare_bucket(table: pa.Table, length: int, gram: int) -> pa.RecordBatch:
    """Sort one bucket; (gram, near, lo, hi, window) rows: spans of repeated
    windows relative to the anchor, or, for split grams, all window hashes with
    their start in ``lo``."""
    table = table.combine_chunks()
    suffix, after = _byte_rows(table["suffix"].combine_chunks(), length)
    order = multikey_order(suffix)
    grams = table["gram"].to_numpy()[order]
    near = table["near"].to_numpy()[order]
    big = table["big"].to_numpy()[order]
    # a text that several tasks met gives its suffixes more than once
    pair = np.lexsort((near, grams))
    again = np.zeros(len(pair), bool)
    again[pair[1:]] = (grams[pair[1:]] == grams[pair[:-1]]) & (near[pair[1:]] == near[pair[:-1]])
    order, grams, near, big = order[~again], grams[~again], near[~again], big[~again]
    suffix, after = suffix[order], after[order]
    before, ahead = _byte_rows(table["before"].combine_chunks().take(pa.array(order)),
                               length - gram)
    # suffixes with one gram stand together; each such run is numbered
    lead = suffix[:, :gram]
    run = np.zeros(len(order), np.int64)
    run[1:] = np.cumsum((lead[1:] != lead[:-1]).any(axis=1))
    size = np.bincount(run, minlength=1)
    use = (size[run] > 1) | big
    grams, near, big, run = grams[use], near[use], big[use], run[use]
    rows = np.concatenate([before[use][:, ::-1], suffix[use]], axis=1)
    ahead, after = ahead[use], after[use]
    width = rows.shape[1]
    found = [(np.zeros(0, np.int64),) * 3]
    if len(rows):
        # every window of every row, by run, place of the anchor and bytes
        hashes = window_hashes(rows.ravel(), length)
        start = np.arange(width - length + 1)
        row = np.arange(len(rows))[:, None]
        inside = ((start >= length - gram - ahead[:, None])
                  & (start + length <= length - gram + after[:, None]))
        owner, start = np.nonzero(inside)
        value = hashes[owner * width + start]
        lo = start - (length - gram)  # relative to the anchor
        here = ~big[owner]
        with np.errstate(over="ignore"):
            key = _scramble(value + _scramble(
                (run[owner] * 512 + start).astype(np.uint64) * np.uint64(_BASE[1])))
        o, k, s = owner[here], key[here], lo[here]
        by = np.argsort(k, kind="stable")
        twice = np.zeros(len(k), bool)
        equal = k[by[1:]] == k[by[:-1]]
        twice[by[1:]] |= equal
        twice[by[:-1]] |= equal
        found.append(_merge_starts(o[twice], s[twice], length))
        far = big[owner]
        across = owner[far], lo[far], value[far]
    else:
        across = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    owner, lo, hi = (np.concatenate([f[i] for f in found]) for i in range(3))
    owner = np.concatenate([owner, across[0]])
    window = np.concatenate([np.zeros(len(lo), np.int64), across[2].view(np.int64)])
    return pa.RecordBatch.from_arrays([
        pa.array(grams[owner]), pa.array(near[owner]),
        pa.array(np.concatenate([lo, across[1]]).astype(np.int32)),
        pa.array(np.concatenate([hi, across[1] + length]).astype(np.int32)),
        pa.array(window, pa.int64(), mask=np.arange(len(window)) < len(lo))],
        ["gram", "near", "lo", "hi", "window"])


def _repeated_spans(suffixes: DataFrame, length: int, gram: int, per_bucket: int) -> DataFrame:
    """(gram, near, lo, hi) of the repeated spans at each neighbourhood."""
    buckets = max(1, -(-suffixes.count() // per_bucket))
    rest = F.when(F.col("big"), F.concat("suffix", "before"))
    bucketed = suffixes.repartitionByRange(buckets, F.col("lead"), rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield compare_bucket(pa.Table.from_batches(held), length, gram)

    made = save(bucketed.mapInArrow(
        run, "gram long, near long, lo int, hi int, window long"), "bucket_spans")
    across = made.where("window is not null")
    twice = across.groupBy("gram", "lo", "window").agg(F.count(F.lit(1)).alias("c")).where(
        "c > 1").drop("c")
    return made.where("window is null").drop("window").unionAll(
        across.join(twice, ["gram", "lo", "window"]).select("gram", "near", "lo", "hi"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   text_col: str = "text", id_col: str = "doc_id",
                   per_bucket: int = SUFFIXES_PER_BUCKET, run_bound: int = RUN_BOUND
                   ) -> DataFrame:
    """(id, n_bytes, removed, kept): for every row the maximal removed runs of
    bytes (start, end) and the remaining bytes, as binary (a cut may split a
    character).

    Repeated rows are copies of one another, so all bytes of each go (from
    ``length`` bytes on). Null and empty texts keep no bytes and lose none; null
    ids stay null. Texts are judged whole, whatever their length, and on the
    input, not on what is left.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(
        F.col(text_col).cast("string"), F.lit("")).alias("text"))
    gather = _anchor_rows(rows, length, gram, True).repartition("gram").groupBy(
        "gram", "near").agg(F.sum("n").alias("n"), *[F.first(c).alias(c)
                                                     for c in (*KEY, "pos")])
    others = F.count(F.lit(1)).over(Window.partitionBy("gram"))
    known = save(gather.withColumn("others", others).where("n > 1 or others > 1"), "anchors")
    wanted = known.where("others > 1").withColumn("big", F.col("others") > run_bound)
    suffixes = save(_suffixes(_texts_once(rows, length), wanted, length, gram), "suffixes")
    spans = _repeated_spans(suffixes, length, gram, per_bucket)
    # a neighbourhood met twice is repeated as a whole: no list of spans
    settled = save(known.where("n > 1").select("gram", "near").withColumn(
        "spans", F.lit(None).cast("array<struct<lo:int,hi:int>>")).unionAll(
        spans.join(known.where("n > 1").select("gram", "near"), ["gram", "near"], "left_anti")
        .groupBy("gram", "near").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))),
        "settled")
    drop(suffixes)
    at_text = _anchor_rows(rows, length, gram, False).join(settled, ["gram", "near"]).groupBy(
        *KEY).agg(F.collect_set(F.struct("pos", "spans")).alias("found"))
    copied = rows.where(F.octet_length("text") >= length).select(*with_key("text")).groupBy(
        *KEY).agg((F.count(F.lit(1)) > 1).alias("copied")).where("copied")
    verdicts = save(at_text.join(copied, KEY, "full").select(
        *KEY, F.coalesce("copied", F.lit(False)).alias("copied"),
        F.when(F.col("copied").isNull(), F.col("found")).alias("found")), "verdicts")
    for t in (known, settled):
        drop(t)
    joined = rows.select("doc_id", "text", *with_key("text")).join(verdicts, KEY, "left")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    runs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            removed, kept = [], []
            for text, copied, found in zip(part.column("text").cast(pa.binary()).to_pylist(),
                                           part.column("copied").to_pylist(),
                                           part.column("found").to_pylist()):
                gone = _runs(len(text), copied, found, length, gram)
                removed.append([{"start": a, "end": b} for a, b in gone])
                edges = [0, *[x for ab in gone for x in ab], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(byte_lengths(part.column("text"))),
                 pa.array(removed, runs), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "removed", "kept"])

    return joined.select("doc_id", "text", "copied", "found").mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, removed array<struct<start:int,end:int>>, "
             "kept binary").withColumnRenamed("doc_id", id_col)


def _runs(size: int, copied: bool | None, found: list | None, length: int, gram: int):
    """Maximal removed runs of one text."""
    if copied:
        return [(0, size)]
    pieces = []
    for f in found or ():
        p = f["pos"]
        if f["spans"] is None:
            pieces.append((max(0, p - (length - gram)), min(size, p + length)))
        else:
            pieces += [(p + s["lo"], p + s["hi"]) for s in f["spans"]]
    out: list[tuple[int, int]] = []
    for a, b in sorted(pieces):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without repeated passages, by ``remove_repeats``."""
    got = remove_repeats(read(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"),
                       lambda s, r: s + (r["end"] - r["start"]))
    return got.select("doc_id", "n_bytes", gone.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
