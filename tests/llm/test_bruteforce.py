"""Joins, removals, searches, packing and sharding against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlens.llm import (components, decontamination, jaccard, packing, repeats, sharding, topk)
from adlens.llm.catalog import ORACLE_SQL, QUERIES


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# -- repeated passages ---------------------------------------------------------

def plain_runs(texts, length):
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, int)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i + 1:i + length + 1] = 1
        step = np.diff(gone)
        out.append(list(zip(np.flatnonzero(step == 1).tolist(),
                            np.flatnonzero(step == -1).tolist())))
    return out


def awkward_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé ") for _ in range(rng.randint(1, 9)))
    shared = ["".join(word() for _ in range(9)) for _ in range(3)]
    texts = ["", "ab" * 40, "a" * 90]
    for _ in range(60):
        parts = [word() for _ in range(rng.randint(0, 12))]
        for s in rng.sample(shared, rng.randint(0, 2)):
            a = rng.randint(0, len(s) // 2)
            parts.insert(rng.randint(0, len(parts)), s[a:a + rng.randint(10, len(s))])
        texts.append("".join(parts))
    return texts + texts[5:9] + [texts[5]] * 10


@pytest.mark.parametrize("bound", [20_000, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, seed, bound):
    texts = awkward_texts(seed)
    got = repeats.remove_repeats(frame(spark, texts).repartition(5), length=20, gram=6,
                                 per_bucket=15, run_bound=bound).collect()
    want = plain_runs([t.encode() for t in texts], 20)
    assert len(got) == len(texts)
    for r in got:
        assert [tuple(x) for x in r.removed] == want[r.doc_id], texts[r.doc_id]
        raw = texts[r.doc_id].encode()
        edges = [0, *itertools.chain(*want[r.doc_id]), len(raw)]
        assert bytes(r.kept) == b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=13, max_size=13).map(
    lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=60))
def test_multikey_order(rows):
    table = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 13)
    order = repeats.multikey_order(table)
    assert [rows[i] for i in order] == sorted(rows)


# -- similarity join -----------------------------------------------------------

def plain_components(texts, words, percent):
    sets = []
    for t in texts:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).split()
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w
                    else set())
    root = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(
                sets[i] | sets[j]):
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    return [len(s) for s in sets], root


def near_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    texts = ["", "One", "one", "a b c", "A b C", "a b c d", "a b c d e"]
    for size in (5, 8, 12, 30, 60, 61, 200):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, size // 20))):
                at = rng.randrange(len(copy))
                copy[at:at + rng.randint(0, 1)] = [rng.choice(vocabulary)]
            texts.append(" ".join(copy))
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(25))
              for _ in range(30)]
    return texts + texts[20:24]


@pytest.mark.parametrize("seed, percent, words, block", [(1, 85, 4, 4096), (2, 80, 5, 3)])
def test_jaccard(spark, seed, percent, words, block):
    texts = near_copies(seed)
    got = {r.doc_id: r for r in jaccard.link_documents(
        frame(spark, texts).repartition(4), percent, words, block=block).collect()}
    sizes, roots = plain_components(texts, words, percent)
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == roots
    assert len(set(roots)) < len(texts) - 40


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 10 ** 6))
def test_linked_sets_share_a_signature(common, only_a, only_b, seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 1 << 63, common + only_a + only_b, dtype=np.uint64)
    a = np.sort(values[:common + only_a])
    b = np.sort(np.concatenate([values[:common], values[common + only_a:]]))
    sigs, owner = jaccard.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    if 100 * common >= 85 * len(values):
        assert set(sigs[owner == 0].tolist()) & set(sigs[owner == 1].tolist())


@pytest.mark.parametrize("mixed", [False, True])
def test_pairs_in_parts(mixed):
    """Parts hold all pairs, and a forest that takes them in is the forest of all."""
    rng = np.random.default_rng(11)
    rows = 90
    key = np.repeat([5, 9], [60, 30])
    root = rng.integers(0, 25, rows)
    n = np.full(rows, 200)
    side = np.where(rng.random(rows) < 0.5, 1, -1) if mixed else np.zeros(rows, np.int64)
    counts = np.tile(rng.integers(0, 3, jaccard.BUCKETS), (rows, 1)).astype(np.uint8)
    for row in counts:
        row[rng.integers(0, jaccard.BUCKETS, rng.integers(0, 60))] += 1
    whole, = jaccard.near_pairs(key, root, n, side, counts, 85, 1 << 30)
    parts = list(jaccard.near_pairs(key, root, n, side, counts, 85, 40))
    assert len(parts) > 5 and max(len(p[0]) for p in parts) < 40 + rows
    pairs = lambda p: list(zip(*(x.tolist() for x in p)))
    assert [x for p in parts for x in pairs(p)] == pairs(whole)
    plain = [(a, b) for a in range(rows) for b in range(a + 1, rows)
             if key[a] == key[b] and root[a] != root[b] and (not mixed or side[a] != side[b])
             and np.abs(counts[a].astype(int) - counts[b]).sum() <= 15 * 400 // 185]
    assert sorted(p[:2] for p in pairs(whole)) == plain
    forest = parts[0]
    for part in [*parts[1:], None]:
        use = jaccard.spanning_pairs(key, root, *forest)
        forest = tuple(x[use] for x in forest)
        if part:
            forest = tuple(map(np.concatenate, zip(forest, part)))
    use = jaccard.spanning_pairs(key, root, *whole)
    assert sorted(pairs(forest)) == sorted(pairs(tuple(x[use] for x in whole)))


def test_bands_cover_all_pairs_that_may_link():
    bands = jaccard.Bands(85, 3000)
    for a in range(1, 2500):
        b = a * 100 // 85
        assert any(low <= a and b <= high for low, high in zip(bands.low, bands.high))


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    edges += [(100, n) for n in range(101, 140)] + [(n, n + 1) for n in range(200, 240)]
    df = spark.createDataFrame(edges + [(None, 3), (7, 7)], "a long, b long")
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for a, b in edges:
        x, y = root[a], root[b]
        root = {n: min(x, y) if r in (x, y) else r for n, r in root.items()}
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {n: r for n, r in root.items() if n in got}
    assert set(got) == {n for e in edges if e[0] != e[1] for n in e}


# -- benchmark items -----------------------------------------------------------

def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for n, c in enumerate(item):
        new = [n + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_leaks(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6)))
    items = [" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(6)]
    texts = []
    for n in range(80):
        item = list(rng.choice(items))
        for _ in range(rng.randint(0, len(item) // 8)):
            at = rng.randrange(len(item))
            item[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "yz"])
        around = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(2)]
        texts.append(" ".join([around[0], "".join(item).replace(" ", rng.choice([" ", "  "])),
                               around[1]]))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontamination.find_leaks(frame(spark, texts), bench, block_chars=300).collect()
    found = 0
    for r in got:
        text = " ".join(texts[r.doc_id].lower().split())
        want = {i for i, item in enumerate(items)
                if least_edits(item, text) <= decontamination.budget(len(item))}
        assert {m.item_id for m in r.matches} == want
        for m in r.matches:
            # the reported stretch itself is within the edits reported
            part = re.sub(r"\s+", " ", texts[r.doc_id][m.start:m.end].lower())
            assert least_edits(items[m.item_id], part) <= m.edits
        found += len(want)
    assert 20 < found < 80


def leaks_in(texts, items):
    table = decontamination.lower_table()
    index = decontamination.Items.build(list(range(len(items))), items, table)
    return [{m["item_id"] for m in found}
            for found in decontamination.matches_in(texts, index, table)]


def test_lightly_edited_leaks():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(40)]
    short, long = " ".join(words[:11]) + " end.", " ".join(words[11:])
    assert len(short) == 81
    around = ["nopq rstu " * 30, " vwxy zzzz" * 30]
    hidden = [short.replace(words[4], "zyxwvu"), long.replace(words[20], "zyxwvu").replace(
        words[30], "qrstuv").replace(words[35], "nopqrs"), long[:-len(long) // 10],
        long[len(long) // 10:]]
    got = leaks_in([around[0] + h + around[1] for h in hidden], [short, long])
    assert got == [{0}, {1}, {1}, {1}]
    assert leaks_in([short[:50], long[:100]], [short, long]) == [set(), set()]


def test_short_items_match_exactly():
    items = ["Paris, France", "x = 42", "né", "abcde", " ", "q"]
    texts = ["in paris,  france.", "so X = 42!", "je suis né ici", "abcd abce", "in paris, fra",
             "x = 4", "xabcdex", "", "n", "Q"]
    assert leaks_in(texts, items) == [{0}, {1}, {2}, set(), set(), set(), {3}, set(), set(), {5}]
    table = decontamination.lower_table()
    index = decontamination.Items.build([1], ["né"], table)
    assert decontamination.matches_in(["", "a  né né"], index, table)[1] == [
        {"item_id": 1, "start": 3, "end": 5, "edits": 0},
        {"item_id": 1, "start": 6, "end": 8, "edits": 0}]


def test_blocks_of_a_benchmark_give_the_same(spark):
    rng = random.Random(11)
    words = [f"{w}{n}" for n in range(60) for w in ("alpha", "beta")]
    items = [(n, " ".join(rng.choice(words) for _ in range(25))) for n in range(12)]
    texts = ["no item here at all", None, ""]
    for n in range(40):
        texts.append(" ".join(["before", *(items[rng.randrange(12)][1] for _ in range(n % 3)), "after"]))
    docs = frame(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {r.doc_id: r.matches for r in decontamination.find_leaks(docs, bench).collect()}
    cut = decontamination.find_leaks(docs, bench, block_chars=500).collect()
    assert len(cut) == len(texts) and sum(map(len, whole.values())) > 20
    for r in cut:
        assert sorted(r.matches) == sorted(whole[r.doc_id])


@pytest.mark.parametrize("hits", [1, 60, 1 << 18])
def test_leaks_of_long_texts_in_stretches(monkeypatch, hits):
    monkeypatch.setattr(decontamination, "HITS_AT_ONCE", hits)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6)))
    items = [" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(8)]
    texts = ["", word()]
    for _ in range(12):
        parts = [word() for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            item = list(rng.choice(items))
            for _ in range(rng.randint(0, len(item) // 6)):
                item[rng.randrange(len(item))] = rng.choice("xyz")
            parts.insert(rng.randint(0, len(parts)), "".join(item))
        texts.append(" ".join(parts))
    want = [{i for i, item in enumerate(items)
             if least_edits(item, text) <= decontamination.budget(len(item))} for text in texts]
    assert leaks_in(texts, items) == want and any(want)


# -- packing -------------------------------------------------------------------

@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_pack(lengths):
    caps = (16, 32, 64)
    bins, offsets, sizes, used = packing.pack(np.array(lengths, int), caps)
    for b in range(len(sizes)):
        inside = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert [o for o, _ in inside] == [0, *np.cumsum([n for _, n in inside])[:-1].tolist()]
        assert sum(n for _, n in inside) == used[b]
        assert sizes[b] == min(c for c in caps if c >= used[b])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_pack_takes_the_tightest_bin(lengths):
    caps = (16, 32, 64)
    bins, offsets, sizes, used = packing.pack(np.array(lengths, int), caps)
    room, left = {}, sum(lengths)
    # replay the placements: longest first, equal ones in the order given
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fitting = [r for r in room.values() if r >= n]
        if fitting:
            assert room[bins[i]] == min(fitting)
        else:
            assert bins[i] == len(room)
            room[bins[i]] = min((c for c in caps if c >= n), key=lambda c: (
                packing.cost(c) / min(c, left), c))
        room[bins[i]] -= n
        left -= n
    assert len(sizes) == len(used) == len(room)


def test_packing_of_the_table(spark, sf_small):
    got = QUERIES["op2_best_fit_packing"](spark, sf_small).toPandas()
    whole = got.groupby("doc_id")["n_tokens"].sum()
    counts = packing.token_counts(spark.read.parquet(f"{sf_small}/documents.parquet")).toPandas()
    assert whole.to_dict() == dict(zip(counts["doc_id"], counts["n_tokens"]))
    per = got.groupby(["block", "bin"]).agg(
        n=("n_tokens", "sum"), used=("used", "first"), cap=("capacity", "first"))
    assert (per["n"] == per["used"]).all() and (per["used"] <= per["cap"]).all()
    assert per["used"].sum() / per["cap"].sum() > 0.95


# -- sharding ------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=9))
def test_differencing(sizes):
    places, sums = sharding.differencing([(s,) for s in sizes], 2)
    assert [sum(s for s, p in zip(sizes, places) if p[0] == k) for k in (0, 1)] == sums
    best = min(abs(sum(sizes) - 2 * sum(s for s, x in zip(sizes, pick) if x))
               for pick in itertools.product((0, 1), repeat=len(sizes)))
    assert best <= sums[0] - sums[1] <= max(max(sizes), best)


def test_sharding_levels(spark):
    rng = random.Random(3)
    sizes = [(str(n), min(40_000, int(rng.paretovariate(1.2) * 100))) for n in range(3000)]
    df = spark.createDataFrame(sizes, "key string, size long")
    got = {r.key: r.shard for r in sharding.shard_groups(
        df, 5, per_bucket=40, fanout=4).collect()}
    assert len(got) == 3000
    totals = Counter()
    for key, size in sizes:
        totals[got[key]] += size
    assert max(totals.values()) - min(totals.values()) <= 0.01 * sum(totals.values())


def test_sharding_of_the_table(spark, sf_small):
    got = QUERIES["op10_sharding"](spark, sf_small).toPandas()
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").toPandas().set_index("doc_id")
    for r in got.itertuples():
        raw = docs.text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert len(got) == len(docs)
    assert got.merge(docs[["text"]], left_on="doc_id", right_index=True).groupby(
        "text")["shard"].nunique().max() == 1
    for _, slots in got.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_sharding_is_as_even_as_differencing_the_whole(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_sharding"](spark, sf).toPandas()
    sums = got.groupby("shard")["size"].sum()
    groups = got.groupby("text_crc32")["size"].sum().tolist()
    # the plain method, all groups at once, on plain lists
    parts = [[s] + [0] * 23 for s in groups]
    while len(parts) > 1:
        parts.sort(key=lambda p: max(p) - min(p))
        a, b = sorted(parts.pop(), reverse=True), sorted(parts.pop())
        parts.append([x + y for x, y in zip(a, b)])
    assert len(sums) == 24 and sums.sum() == sum(groups)
    assert sums.max() - sums.min() <= max(parts[0]) - min(parts[0]) + 1


# -- top k ---------------------------------------------------------------------

def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = rng.integers(-4, 5, (300, 6))
    vectors[100:200] = vectors[7]  # a third are one vector: ties by id
    rows = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vectors)],
                                 "id long, v array<long>")
    got = topk.top_k(rows, F.col("id") % 50 == 0, 5, shard_vectors=40, query_block=3).collect()
    scores = vectors @ vectors.T
    for q in range(0, 300, 50):
        want = sorted(((-scores[q, j], j) for j in range(300) if j != q))[:5]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert mine == [(n + 1, j, -s) for n, (s, j) in enumerate(want)]


def test_top_k_keeps_repeated_rows(spark):
    data = [(0, [1.0]), (1, [1.0]), (1, [1.001]), (2, [0.5])]
    rows = topk.quantised(spark.createDataFrame(data, "vec_id long, v array<double>"),
                          "vec_id", "v")
    got = topk.top_k(rows, F.col("id") % 50 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 65536), (0, 2, 1, 65536), (0, 3, 2, 32768)]


def test_sql(spark):
    from tests.oracle_compare import compare
    sf = "/root/testdata/sf0.01"
    for name, sql in ORACLE_SQL.items():
        got = compare(spark, sf, QUERIES[name](spark, sf), sql)
        assert got["schema_match"] and got["rows_match"], got
