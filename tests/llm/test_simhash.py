"""SimHash classes against brute force, and their edge cases."""

import random

import pytest
import xxhash

from adlens.llm import simhash

LONG = " ".join(f"word{n % 977}x{n}" for n in range(200_000))


def plain_fingerprint(text, words=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\f\r":
            found += [word] if word else []
            word = ""
        else:
            word += c
    if not found:
        return 0
    many = max(1, len(found) - words + 1)
    hashes = [xxhash.xxh64(" ".join(found[i:i + words]).encode(), seed=42).intdigest()
              for i in range(many)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > many)


def classes(prints, distance=3):
    """The least reachable index of each, comparing all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clusters(seed):
    """Chains and clouds of near values, and values one bit too far."""
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        out.add(centre)
        for _ in range(rng.randint(0, 30)):
            near = centre
            for b in rng.sample(range(64), rng.randint(1, 5)):
                near ^= 1 << b
            out.add(near)
            if rng.random() < 0.2:
                centre = near
    return sorted(out)


@pytest.mark.parametrize("group", [4096, 2])
@pytest.mark.parametrize("distance", [3, 2])
def test_classes_against_all_pairs(spark, distance, group):
    values = clusters(distance)
    df = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long").repartition(3)
    got = {r.fingerprint: r.root for r in simhash.fingerprint_classes(
        df, distance, group).collect()}
    want = classes(values, distance)
    assert len(got) == len(values)
    same = {}
    for v, c in zip(values, want):
        assert same.setdefault(c, got[signed(v)]) == got[signed(v)]
    assert len(set(same.values())) == len(same)


def test_every_link_shares_a_variant():
    rng = random.Random(5)
    for distance in (1, 2, 3, 4, 5):
        masks = simhash.variant_masks(distance)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), distance):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


def test_shingles_across_pieces(monkeypatch):
    text = "Ünï Café " + " ".join(f"w{n % 50}" for n in range(400)) + "\x0bEND\n"
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PIECE_BYTES", 7)
    assert simhash.fingerprint(text.encode()) == whole == signed(plain_fingerprint(text))
    assert simhash.fingerprint(b" a  B ") == signed(plain_fingerprint("a b"))


def test_documents(spark):
    base = [f"term{n}" for n in range(400)]
    texts = {1: " ".join(base), 2: " ".join(base[:200] + ["changed"] + base[201:]),
             3: None, 4: "", 5: " \t\n", 6: "one", 7: "ONE", 8: "two words", 9: LONG,
             10: "É é", 11: " ".join(base)}
    rows = [(i, t, "r", "f", 1) for i, t in texts.items()]
    rows += [(None, texts[1], "r", "f", 1), (1, texts[1], "r", "f", 1),
             (None, "alone here", "r", "f", 1)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, row string, fingerprint string, root int")
    got = simhash.link_documents(df).collect()
    assert len(got) == len(rows)
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = dict(zip(prints, [list(prints)[k] for k in classes(list(prints.values()))]))
    for r in got:
        if r.doc_id is not None:
            assert r.fingerprint == f"{prints[r.doc_id]:016x}"
            assert r.component_id == want[r.doc_id]
    assert want[11] == 1 and want[4] == want[5] == 3 and want[7] == 6
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["1", "None"]
    assert simhash.link_documents(df.where("doc_id < 0")).count() == 0


def test_query(spark, sf_small):
    got = simhash.op11_simhash(spark, sf_small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(
        f"{sf_small}/documents.parquet").collect()}
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    want = {i: (f"{p:016x}", ids[c]) for i, p, c in zip(ids, prints, classes(prints))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
