"""The Merkle manifest against a plain tree, and its edge cases."""

import hashlib
import zlib

import pytest

from adlens.llm import manifest

SCHEMA = ("doc_id long, source string, lang string, n_chars long, text string, leaf string, "
          "n long, block long, path string, hash string, g string")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """The root, and for each node its (left, right) siblings, lowest first."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = place - place % 3
            paths[i].append(("".join(nodes[run:place]), "".join(nodes[place + 1:run + 3])))
            at[i] = place // 3
        nodes = [sha(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain_manifest(rows):
    """Sorted (leaf, subroot, root, proof, folded root, verified)."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for name in names:
        group = sorted(groups[name], key=lambda r: (
            r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"])))
        made.append((group, *plain_tree([plain_leaf(r, r["text"]) for r in group])))
    root, tops = plain_tree([subroot for _, subroot, _ in made])
    out = []
    for (group, subroot, paths), top in zip(made, tops):
        for r, path in zip(group, paths):
            found = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                found = found and found.replace("\n", "")
            cur = plain_leaf(r, found)
            for left, right in path + top:
                cur = sha(left, cur, right)
            out.append((r["doc_id"], plain_leaf(r, r["text"]), subroot, root,
                        [tuple(x) for x in path + top], cur, cur == root))
    return sorted(out, key=str)


def row(i, source, text="t", lang="en", n_chars=1):
    return {"doc_id": i, "source": source, "lang": lang, "n_chars": n_chars, "text": text}


def check(spark, rows, **how):
    df = spark.createDataFrame([(*r.values(), "l", 5, 6, "p", "h", "g") for r in rows],
                               SCHEMA).repartition(3)
    got = manifest.manifest(df, **how).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(x) for x in r.path],
                    r.folded_root, r.verified) for r in got), key=str) == plain_manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 82])
def test_one_source(spark, n):
    check(spark, [row(7 * i - 50, "s", f"text {i}\nline") for i in range(n)], digits=2)


@pytest.mark.parametrize("digits", [1, 3])
def test_many_sources(spark, digits):
    rows = [row(i, "hot" if i % 3 else f"src{i % 33}", f"{i}\n" * (i % 4)) for i in range(150)]
    check(spark, rows, digits=digits)


def test_edges(spark):
    long = "word\n" * 100_000
    rows = [row(1, "a"), row(1, "a"), row(1, "a", "other"), row(None, "a", "x\n"),
            row(None, None, None, None, None), row(2, None, ""), row(3, "", long), row(4, "é\n"),
            row(5, "=", "a\n\nb"), row(8, "a", None), row(-9, "a", "\n"), row(6, "z" * 5000)]
    check(spark, rows)
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_change_is_found(spark):
    rows = [row(i, f"s{i % 3}", "no line ends") for i in range(20)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string")
    assert all(r.verified for r in manifest.manifest(df).collect())
    with_lines = df.replace("no line ends", "line\nends")
    got = manifest.manifest(with_lines).collect()
    assert all(r.verified == (zlib.crc32(str(r.doc_id).encode()) % 2 == 1) for r in got)
