"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names, for every operator and every pipeline stage."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adlens.llm import (decontamination, jaccard, packing, pii, quality, repeats, secret_scan,
                        sharding, topk, urls)
from adlens.llm.common import read

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, node string, "
          "spans string, row string, id string, body string, score double, matches int")
LONG = " ".join(f"word{n % 977}x{n}" for n in range(30_000))
PASSAGE = " ".join(f"passage{n}" for n in range(60))


def rows():
    texts = [(1, PASSAGE), (1, PASSAGE), (None, PASSAGE), (2, None), (3, ""), (4, " \t\n"),
             (5, LONG), (6, "one"), (7, "one"), (None, None), (8, "two words"),
             (9, "before " + PASSAGE + " after"), (10, "é" * 300)]
    return [(i, t, None, None, None, "n", "s", "r", "i", "b", 0.5, 1) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_secrets(docs, empty):
    got = secret_scan.find_secrets(docs).collect()
    assert len(got) == 13 and not any(r.spans for r in got)
    assert secret_scan.find_secrets(empty).count() == 0
    assert secret_scan.without_secrets(empty).columns == empty.columns
    assert sorted(map(str, secret_scan.without_secrets(docs).collect())) == sorted(
        map(str, docs.collect()))


def test_pii(docs, empty):
    assert pii.find_pii(docs).count() == 13 and pii.find_pii(empty).count() == 0


def test_packing(docs, empty):
    got = packing.pack_documents(packing.token_counts(docs)).collect()
    counts = packing.token_counts(docs).collect()
    assert sum(r.n_tokens for r in got) == sum(r.n_tokens for r in counts) and len(counts) == 13
    assert sum(r.doc_id == 1 for r in got) == 2 and sum(r.doc_id is None for r in got) == 2
    assert sum(r.doc_id == 5 for r in got) > 5
    assert packing.packed_sequences(empty).count() == 0


def test_repeats(docs, empty):
    got = repeats.remove_repeats(docs).collect()
    assert len(got) == 13
    by_id = {r.doc_id: r for r in got}
    assert all(r.kept == b"" for r in got if r.doc_id in (1, 2, 3))
    assert bytes(by_id[9].kept) == b"before  after"[:7] + b" after"
    assert by_id[10].removed[0].end == 600 and by_id[5].removed == []
    assert bytes(by_id[5].kept) == LONG.encode()
    assert repeats.remove_repeats(empty).count() == 0


def test_urls(spark):
    schema = "page_id long, url string, host string, path string, label int, fit int"
    data = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.Org/x?y#z"),
            (5, "HTTP://A.Org/x?y#z"), (None, "http://b.com/de/1"), (6, "http://c.com/fr/" + "a" * 9000),
            (7, "http://example.org/es/"), (8, "http://notexample.org/es/"), (9, "http://org")]
    df = spark.createDataFrame([(i, u, "h", "p", 1, 2) for i, u in data], schema)
    got = urls.judge_urls(df).collect()
    assert len(got) == 11
    by = {r.page_id: r for r in got}
    assert (by[1].host, by[1].path, by[1].rule) == ("", "", None) and by[1].verdict
    assert (by[4].host, by[4].path) == ("", "")
    assert (by[5].host, by[5].path, by[5].rule, by[5].verdict) == ("a.org", "/x", "org/", "allow")
    assert (by[None].rule, by[None].verdict) == ("com/de/", "block")
    assert by[6].rule == "com/fr/" and by[7].rule == "example.org/es/"
    assert by[8].rule == "org/" and by[9].rule is None and by[9].path == ""
    assert urls.judge_urls(spark.createDataFrame([], schema)).count() == 0
    one_class = urls.judge_urls(df.where("page_id = 5")).collect()
    assert [r.verdict for r in one_class] == ["allow", "allow"]


def test_decontamination(spark, docs, empty):
    bench = spark.createDataFrame(
        [(1, PASSAGE, 0), (1, PASSAGE, 0), (2, None, 0), (None, "", 0), (3, "short", 0)],
        "item_id long, text string, matches int")
    got = decontamination.find_leaks(docs, bench).collect()
    assert len(got) == 13
    assert sorted(str(r.doc_id) for r in got if r.matches) == ["1", "1", "9", "None"]
    assert all(len(r.matches) <= 1 for r in got)
    assert decontamination.find_leaks(empty, bench).count() == 0
    assert not any(r.matches for r in decontamination.find_leaks(docs, bench.limit(0)).collect())
    kept = decontamination.without_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == 9


def test_jaccard(docs, empty):
    got = jaccard.link_documents(docs).collect()
    assert len(got) == 13
    by = {r.doc_id: r for r in got}
    assert by[6].component_id == by[7].component_id == 6
    assert [r.component_id for r in got if r.doc_id is None] == [1, None] or [
        r.component_id for r in got if r.doc_id is None] == [None, 1]
    assert by[9].component_id == 1  # all but a few shingles are shared
    assert [by[i].n_shingles for i in (2, 3, 4, 8)] == [0, 0, 0, 1]
    assert [by[i].component_id for i in (2, 3, 4, 8)] == [2, 3, 4, 8]
    assert jaccard.link_documents(empty).count() == 0
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        ["1", "2", "3", "4", "5", "6", "8", "10", "None", "None"])


def test_one_of_each_with_repeated_ids(spark):
    words = lambda n: " ".join(f"{n}w{i}" for i in range(40))
    data = [(1, words("a")), (2, words("a")), (2, words("b")), (2, words("b")), (2, None),
            (2, ""), (2, words("b") + " more"), (3, words("b")), (3, words("c")),
            (None, words("a"))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(docs).collect()), key=str)
    b = [(i, t) for i, t in got if t in (words("b"), words("b") + " more")]
    assert len(b) == 1 and b[0][0] == 2
    assert sorted((x for x in got if x not in b), key=str) == sorted(
        [(1, words("a")), (2, None), (2, ""), (3, words("c")), (None, words("a"))], key=str)


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 0, 0), (5, 0, 1), (6, 1, None), (7, None, 1), (None, 1, 1), (99, 0, 0)],
        "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = quality.score_documents(docs, model).collect()
    assert len(got) == 13 and all(0 <= r.score <= 1 for r in got)
    assert quality.score_documents(empty, model).count() == 0
    flat = quality.fit(empty, labels.limit(0))
    assert len({round(r.score, 6) for r in quality.score_documents(docs, flat).collect()}) == 1


def test_top_k(spark):
    inf, nan = float("inf"), float("nan")
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None),
            (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, []),
            (50, [0.0, -1.0]), (8, [-1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, v array<double>, id int")
    rows = topk.quantised(df, "vec_id", "v")
    asked = F.col("id") % 50 == 0
    got = topk.top_k(rows, asked).orderBy("query_id", "rank").collect()
    # each of the two rows of id 0 asks, and finds the other; a null id comes last
    first = [(r.vec_id, r.score) for r in got if r.query_id == 0]
    ranked = [(0, 65536), (1, 65536), (2, 65536), (None, 65536), (7, 0)]
    assert first == [x for x in ranked for _ in (0, 1)]
    assert topk.top_k(rows.limit(0), asked).count() == 0
    assert topk.top_k(rows, F.lit(False)).count() == 0
    assert topk.top_k(rows.where("id in (1, 50)"), asked).count() == 1


def test_sharding(docs, empty):
    got = sharding.shard_documents(docs, 3).collect()
    assert len(got) == 13
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    none = [r for r in got if r.doc_id == 2][0]
    assert (none.size, none.text_crc32) == (8, 0)
    assert sharding.shard_documents(empty).count() == 0


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, docs):
    base = str(tmp_path_factory.mktemp("tables"))
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(
        f"{base}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{base}/labels.parquet")
    spark.createDataFrame([(1, "benchmark item " * 9)], "item_id long, text string").write.parquet(
        f"{base}/benchmark.parquet")
    return base


def test_stages(spark, folder):
    docs = read(spark, folder, "documents")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, folder)
            assert out.columns == docs.columns, name
            assert out.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, table, folder).count() >= table.count()


def test_extra_columns_reach_the_output(spark, docs):
    for out in (decontamination.without_leaks(docs, docs.select(
            F.lit(1).alias("item_id"), F.lit("nothing of the kind").alias("text")).limit(1)),
            secret_scan.without_secrets(docs)):
        assert out.columns == docs.columns and out.count() == 13


def test_digest_of_no_spans(spark, docs, tmp_path):
    docs.where("text is null or text = ''").write.parquet(str(tmp_path / "documents.parquet"))
    for query in (secret_scan.op1_secret_scan, pii.op9_pii):
        got = query(spark, str(tmp_path)).collect()
        assert len(got) == 3 and all(r.spans == "" for r in got)
        assert {r.base_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()}

