"""Trained operators: gradients, held-out accuracy; the pipeline as a whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adlens.llm import decontamination, jaccard, quality, secret_scan, urls
from adlens.llm.catalog import QUERIES

SF = "/root/testdata/sf0.1"


def test_gradients():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(9, quality.WIDTH)) * 0.1
    bag, y = np.array([0, 0, 1, 1, 1, 2, 3, 3, 3]), np.array([1.0, 0.0, 1.0, 0.0])
    p = {"W": rng.normal(size=(quality.WIDTH, 3)), "b": rng.normal(size=3),
         "V": rng.normal(size=(3, 2)), "U": rng.normal(size=(3, 2)), "a": rng.normal(size=2),
         "c": rng.normal(size=3), "d": rng.normal(size=1)}

    def loss():
        one = np.ones(x.shape[1])
        s = quality.Model(0 * one, one, p).score(x, bag, 4)
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    grads = quality._gradients(p, x, bag, y)
    for k, g in grads.items():
        for i in list(np.ndindex(g.shape))[:4]:
            old = p[k][i]
            p[k][i] = old + 1e-6
            up = loss()
            p[k][i] = old - 1e-6
            down = loss()
            p[k][i] = old
            assert abs((up - down) / 2e-6 - g[i]) < 1e-5, (k, i)


def test_quality_on_held_out(spark):
    got = QUERIES["op7_quality"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    both = got[got.held_out].merge(labels, on="doc_id")
    good, bad = both[both.quality == 1].score, both[both.quality == 0].score
    ahead = (good.to_numpy()[:, None] > bad.to_numpy()).mean()
    assert ahead > 0.9, ahead
    assert (both.predicted == both.quality).mean() > 0.93


def test_urls_on_held_out(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    parts = [urls.judge_urls(pages, rules=urls.RULES, learn_from=F.crc32("url") % 3 != 0)]
    held = pages.where(F.crc32("url") % 3 == 0).select("page_id")
    got = parts[0].where("rule is not null").join(held, "page_id").toPandas()
    # the trees alone, on urls that the rules label and none was trained on
    assert len(got) > 300
    agree = ((got.score >= 0.5) == (got.verdict == "block")).mean()
    assert agree > 0.9, agree
    seen = parts[0].toPandas()
    raw = {r.page_id: r.url for r in pages.collect()}
    for r in seen.itertuples():
        rest = raw[r.page_id].split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        path = rest[cut:]
        for c in "?#":
            path = path.split(c)[0]
        assert (r.host, r.path) == (rest[:cut].lower(), path)
        fits = [u for u in urls.RULES if (r.host == u.host or r.host.endswith("." + u.host))
                and r.path.startswith(u.path)]
        best = max(fits, key=lambda u: len(u.pattern), default=None)
        assert (None if best is None else best.pattern) == (
            r.rule if isinstance(r.rule, str) else None)


def test_urls_of_many_copies(spark):
    data = ["http://x.com/de/copied"] * 60
    data += [f"http://s{n}.com/de/page{n}" for n in range(20)]
    data += [f"http://s{n}.org/page{n}" for n in range(20)]
    pages = spark.createDataFrame([(n, u) for n, u in enumerate(data)], "page_id long, url string")
    got = urls.judge_urls(pages, train_urls=20).toPandas()
    score = got.groupby("verdict").score
    assert score.max()["allow"] < 0.5 < score.min()["block"]


def test_long_texts_are_learnt_whole(spark):
    # the label rests on one passage of many, wherever it stands
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for n in range(240):
        parts = ["plain words of a text " * 30 for _ in range(60)]
        if n % 2:
            parts[rng.integers(60)] = "%$#@ 0101 ~~ " * 50
        rows.append((n, "".join(parts)))
        marks.append((n, n % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score_documents(docs, model).toPandas()
    assert ((got.score >= 0.5) == (got.doc_id % 2 == 1)).mean() > 0.95
    # a budget that holds few documents still takes whole ones
    few = quality.fit(docs, labels, train_passages=1_400)
    assert (few.mean > 0).any()


def test_url_suffixes_outside_the_sample(spark):
    # the verdict follows the first part of the path, and names tell nothing else
    rng = np.random.default_rng(5)
    parts = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(80)]
    verdict = {p: ("block", "allow")[n % 2] for n, p in enumerate(parts)}
    rules = tuple(urls.UrlRule(f"a.com/{p}/", v) for p, v in verdict.items())
    data = [(f"http://a.com/{p}/{n:03}",) for p in parts for n in range(50)]
    data += [(f"http://b.com/{p}/777",) for p in parts]
    pages = spark.createDataFrame(data, "url string").withColumn("page_id", F.col("url"))
    got = urls.judge_urls(pages, rules, train_urls=120).where("rule is null").collect()
    assert {r.page_id.split("/")[3]: r.verdict for r in got} == verdict


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], sf_small).cache())
    return out


def test_pipeline(spark, sf_small, stages):
    start, good, one, clean, safe, packed = [s.toPandas() for s in stages]
    scores = quality.score_documents(stages[0], quality.fit(
        stages[0], spark.read.parquet(f"{sf_small}/labels.parquet"))).toPandas()
    assert set(good.doc_id) == set(scores[scores.score >= 0.5].doc_id)
    linked = jaccard.link_documents(stages[1], 80, 5).toPandas()
    assert set(one.doc_id) == set(linked.component_id)
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet").toPandas()
    fold = lambda t: " ".join(t.lower().split())
    leaks = {d.doc_id for d in one.itertuples() if any(
        fold(b) in fold(d.text) for b in bench.text)}
    assert leaks & set(clean.doc_id) == set() and set(clean.doc_id) <= set(one.doc_id)
    found = {r.doc_id: r.matches for r in decontamination.find_leaks(
        stages[2], spark.read.parquet(f"{sf_small}/benchmark.parquet")).collect()}
    assert set(clean.doc_id) == {i for i, m in found.items() if not m}
    assert set(safe.doc_id) == set(clean.doc_id)
    assert not any(r.spans for r in secret_scan.find_secrets(stages[4]).collect())
    assert (safe.n_chars == safe.text.str.len()).all()
    assert set(packed.doc_id) == set(safe.doc_id)
    run = corpus_pipeline.run(spark, sf_small).toPandas()
    # blocks follow the files that a stage reads, so only the pieces are compared
    pieces = ["doc_id", "piece", "start", "n_tokens"]
    assert sorted(run[pieces].itertuples(index=False, name=None)) == sorted(
        packed[pieces].itertuples(index=False, name=None))
