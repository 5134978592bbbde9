"""Running totals over blocks, numbering, and bitmap reach against brute force."""

from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from adlens.functions.running import numbered, running_total, splitters
from adlens.operators import reach


def brute(rows):
    out, groups = [], defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    for group in groups.values():
        group.sort(key=lambda r: (r[1] is not None, r[1] or ""))
        total, before = sum(r[2] or 0 for r in group), 0
        for r in group:
            out.append((*r, before, total))
            before += r[2] or 0
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [2, 16, 256])
def test_running_total_with_a_hot_group(spark, blocks):
    rows = [("hot" if i % 3 else f"g{i % 7}", f"k{i * 37 % 2000:04d}", i % 11) for i in range(2000)]
    rows += [(None, "a", 1), (None, None, 5), ("hot", None, 4), ("hot", "", None)]
    df = spark.createDataFrame(rows, "g string, k string, v int").repartition(5)
    got = running_total(df, ["g"], "k", "v", blocks=blocks)
    assert got.columns == ["g", "k", "v", "before", "total"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_running_total_of_few_and_of_no_rows(spark):
    one = spark.createDataFrame([("g", "k", 3)], "g string, k string, v int")
    assert [tuple(r) for r in running_total(one, ["g"], "k", "v").collect()] == [("g", "k", 3, 0, 3)]
    assert running_total(one.limit(0), ["g"], "k", "v").collect() == []
    nulls = spark.createDataFrame([("g", None, None)], "g string, k string, v int")
    assert [tuple(r) for r in running_total(nulls, ["g"], "k", "v").collect()] == [
        ("g", None, None, 0, None)]


def test_a_hot_group_is_cut_into_even_blocks(spark):
    df = spark.range(20_000).selectExpr("concat('k', lpad(id, 6, '0')) AS k")
    cuts = sorted(df.limit(1).select(splitters(df, "k", 16).alias("c")).first().c)
    assert len(cuts) == 15
    sizes = [b - a for a, b in zip([0, *(int(c[1:]) for c in cuts)],
                                   [*(int(c[1:]) for c in cuts), 20_000])]
    assert max(sizes) < 2 * 20_000 / 16 and min(sizes) > 0


def test_numbers_have_no_gaps_and_follow_the_key(spark):
    df = spark.range(5000).selectExpr("md5(CAST(id AS STRING)) AS k", "id")
    rows = numbered(df, "k", blocks=32).orderBy("k").collect()
    assert [r.number for r in rows] == list(range(5000))


@pytest.fixture(scope="module")
def shown(spark):
    """40,000 subscribers (over one bitmap), a hot campaign-day, an unknown subscriber."""
    subs = spark.range(40_000).selectExpr("md5(CAST(id AS STRING)) AS subscriber_key")
    facts = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 5) END AS campaign_key",
        "CASE WHEN id % 3 = 0 THEN 20240101 ELSE 20240101 + CAST(id % 20 AS INT) END AS date_key",
        "md5(CAST(id * 7919 % 40000 AS STRING)) AS subscriber_key")
    lost = spark.createDataFrame([("c1", 20240101, "nobody")], facts.schema)
    return facts.unionAll(lost).repartition(6), subs


def test_reach_equals_distinct_counts_on_every_level(spark, shown):
    facts, subs = shown
    bitmaps = reach.reach_bitmaps(facts, subs, ["campaign_key", "date_key"])
    assert bitmaps.agg({"bucket": "max"}).first()[0] >= 1
    known = facts.filter("subscriber_key <> 'nobody'")
    for by in (["campaign_key", "date_key"], ["campaign_key"], ["date_key"], []):
        got = {tuple(r)[:-1]: r.reach for r in reach.reach(bitmaps, by).collect()}
        want = {tuple(r)[:-1]: r.n for r in known.groupBy(*by).agg(
            F.count_distinct("subscriber_key").alias("n")).collect()}
        assert got == want, by


def test_weekly_reach_is_merged_from_days(spark, shown):
    facts, subs = shown
    days = [(20240101 + i, date(2024, 1, 1 + i)) for i in range(20)]
    dim_date = spark.createDataFrame(days, "date_key int, full_date date")
    daily = reach.reach_bitmaps(facts, subs, ["date_key"])
    got = {r.week_start: r.reach for r in reach.weekly_reach(daily, dim_date).collect()}
    want = defaultdict(set)
    for r in facts.filter("subscriber_key <> 'nobody'").collect():
        want[date(2024, 1, 1 + (r.date_key - 20240101) // 7 * 7)].add(r.subscriber_key)
    assert got == {k: len(v) for k, v in want.items()}
    assert sum(r.reach for r in reach.reach(daily, ["date_key"]).collect()) > sum(got.values())


def test_large_subscriber_tables_give_the_same_reach(spark, shown, monkeypatch):
    facts, subs = shown
    small = reach.reach(reach.reach_bitmaps(facts, subs, ["date_key"]), ["date_key"]).collect()
    monkeypatch.setattr(reach, "is_small", lambda df: False)
    large = reach.reach(reach.reach_bitmaps(facts, subs, ["date_key"]), ["date_key"]).collect()
    assert sorted(small) == sorted(large)


def test_sets_of_sparse_groups_are_words_aggregated_by_hash(spark, capsys):
    """Ten groups of one subscriber each hold ten words; no sort of bitmaps."""
    subs = spark.range(1000).selectExpr("md5(CAST(id AS STRING)) AS subscriber_key")
    facts = spark.range(10).selectExpr("id AS date_key", "md5(CAST(id * 97 AS STRING)) AS subscriber_key")
    words = reach.reach_bitmaps(facts, subs, ["date_key"])
    assert dict(words.dtypes)["people"] == "bigint" and words.count() == 10
    out = reach.reach(words, [])
    assert out.first().reach == 10
    capsys.readouterr()
    out.explain()
    assert "SortAggregate" not in capsys.readouterr().out
