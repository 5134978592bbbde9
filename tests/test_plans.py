"""Plan shape of the headline queries: filters reach the scans, scans read
only the needed columns, bounded dimensions are broadcast, and no query plans
a cartesian product or nested-loop join."""

import re

import pytest

import __spark_entry__ as entry_mod
from adlens.sources.testdata import TestdataBinding

ALL_KEYS = sorted(entry_mod.queries())


def formatted(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def scans(plan: str) -> list[str]:
    """The detail blocks of the parquet scans in a formatted plan."""
    return [b for b in re.split(r"\n\(\d+\) ", plan) if b.startswith("Scan parquet")]


def test_binding_pushes_the_fill_filter_and_prunes_lineitem(spark, sf_small, capsys):
    plan = formatted(TestdataBinding(spark, sf_small).ad_impressions(), capsys)
    li = [s for s in scans(plan) if "l_orderkey" in s]
    assert li, plan
    assert "GreaterThanOrEqual(l_discount,0.02)" in li[0]
    schema = re.search(r"ReadSchema: struct<([^>]*)>", li[0]).group(1)
    for unused in ("l_comment", "l_tax", "l_receiptdate", "l_commitdate", "l_shipmode"):
        assert unused not in schema
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_marts_read_only_the_fact_columns_they_use(spark, sf_small, capsys):
    plan = formatted(entry_mod.queries()["mart_frequency_analysis"](spark, sf_small), capsys)
    fact = [s for s in scans(plan) if "fct_ad_impressions" in s]
    assert fact, plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", fact[0]).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"subscriber_key", "campaign_key"}


def test_star_join_broadcasts_bounded_dimensions(spark, sf_small, capsys):
    from adlens.plans.catalog import wh
    from adlens.operators import facts
    w = wh(spark, sf_small)
    df = facts.fct_ad_impressions(
        w.stg["stg_ad_impressions"], w.dim_campaigns, w.dim_advertisers, w.dim_subscribers,
        w.dim_content, w.dim_ad_slots, w.dim_date_ads)
    plan = formatted(df, capsys)
    assert len(re.findall(r"BroadcastHashJoin Inner", plan)) >= 6
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("key", ALL_KEYS)
def test_no_cartesian_or_nested_loop_join(spark, sf_small, capsys, key):
    plan = formatted(entry_mod.queries()[key](spark, sf_small), capsys)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_candidates_read_the_requests_once_and_shuffle_no_campaign_day(spark, sf_small, capsys):
    """The days' scan is shared by the lookup and the sweep; flights meet the days
    by a broadcast; the running budgets shuffle by block, not by day alone."""
    import re
    from adlens.operators import prep
    from adlens.plans.catalog import wh
    w = wh(spark, sf_small)
    days = w.raw["ad_requests"].filter("was_filled").select("request_timestamp").selectExpr(
        "to_date(request_timestamp) AS day")
    cand = prep.in_flight_candidates(days, w.raw["campaigns"], strict=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")     # reuse shows in the plan
    try:
        joined = formatted(cand, capsys)
        sliced = formatted(prep.allocation_slices(cand), capsys)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for plan in (joined, sliced):
        assert len([s for s in scans(plan) if "l_orderkey" in s]) == 1
    exchanged = re.findall(r"\n\(\d+\) Exchange\n.*\n?.*\n?Arguments: (\S+\([^)]*\))", joined)
    assert not any("campaign_id" in x or "hashpartitioning(day" in x for x in exchanged)
    assert re.search(r"hashpartitioning\(day#\d+, _block#\d+", sliced)


def test_report_scans_each_fact_at_most_twice(spark, sf_small, capsys):
    from adlens.operators import quality
    from adlens.plans.catalog import wh
    facts = ["fct_ad_impressions", "fct_viewing_sessions", "fct_campaign_daily"]
    plan = formatted(quality.run_checks(wh(spark, sf_small).model, models=facts), capsys)
    for fact in facts:
        assert 1 <= len([s for s in scans(plan) if fact in s]) <= 2, fact


def test_star_join_query_writes_only_its_fact(spark, sf_small):
    """Activity tables are scanned lazily: no raw table is copied."""
    import os
    from adlens.plans.catalog import wh
    from adlens.session import ensure_checkpoint_dir
    entry_mod.queries()["mart_platform_health"](spark, sf_small).count()
    written = os.listdir(os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "adlens-tables"))
    assert not [name for name in written if name.startswith("raw_")]
    assert not wh(spark, sf_small).raw["ad_requests"].is_cached
