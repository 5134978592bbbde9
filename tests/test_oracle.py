"""Registered queries against their DuckDB oracles on the smallest test tables,
and the driver entry points."""

import pytest

import __spark_entry__ as entry_mod
from oracle_compare import compare, duck

KEYS = [
    "fct_campaign_daily", "mart_platform_health", "mart_campaign_performance",
    "mart_advertiser_summary", "mart_advertiser_concentration", "mart_frequency_analysis",
    "mart_content_monetization", "dq_report", "recon_pacing_ratio", "recon_rpsh",
    "weighted_allocation", "in_flight_candidates", "metric_labels", "optional_number",
    "report_advertiser_summary", "delivery_ratio_spread", "dim_date_ads", "expand_sessions", "latest_campaign_pacing", "kpi_bands",
]


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, con, key):
    df = entry_mod.queries()[key](spark, sf_small)
    r = compare(spark, sf_small, df, entry_mod.oracle_sql()[key], con)
    assert r["schema_match"], r
    assert r["rows_match"], r


def test_every_oracle_has_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def test_entry_smoke(spark, sf_small):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "pacing_status" in df.columns


def test_reconciliations_pass_on_test_tables(spark, sf_small):
    q = entry_mod.queries()
    for key in ["recon_revenue_share", "recon_elapsed_days", "recon_hhi", "recon_filled",
                "recon_pacing_ratio", "recon_pacing_status", "recon_platform_health", "recon_rpsh"]:
        assert q[key](spark, sf_small).filter("NOT passed").count() == 0, key


def test_full_build_reports_the_known_data_breaches(spark, sf_small):
    """The test tables contain impressions before their flight (negative
    elapsed days and ratios) and request-only days (null completion); the
    build must surface exactly those and fail."""
    import tempfile
    from adlens.plans.build import build
    from adlens.sources.testdata import bind_testdata
    raw = bind_testdata(spark, sf_small)
    out = tempfile.mkdtemp(prefix="adlens-build-", dir="/tmp")
    result = build(spark, raw, out_dir=out, fail_on_error=False)
    failing = {(r.model, r.check_name, r.column_name)
               for r in result.checks.filter("failures > 0").collect()}
    assert failing == {
        ("mart_platform_health", "not_null", "completion_rate_pct"),
        ("mart_platform_health", "not_null", "viewability_rate_pct"),
        ("mart_campaign_performance", "accepted_range", "elapsed_days"),
        ("mart_campaign_performance", "accepted_range", "budget_pacing_ratio"),
    }
    assert result.reconciliations.filter("failing_rows > 0").count() == 0
    from adlens.plans.publish import published
    tables = published(spark, out)
    assert tables["fct_campaign_daily"].count() > 0
    listed = {(r.model, r.check_name, r.column_name): r["count"] for r in tables[
        "dq_failing_rows"].groupBy("model", "check_name", "column_name").count().collect()}
    assert listed == {(r.model, r.check_name, r.column_name): r.failures
                      for r in result.checks.filter("failures > 0").collect()}
    assert tables["recon_failing_rows"].count() == 0
    from adlens.operators.quality import assert_clean
    with pytest.raises(AssertionError, match="elapsed_days"):
        assert_clean(result.checks)


def test_two_data_folders_in_one_session_do_not_collide(spark, sf_small):
    """Warehouses over different folders keep separate written tables."""
    q = entry_mod.queries()
    small = q["stg_ad_impressions"](spark, sf_small).count()
    other = "/root/testdata/sf0.01"
    import os
    if not os.path.exists(f"{other}/lineitem.parquet"):
        pytest.skip("second folder not present")
    bigger = q["stg_ad_impressions"](spark, other).count()
    assert q["stg_ad_impressions"](spark, sf_small).count() == small < bigger


def test_report_reads_are_named_and_ordered(spark, sf_small):
    from adlens.operators.report import REPORTS, fetch
    from adlens.plans.catalog import wh
    w = wh(spark, sf_small)
    with pytest.raises(KeyError):
        fetch(w, "no_such_report")
    days = [r.full_date for r in fetch(w, "platform_health").select("full_date").collect()]
    assert days == sorted(days) and len(days) > 0
    spend = [r.total_spend for r in fetch(w, "advertiser_summary").select("total_spend").collect()]
    assert spend == sorted(spend, reverse=True)
    assert set(REPORTS) == {"platform_health", "campaign_performance", "frequency_analysis",
                            "advertiser_summary", "advertiser_concentration"}
