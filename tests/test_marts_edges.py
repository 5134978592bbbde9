"""Edge cases of the metric semantics on hand-made frames."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from adlens.functions.metrics import pacing_ratio, pacing_status
from adlens.operators import facts, marts

D = Decimal


def _pacing(spark, rows):
    df = spark.createDataFrame(rows, "spend decimal(38,6), budget decimal(12,2), "
                                     "elapsed int, flight smallint")
    r = df.select(pacing_ratio("spend", "budget", "elapsed", "flight").alias("r"))
    return [(x.r, x.s) for x in r.select("r", pacing_status("r").alias("s")).collect()]


def test_pacing_edges(spark):
    got = _pacing(spark, [
        (D("50"), D("0"), 5, 10),          # no budget -> UNKNOWN
        (D("50"), D("100"), 5, 0),         # no flight length -> spend / budget
        (D("50"), D("100"), 0, 10),        # day before flight -> UNKNOWN
        (D("10"), D("100"), -1, 10),       # before the flight -> negative ratio
        (D("100"), D("100"), 10, 10),      # last day
        (D("110"), D("100"), 15, 10),      # after the flight: progress capped at 1
        (D("89.95"), D("100"), 10, 10),    # 0.8995 rounds to 0.900 -> ON_PACE
        (D("89.94"), D("100"), 10, 10),    # 0.8994 -> 0.899 -> UNDER
        (D("110.05"), D("100"), 10, 10),   # 1.1005 -> 1.101 -> OVER
        (D("50"), D("100"), 5, None),      # null flight -> spend / budget
    ])
    assert got == [
        (None, "UNKNOWN"),
        (D("0.500"), "UNDER_PACING"),
        (None, "UNKNOWN"),
        (D("-1.000"), "UNDER_PACING"),
        (D("1.000"), "ON_PACE"),
        (D("1.100"), "ON_PACE"),
        (D("0.900"), "ON_PACE"),
        (D("0.899"), "UNDER_PACING"),
        (D("1.101"), "OVER_PACING"),
        (D("0.500"), "UNDER_PACING"),
    ]


def _dates(spark, days):
    return spark.createDataFrame([(int(d.strftime("%Y%m%d")), d) for d in days],
                                 "date_key int, full_date date")


IMP_SCHEMA = ("impression_id string, campaign_key string, advertiser_key string, "
              "subscriber_key string, content_key string, date_key int, "
              "revenue_usd decimal(12,6), is_viewable boolean, completed boolean, "
              "view_duration_sec smallint")


def test_platform_health_full_outer_days(spark):
    a, b, c = date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)
    req = spark.createDataFrame([("r1", datetime(2026, 1, 1, 10))],
                                "request_id string, request_timestamp timestamp_ntz")
    imp = spark.createDataFrame([("i1", "c", "a", "s", "t", 20260102, D("0.010000"), True, False, 5)],
                                IMP_SCHEMA)
    ses = spark.createDataFrame([(20260103, 3600)], "date_key int, watch_seconds int")
    h = {r.date_key: r for r in
         marts.mart_platform_health(req, imp, ses, _dates(spark, [a, b, c])).collect()}
    assert set(h) == {20260101, 20260102}          # viewing-only day is absent
    ra, rb = h[20260101], h[20260102]
    assert (ra.total_requests, ra.total_impressions, ra.fill_rate_pct) == (1, 0, D("0.0"))
    assert ra.ecpm_usd is None and ra.completion_rate_pct is None
    assert ra.viewing_hours == D("0.0") and ra.revenue_per_subscriber_hour is None
    assert (rb.total_requests, rb.total_impressions, rb.fill_rate_pct) == (0, 1, None)
    assert rb.ecpm_usd == D("10.00") and rb.viewability_rate_pct == D("100.0")


def test_concentration_band_uses_unrounded_hhi(spark):
    def run(shares):
        df = spark.createDataFrame([(D(s),) for s in shares], "revenue_share_pct decimal(18,2)")
        r = marts.mart_advertiser_concentration(df).first()
        return r.hhi, r.concentration_band
    assert run(["38.72", "0.86"]) == (D("1500.0"), "DIVERSIFIED")   # 1499.978
    assert run(["30", "20", "10", "10"]) == (D("1500.0"), "MODERATE")
    assert run(["50"]) == (D("2500.0"), "CONCENTRATED")


def test_frequency_cap_is_strict(spark):
    rows = [(f"i{k}", "c1", "a", sub, "t", 20260101, D("0.01"), True, True, 5)
            for sub, n in [("s_at_cap", 2), ("s_over", 3)] for k in range(n)]
    imp = spark.createDataFrame([(f"{r[0]}-{r[3]}",) + r[1:] for r in rows], IMP_SCHEMA)
    cmp = spark.createDataFrame([("c1", "Camp", 2)], "campaign_key string, campaign_name string, "
                                                     "frequency_cap smallint")
    r = marts.mart_frequency_analysis(imp, cmp).first()
    assert (r.total_subscribers, r.subscribers_exceeding_cap, r.total_violations) == (2, 1, 1)
    assert r.violation_rate_pct == D("50.0") and r.avg_frequency == D("2.5")


def test_cumulative_spend_and_calendar_elapsed_days(spark):
    imp = spark.createDataFrame([
        ("i1", "c1", "a", "s1", "t", 20260101, D("1.000000"), True, True, 5),
        ("i2", "c1", "a", "s2", "t", 20260103, D("2.000000"), True, True, 5),   # gap day
    ], IMP_SCHEMA)
    cmp = spark.createDataFrame([("c1", D("30.00"), 3, date(2026, 1, 1))],
                                "campaign_key string, total_budget_usd decimal(12,2), "
                                "flight_days smallint, flight_start date")
    dt = _dates(spark, [date(2026, 1, d) for d in (1, 2, 3)])
    rows = facts.fct_campaign_daily(imp, cmp, dt).orderBy("date_key").collect()
    assert [r.cumulative_spend for r in rows] == [D("1.000000"), D("3.000000")]
    assert [r.elapsed_days for r in rows] == [1, 3]          # calendar, not delivery days
    assert [r.budget_pacing_ratio for r in rows] == [D("0.100"), D("0.100")]


def test_advertiser_summary_active_only_and_hhi_of_rounded_shares(spark):
    """E5: an advertiser without impressions is absent (inner join), so the
    count is of active advertisers. E4: HHI squares the 2-dp shares."""
    imp = spark.createDataFrame([
        (f"i{k}", f"c{k}", adv, "s", "t", 20260101, D("1.000000"), True, k % 2 == 0, 5)
        for k, adv in enumerate(["a1", "a2", "a3"])], IMP_SCHEMA)
    adv = spark.createDataFrame(
        [(a, a, a, "Retail", "mid", "US") for a in ["a1", "a2", "a3", "a_idle"]],
        "advertiser_key string, advertiser_id string, company_name string, "
        "industry_vertical string, spend_tier string, country string")
    summary = marts.mart_advertiser_summary(imp, adv)
    rows = {r.advertiser_key: r for r in summary.collect()}
    assert set(rows) == {"a1", "a2", "a3"}
    assert {r.revenue_share_pct for r in rows.values()} == {D("33.33")}
    assert {r.campaign_count for r in rows.values()} == {1}
    conc = marts.mart_advertiser_concentration(summary).first()
    # 3 * 33.33^2 = 3332.6667, not 3 * (100/3)^2 = 3333.3
    assert conc.hhi == D("3332.7") and conc.advertiser_count == 3
    assert conc.concentration_band == "CONCENTRATED"
    assert conc.top_advertiser_share_pct == D("33.33")
