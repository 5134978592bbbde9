"""Preparation jobs and typed ingest."""

import os
import tempfile
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adlens import constants as C
from adlens.operators import prep, report
from adlens.sources import raw as S


def test_expand_sessions_emits_slot_prefix_with_offsets(spark):
    ses = spark.createDataFrame(
        [("s1", "u", "t", datetime(2026, 1, 1), "tv", 1000, "mid_roll_1", 3)],
        "session_id string, subscriber_id string, content_id string, session_start timestamp_ntz, "
        "device string, watch_seconds int, deepest_slot string, ad_requests smallint")
    rows = prep.expand_sessions(ses, spark).orderBy("request_timestamp").collect()
    assert [r.slot_position for r in rows] == C.SLOT_ORDER[:3]
    assert [r.request_timestamp for r in rows] == [
        datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 0, 10), datetime(2026, 1, 1, 0, 5)]


CAMPAIGNS = ("campaign_id string, total_budget_usd decimal(12,2), flight_start date, "
             "flight_end date, flight_days smallint")


def test_in_flight_strict_fails_on_uncovered_day(spark):
    cmp = spark.createDataFrame([("c1", Decimal("10"), date(2030, 1, 1), date(2030, 1, 7), 7)], CAMPAIGNS)
    days = spark.createDataFrame([(date(2026, 1, 1),)], "day date")
    for read in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("day").collect()):
        with pytest.raises(ValueError, match="no campaign in flight on 2026-01-01"):
            read(prep.in_flight_candidates(days, cmp))
    rows = prep.in_flight_candidates(days, cmp, strict=False).collect()
    assert [(r.day, r.campaign_id) for r in rows] == [(date(2026, 1, 1), None)]


def test_in_flight_days_against_plain_containment(spark):
    """Gaps, one-day, overlapping, repeated, reversed and open-ended flights; asked
    days before, between and after them, repeated and null."""
    d = lambda n: date(2026, 1, n)
    flights = [("a", d(3), d(5)), ("b", d(5), d(5)), ("c", d(9), d(12)), ("c2", d(9), d(12)),
               ("rev", d(20), d(18)), ("null", None, d(25)), ("open", d(25), None)]
    cmp = spark.createDataFrame([(c, Decimal("1"), s, e, 1) for c, s, e in flights], CAMPAIGNS)
    asked = [None, None, *[d(n) for n in (1, 3, 5, 5, 6, 8, 9, 12, 13, 18, 19, 20, 25, 28)]]
    days = spark.createDataFrame([(x,) for x in asked], "day date")
    got = sorted(((r.day, r.campaign_id) for r in prep.in_flight_candidates(
        days, cmp, strict=False).collect()), key=str)
    want = []
    for day in set(asked):
        on = [c for c, s, e in flights if day and s and e and s <= day <= e]
        want += [(day, c) for c in on or [None]]
    assert got == sorted(want, key=str)
    assert sorted((r.day for r in prep.uncovered_days(days, cmp).collect()), key=str) == sorted(
        (day for day, c in want if c is None), key=str)
    assert prep.in_flight_candidates(days.limit(0), cmp, strict=False).count() == 0
    none = prep.in_flight_candidates(days, cmp.limit(0), strict=False).collect()
    assert len(none) == len(set(asked)) and not any(r.campaign_id for r in none)


def test_slices_of_a_day_of_many_campaigns_lie_end_to_end(spark):
    n = 5000
    cand = spark.range(n).select(
        F.lit(date(2026, 1, 1)).alias("day"), F.concat(F.lit("c"), F.lpad("id", 6, "0")).alias("campaign_id"),
        (F.col("id") % 97 + 1).cast("decimal(12,2)").alias("total_budget_usd")).repartition(7)
    rows = sorted(prep.allocation_slices(cand).collect(), key=lambda r: r.campaign_id)
    assert len(rows) == n and rows[0].lo == 0 and rows[-1].hi == 1 << prep.UNIT_BITS
    assert all(p.hi == q.lo for p, q in zip(rows, rows[1:]))
    total = sum(i % 97 + 1 for i in range(n))
    assert rows[96].hi - rows[96].lo in {97 * (1 << prep.UNIT_BITS) // total + k for k in (0, 1)}


def test_smallest_budget_keeps_its_slice(spark):
    """A cent beside ten billion dollars owns a slice of the draw range; a
    budget of nothing does not."""
    cmp = spark.createDataFrame([
        ("a", Decimal("9999999999.99"), date(2026, 1, 1), date(2026, 1, 1), 1),
        ("b", Decimal("0.01"), date(2026, 1, 1), date(2026, 1, 1), 1),
        ("c", Decimal("0.00"), date(2026, 1, 1), date(2026, 1, 1), 1)], CAMPAIGNS)
    req = spark.range(200).select(F.col("id").cast("string").alias("request_id"),
                                  F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz").alias("request_timestamp"))
    days = req.select(F.to_date("request_timestamp").alias("day"))
    slices = prep.allocation_slices(prep.in_flight_candidates(days, cmp)).collect()
    assert {r.campaign_id for r in slices} == {"a", "b"} and all(r.hi > r.lo for r in slices)
    assert max(r.hi for r in slices) == 1 << prep.UNIT_BITS
    out = prep.weighted_allocation(req, prep.in_flight_candidates(days, cmp)).collect()
    assert len(out) == 200 and all(r.campaign_id for r in out)


def test_weighted_allocation_assigns_each_request_once_by_budget(spark):
    cmp = spark.createDataFrame([
        ("big", Decimal("300"), date(2026, 1, 1), date(2026, 1, 31), 31),
        ("small", Decimal("100"), date(2026, 1, 1), date(2026, 1, 31), 31),
        ("off", Decimal("999"), date(2026, 3, 1), date(2026, 3, 31), 31),
    ], CAMPAIGNS)
    req = spark.range(4000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("request_id"),
                                   F.lit(datetime(2026, 1, 5)).cast("timestamp_ntz").alias("request_timestamp"))
    days = req.select(F.to_date("request_timestamp").alias("day"))
    out = prep.weighted_allocation(req, prep.in_flight_candidates(days, cmp))
    counts = {r.campaign_id: r["count"] for r in out.groupBy("campaign_id").count().collect()}
    assert out.select("request_id").distinct().count() == 4000 == sum(counts.values())
    assert "off" not in counts
    assert 0.70 < counts["big"] / 4000 < 0.80


def test_weighted_allocation_keeps_requests_of_uncovered_days(spark):
    cmp = spark.createDataFrame([
        ("a", Decimal("10"), date(2026, 1, 1), date(2026, 1, 2), 2)], CAMPAIGNS)
    req = spark.createDataFrame(
        [(f"r{n}", datetime(2026, 1, 1 + n % 4)) for n in range(40)] + [("late", None)],
        "request_id string, request_timestamp timestamp_ntz")
    days = req.select(F.to_date("request_timestamp").alias("day")).dropna()
    rows = prep.weighted_allocation(req, prep.in_flight_candidates(days, cmp, strict=False)).collect()
    lost = [r for r in rows if r.campaign_id is None]
    assert len(rows) == 41 and len(lost) == 21
    assert {r.unallocated_reason for r in lost} == {"no campaign in flight"}
    assert not any(r.unallocated_reason for r in rows if r.campaign_id)


def test_planned_vs_actual_keeps_spend_outside_the_flight(spark):
    curve = spark.createDataFrame([("k", 1, Decimal("5.00")), ("k", 2, Decimal("9.00"))],
                                  "campaign_key string, flight_day int, planned_spend_usd decimal(12,2)")
    spent = spark.createDataFrame([("k", d, Decimal("1.00")) for d in (-3, 2, 9)] + [
        ("other", 1, Decimal("1.00"))],
        "campaign_key string, elapsed_days int, cumulative_spend decimal(12,2)")
    rows = report.planned_vs_actual(curve, spent).collect()
    assert sum(r.actual_spend_usd is not None for r in rows) == 4 and len(rows) == 5
    assert {r.flight_day for r in rows if r.planned_spend_usd is None} == {-3, 9, 1}


def test_calibrate_budgets_floor_and_daily(spark):
    cmp = spark.createDataFrame([("c1", 10), ("c2", 20)], "campaign_id string, flight_days smallint")
    imp = spark.createDataFrame([("c1", Decimal("9.000000"))], "campaign_id string, revenue_usd decimal(12,6)")
    got = {r.campaign_id: r for r in prep.calibrate_budgets(cmp, imp, F.lit(90)).collect()}
    assert got["c1"].total_budget_usd == Decimal("10.00")      # 9 / 0.9
    assert got["c2"].total_budget_usd == Decimal("2.00")       # floor 0.10 x 20
    assert got["c1"].daily_budget_usd == Decimal("1.00")


def test_planned_spend_curve_reaches_budget_and_rejects_empty_flight(spark):
    cmp = spark.createDataFrame([("k", Decimal("100.00"), 3)],
                                "campaign_key string, total_budget_usd decimal(12,2), flight_days smallint")
    rows = report.planned_spend_curve(cmp).orderBy("flight_day").collect()
    assert [r.planned_spend_usd for r in rows] == [Decimal("33.33"), Decimal("66.67"), Decimal("100.00")]
    bad = spark.createDataFrame([("k", Decimal("1"), 0)], cmp.schema)
    with pytest.raises(Exception, match="flight_days must be at least 1"):
        report.planned_spend_curve(bad).collect()


def test_campaign_status_and_label(spark):
    df = spark.createDataFrame([(date(2026, 1, 1), date(2026, 1, 31))], "s date, e date")
    st = lambda asof: df.select(prep.campaign_status("s", "e", asof).alias("x")).first().x  # noqa
    assert (st(date(2025, 12, 31)), st(date(2026, 1, 31)), st(date(2026, 2, 1))) == \
        ("scheduled", "active", "completed")
    lab = spark.createDataFrame([("awareness", 0, "Automotive", date(2026, 2, 3))],
                                "o string, i int, v string, s date")
    assert lab.select(prep.campaign_label("o", "i", "v", "s").alias("x")).first().x == \
        "Brand Lift - Auto Q1 2026"


def test_typed_csv_load_is_positional_and_failfast(spark):
    d = tempfile.mkdtemp(prefix="adlens-csv-", dir="/tmp")
    good = os.path.join(d, "ad_slots.csv")
    with open(good, "w") as f:
        f.write("a,b,c,d\npre_roll_1,15,0.92,0.95\n")      # header names are ignored
    row = S.read_csv_typed(spark, good, "ad_slots").first()
    assert row.slot_position == "pre_roll_1" and row.avg_viewability == Decimal("0.95")
    bad = os.path.join(d, "bad.csv")
    with open(bad, "w") as f:
        f.write("slot_position,typical_duration_sec,avg_completion_rate,avg_viewability\n"
                "pre_roll_1,fifteen,0.92,0.95\n")
    with pytest.raises(Exception):
        S.read_csv_typed(spark, bad, "ad_slots").collect()


@pytest.mark.parametrize("lines, fault", [
    ("pre_roll_1,fifteen,0.92,0.95", None),
    ("pre_roll_1,,0.92,0.95", "typical_duration_sec: 1 blank"),
    ("pre_roll_1,15,,0.95", "avg_completion_rate: 1 blank"),
    (",15,0.92,0.95", "slot_position: 1 blank"),
    ("pre_roll_1,15,0.92,0.95\npre_roll_1,30,0.92,0.95", "slot_position: 1 repeated keys"),
])
def test_checked_load_cannot_be_pruned_around(spark, tmp_path, lines, fault):
    path = tmp_path / "ad_slots.csv"
    path.write_text("a,b,c,d\n" + lines + "\n")
    for read in (lambda df: df.count(), lambda df: df.select("slot_position").collect(),
                 lambda df: S.row_counts({"ad_slots": df}).collect()):
        with pytest.raises(Exception, match=fault):
            read(S.load_table(spark, str(path), "ad_slots"))


def test_checked_load_keeps_good_rows(spark, tmp_path):
    path = tmp_path / "ad_slots.csv"
    path.write_text("a,b,c,d\npre_roll_1,15,0.92,0.95\npost_roll,30,0.40,0.50\n")
    assert S.load_table(spark, str(path), "ad_slots").count() == 2


def test_report_labels_list_and_summary(spark):
    health = spark.createDataFrame(
        [(1, Decimal("81.3"), Decimal("12.50"), Decimal("70.0"), None, Decimal("0.3125"), Decimal("1234567.5"))],
        "date_key int, fill_rate_pct decimal(18,1), ecpm_usd decimal(18,2), completion_rate_pct decimal(18,1), "
        "viewability_rate_pct decimal(18,1), revenue_per_subscriber_hour decimal(18,4), "
        "total_revenue_usd decimal(38,6)")
    assert list(report.metric_labels(health).first()) == [
        1, "81.3%", "$12.50", "70.0%", "n/a", "$0.313", "$1,234,568"]
    freq = spark.createDataFrame([(Decimal("1.9"), Decimal("2.0"), 3), (Decimal("2.0"), Decimal("1.0"), 4)],
                                 "violation_rate_pct decimal(18,1), avg_frequency decimal(18,1), "
                                 "total_subscribers long")
    row = report.frequency_summary(freq).first()
    assert (row.mean_violation_rate_pct, row.total_reach, row.violation_verdict) == (Decimal("1.95"), 7, "good")
    assert report.frequency_summary(freq.limit(0)).first().violation_verdict == "unknown"


def test_missing_inputs_raise_before_reading(spark):
    d = tempfile.mkdtemp(prefix="adlens-raw-", dir="/tmp")
    with pytest.raises(FileNotFoundError, match="ad_impressions"):
        S.read_raw_csv(spark, d)
