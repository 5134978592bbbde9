"""Telemetry audits on hand-made fixtures: a clean fixture passes every audit
and each planted defect is counted exactly once."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adlens import constants as C
from adlens.operators import audit as V
from adlens.operators import prep

SESSION_SCHEMA = ("session_id string, subscriber_id string, content_id string, "
                  "session_start timestamp_ntz, device string, watch_seconds int, "
                  "deepest_slot string, ad_requests smallint")
T0 = datetime(2026, 1, 5, 20, 0)


@pytest.fixture(scope="module")
def clean(spark):
    rows = [(f"s{i}", f"u{i % 3}", "t1", T0 + timedelta(hours=i), "tv", 600 + 60 * i,
             C.SLOT_ORDER[i % 6], i % 6 + 1) for i in range(12)]
    sessions = spark.createDataFrame(rows, SESSION_SCHEMA)
    requests = prep.expand_sessions(sessions).withColumn("was_filled", F.lit(True))
    return sessions, requests


def violations(df) -> int:
    return df.first()["violations"]


def test_clean_fixture_passes(spark, clean):
    sessions, requests = clean
    for df in [V.audit_watch_floor(sessions), V.audit_slot_depth(sessions, spark),
               V.audit_orphan_requests(requests, sessions),
               V.audit_request_counts(requests, sessions), V.audit_slot_prefix(requests, spark),
               V.audit_request_in_session(requests, sessions)]:
        r = df.first()
        assert r["passed"] and r["violations"] == 0, r


def test_watch_floor_and_slot_depth_count_planted_sessions(spark, clean):
    sessions, _ = clean
    short = sessions.withColumn("watch_seconds", F.when(F.col("session_id") == "s1", 29)
                                .otherwise(F.col("watch_seconds")))
    assert violations(V.audit_watch_floor(short)) == 1
    wrong = sessions.withColumn("ad_requests", F.when(F.col("session_id") == "s2", 1)
                                .otherwise(F.col("ad_requests")))
    assert violations(V.audit_slot_depth(wrong, spark)) == 1


def test_request_audits_count_planted_requests(spark, clean):
    sessions, requests = clean
    # session s0 stops at the first slot, so it has exactly one request
    orphan = requests.filter(F.col("session_id") == "s0").withColumn(
        "session_id", F.lit("no-such-session"))
    assert violations(V.audit_orphan_requests(requests.unionByName(orphan), sessions)) == 1
    # drop the first slot of session s5: its count and its prefix both break
    gap = requests.filter(~((F.col("session_id") == "s5") & (F.col("slot_position") == C.SLOT_ORDER[0])))
    assert violations(V.audit_request_counts(gap, sessions)) == 1
    assert violations(V.audit_slot_prefix(gap, spark)) == 1
    late = requests.withColumn("request_timestamp", F.when(
        (F.col("session_id") == "s3") & (F.col("slot_position") == C.SLOT_ORDER[0]),
        F.lit(T0 + timedelta(days=30)).cast("timestamp_ntz")).otherwise(F.col("request_timestamp")))
    assert violations(V.audit_request_in_session(late, sessions)) == 1


def test_filled_vs_served_counts_both_directions(spark):
    req = spark.createDataFrame([("r1", True), ("r2", True), ("r3", False)],
                                "request_id string, was_filled boolean")
    imp = spark.createDataFrame([("r1",), ("r3",), ("r9",)], "request_id string")
    r = V.audit_filled_vs_served(req, imp).first()
    assert (r.filled_not_served, r.served_not_filled, r.passed) == (1, 2, False)


def test_in_flight_and_daily_budget(spark):
    cmp = spark.createDataFrame(
        [("c1", date(2026, 1, 1), date(2026, 1, 10), 10, Decimal("100.00"), Decimal("10.00")),
         ("c2", date(2026, 1, 1), date(2026, 1, 3), 3, Decimal("100.00"), Decimal("33.34"))],
        "campaign_id string, flight_start date, flight_end date, flight_days smallint, "
        "total_budget_usd decimal(12,2), daily_budget_usd decimal(12,2)")
    imp = spark.createDataFrame(
        [("c1", datetime(2026, 1, 10, 23, 59)), ("c1", datetime(2026, 1, 11, 0, 0)),
         ("c2", datetime(2026, 1, 1, 0, 0)), ("c9", datetime(2026, 1, 2, 0, 0))],
        "campaign_id string, impression_timestamp timestamp_ntz")
    # after the flight, and an unknown campaign
    assert violations(V.audit_in_flight(imp, cmp)) == 2
    # 100.00 / 3 = 33.33, not 33.34
    assert violations(V.audit_daily_budget(cmp)) == 1


def test_unknown_slots_and_objectives_are_violations(spark):
    reqs = spark.createDataFrame([("s1", "banner"), ("s2", "pre_roll"), ("s2", "banner")],
                                 "session_id string, slot_position string")
    r = V.audit_slot_prefix(reqs, spark).first()
    assert (r.checked, r.violations, r.passed) == (2, 2, False)
    camps = spark.createDataFrame([("charity",)], "objective string")
    rows = {r.objective: r for r in V.audit_objectives(camps, spark).collect()}
    assert rows["charity"].campaigns == 1 and not any(r.passed for r in rows.values())


def test_orphan_requests_of_the_given_table(spark, sf_small):
    from adlens.plans import catalog
    from tests.oracle_compare import compare
    key = "audit_orphan_requests_given"
    got = catalog.queries()[key](spark, sf_small)
    ran = compare(spark, sf_small, got, catalog.oracle_sql()[key])
    assert ran["schema_match"] and ran["rows_match"], ran
    given = catalog.queries()["audit_orphan_requests"](spark, sf_small).first()
    assert got.first()["checked"] != given["checked"] > 0
