"""Telemetry audits: invariants of the raw activity tables as Spark jobs.

Each audit returns a small summary (counts of checked and violating rows and
a ``passed`` flag) or one row per group, never the raw rows themselves.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens import constants as C
from adlens.functions.exprs import round_ratio
from adlens.functions.joins import broadcast_if_small, literal_table, with_totals
from adlens.operators.prep import slot_table


def _summary(checked: DataFrame, violation) -> DataFrame:
    return checked.agg(F.count(F.lit(1)).alias("checked"),
                       F.count_if(violation).alias("violations")).select(
        "checked", "violations", (F.col("violations") == 0).alias("passed"))


def audit_watch_floor(sessions: DataFrame) -> DataFrame:
    """Every session lasts at least the minimum watch time (V1)."""
    return _summary(sessions, F.col("watch_seconds") < F.lit(C.MIN_WATCH_SECONDS))


def audit_slot_depth(sessions: DataFrame, spark: SparkSession) -> DataFrame:
    """ad_requests = depth(deepest_slot) + 1 (V2)."""
    depth = F.broadcast(slot_table(spark).select(F.col("slot_position").alias("deepest_slot"),
                                                 "slot_depth"))
    s = sessions.join(depth, "deepest_slot", "left")
    return _summary(s, F.col("slot_depth").isNull() |
                    (F.col("ad_requests") != F.col("slot_depth") + 1))


def audit_watch_monotone(sessions: DataFrame, spark: SparkSession) -> DataFrame:
    """Mean watch time per slot depth, and whether it rises with depth (V3).

    Aggregated to at most six rows before the ordered window, so the window
    runs over six rows only.
    """
    depth = F.broadcast(slot_table(spark).select(F.col("slot_position").alias("deepest_slot"),
                                                 "slot_depth"))
    per = (sessions.join(depth, "deepest_slot")
           .groupBy("slot_depth").agg(F.sum("watch_seconds").alias("secs"),
                                      F.count(F.lit(1)).alias("sessions")))
    per = per.select("slot_depth", "sessions",
                     round_ratio("secs", "sessions", 3).alias("mean_watch_seconds"))
    prev = F.lag("mean_watch_seconds").over(Window.orderBy("slot_depth"))
    return per.withColumn("rises", F.coalesce(F.col("mean_watch_seconds") > prev, F.lit(True)))


def audit_ad_tier_only(sessions: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Only ad-supported subscribers have viewing sessions (V4)."""
    tiers = broadcast_if_small(subscribers).select("subscriber_id", "subscription_tier")
    s = sessions.select("subscriber_id").join(tiers, "subscriber_id", "left")
    return _summary(s, F.col("subscription_tier").isNull() |
                    (F.col("subscription_tier") == C.NO_ADS_TIER))


def audit_session_window(sessions: DataFrame, start, end) -> DataFrame:
    """Sessions start inside [start, end] (V5)."""
    agg = sessions.agg(F.min("session_start").alias("first_start"),
                       F.max("session_start").alias("last_start"),
                       F.count_if((F.col("session_start") < F.lit(start).cast("timestamp_ntz")) |
                                  (F.col("session_start") >= F.date_add(F.lit(end), 1)
                                   .cast("timestamp_ntz"))).alias("violations"))
    return agg.withColumn("passed", F.col("violations") == 0)


def audit_orphan_requests(requests: DataFrame, sessions: DataFrame) -> DataFrame:
    """Every request belongs to a known session (V7), by left-anti join.

    Requests are counted by session before the join, each task its own first, so
    a session of very many requests is one row of it. A request without a
    session is an orphan.
    """
    per = requests.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    orphans = per.join(broadcast_if_small(sessions).select("session_id"),
                       "session_id", "left_anti")
    total = requests.agg(F.count(F.lit(1)).alias("checked"))
    n = orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"))
    return with_totals(total, n).withColumn("passed", F.col("violations") == 0)


def audit_request_counts(requests: DataFrame, sessions: DataFrame) -> DataFrame:
    """Requests per session equal the session's declared ad_requests (V8)."""
    per = requests.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    s = sessions.select("session_id", "ad_requests").join(per, "session_id", "left")
    return _summary(s, F.coalesce("n", F.lit(0)) != F.col("ad_requests"))


def audit_slot_prefix(requests: DataFrame, spark: SparkSession) -> DataFrame:
    """Each session's requests are a prefix of the slot order (V9):
    min depth 0, max depth n - 1, n distinct slots. A slot that is not in the
    table has no depth, and so violates the last."""
    depth = F.broadcast(slot_table(spark).select("slot_position", "slot_depth"))
    per = (requests.join(depth, "slot_position", "left")
           .groupBy("session_id").agg(F.min("slot_depth").alias("lo"),
                                      F.max("slot_depth").alias("hi"),
                                      F.count(F.lit(1)).alias("n"),
                                      F.count_distinct("slot_depth").alias("k")))
    bad = (F.col("k") != F.col("n")) | F.coalesce(
        (F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1), F.lit(True))
    return _summary(per, bad)


def audit_request_in_session(requests: DataFrame, sessions: DataFrame) -> DataFrame:
    """Requests fall inside [start, start + watch] of their session."""
    s = sessions.select("session_id", "session_start", "watch_seconds")
    j = requests.select("session_id", "request_timestamp").join(s, "session_id")
    end = F.timestamp_add("SECOND", F.col("watch_seconds"), F.col("session_start"))
    return _summary(j, (F.col("request_timestamp") < F.col("session_start")) |
                    (F.col("request_timestamp") > end))


def ad_load_per_hour(requests: DataFrame, sessions: DataFrame,
                     lo: int = C.ADS_PER_HOUR[0], hi: int = C.ADS_PER_HOUR[1]) -> DataFrame:
    """Ad requests per viewing hour, and whether it lies in [lo, hi]."""
    n = requests.agg(F.count(F.lit(1)).alias("requests"))
    secs = sessions.agg(F.sum("watch_seconds").alias("watch_seconds"))
    df = with_totals(n, secs)
    load = round_ratio(F.col("requests") * 3600, "watch_seconds", 2)
    return df.select("requests", "watch_seconds", load.alias("ads_per_hour")).withColumn(
        "passed", (F.col("ads_per_hour") >= lo) & (F.col("ads_per_hour") <= hi))


def _prefix_table(spark: SparkSession) -> DataFrame:
    rows = [(obj, p) for obj, names in C.CAMPAIGN_PREFIXES.items() for p in names]
    return literal_table(spark, rows, [("objective", "string"), ("prefix", "string")])


def audit_campaign_name(campaigns: DataFrame, spark: SparkSession) -> DataFrame:
    """Name prefixes belong to the campaign's objective, and no prefix is
    shared by two objectives (V12). One row per prefix seen."""
    named = campaigns.select("objective", F.split("campaign_name", " - ").getItem(0)
                             .alias("prefix"))
    allowed = F.broadcast(_prefix_table(spark).withColumn("ok", F.lit(True)))
    j = named.join(allowed, ["objective", "prefix"], "left")
    return j.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("campaigns"),
        F.count_distinct("objective").alias("objectives"),
        F.count_if(F.col("ok").isNull()).alias("foreign")).withColumn(
        "passed", (F.col("objectives") == 1) & (F.col("foreign") == 0))


def audit_objectives(campaigns: DataFrame, spark: SparkSession) -> DataFrame:
    """The objectives are exactly the known ones (V13): each with its count; one
    without campaigns fails, and so does one that is not known."""
    objs = literal_table(spark, [(o,) for o in C.OBJECTIVES], [("objective", "string")])
    objs = objs.withColumn("known", F.lit(True))
    counts = campaigns.groupBy("objective").agg(F.count(F.lit(1)).alias("campaigns"))
    return objs.join(counts, "objective", "full").select(
        "objective", F.coalesce("campaigns", F.lit(0)).alias("campaigns"),
        (F.col("campaigns").isNotNull() & F.col("known").isNotNull()).alias("passed"))


def audit_daily_budget(campaigns: DataFrame) -> DataFrame:
    """daily = round(total / flight_days, 2) and total > 0."""
    expected = round_ratio((F.col("total_budget_usd") * 100).cast("decimal(38,0)"),
                           F.col("flight_days") * 100, 2, 12)
    return _summary(campaigns, (F.col("total_budget_usd") <= 0) |
                    ~F.col("daily_budget_usd").eqNullSafe(expected))


def delivery_ratio_spread(campaigns: DataFrame, impressions: DataFrame) -> DataFrame:
    """Whole-flight delivery ratio (revenue / budget) per campaign: mean and
    how many are under (< 0.9), on, and over (> 1.1) (V15). It passes when the
    mean is within 0.1 of 1 and all three outcomes occur."""
    delivered = impressions.groupBy("campaign_id").agg(F.sum("revenue_usd").alias("delivered"))
    df = campaigns.select("campaign_id", "total_budget_usd").join(delivered, "campaign_id", "left")
    micro = (F.coalesce("delivered", F.lit(0)) * 1_000_000).cast("decimal(38,0)")
    cents = (F.col("total_budget_usd") * 100).cast("decimal(38,0)")
    ratio = round_ratio(micro, cents * 10_000, 3)
    df = df.select(ratio.alias("r"))
    spread = df.agg(
        F.count(F.lit(1)).alias("campaigns"),
        round_ratio(F.sum(F.col("r") * 1000), F.count("r") * 1000, 3).alias("mean_ratio"),
        F.count_if(F.col("r") < Decimal("0.9")).alias("under"),
        F.count_if((F.col("r") >= Decimal("0.9")) & (F.col("r") <= Decimal("1.1"))).alias("on_pace"),
        F.count_if(F.col("r") > Decimal("1.1")).alias("over"))
    near = F.abs(F.col("mean_ratio") - 1) <= Decimal("0.1")
    return spread.select("*", F.coalesce(
        near & (F.least("under", "on_pace", "over") > 0), F.lit(False)).alias("passed"))


def audit_fill_target(requests: DataFrame, target_pct: int, tolerance_pct: int = 2) -> DataFrame:
    """Share of filled requests within tolerance of the target."""
    agg = requests.agg(F.count(F.lit(1)).alias("requests"),
                       F.count_if("was_filled").alias("filled"))
    rate = round_ratio(F.col("filled") * 100, "requests", 4)
    return agg.select("requests", "filled", rate.alias("fill_rate_pct"),
                      F.lit(target_pct).alias("target_pct")).withColumn(
        "passed", F.abs(F.col("fill_rate_pct") - F.col("target_pct")) <= tolerance_pct)


def audit_filled_vs_served(requests: DataFrame, impressions: DataFrame) -> DataFrame:
    """Filled requests and impression requests are the same set (V17):
    filled without impression, impression for an unfilled or unknown request."""
    served = impressions.select("request_id")
    filled = requests.filter("was_filled").select("request_id")
    unserved = filled.join(served, "request_id", "left_anti").agg(
        F.count(F.lit(1)).alias("filled_not_served"))
    unfilled = served.join(filled, "request_id", "left_anti").agg(
        F.count(F.lit(1)).alias("served_not_filled"))
    return with_totals(unserved, unfilled).withColumn(
        "passed", (F.col("filled_not_served") == 0) & (F.col("served_not_filled") == 0))


def audit_in_flight(impressions: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Impressions fall inside their campaign's flight."""
    cmp = broadcast_if_small(campaigns).select("campaign_id", "flight_start", "flight_end")
    j = impressions.select("campaign_id", F.to_date("impression_timestamp").alias("d")).join(
        cmp, "campaign_id", "left")
    return _summary(j, F.col("flight_start").isNull() | (F.col("d") < F.col("flight_start")) |
                    (F.col("d") > F.col("flight_end")))
