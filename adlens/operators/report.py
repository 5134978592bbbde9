"""Report queries: the data side of the dashboard, over the analytics marts.

Only bounded results (one row per day, campaign, advertiser or vertical, or
a top-k) are meant to reach a client; nothing here collects a fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens import constants as C
from adlens.functions.exprs import band, format_metric, round_ratio, verdict_for_status

# FIXED VALUES: the five named dashboard reads (name -> mart).
REPORTS = {
    "platform_health": "mart_platform_health",
    "campaign_performance": "mart_campaign_performance",
    "frequency_analysis": "mart_frequency_analysis",
    "advertiser_summary": "mart_advertiser_summary",
    "advertiser_concentration": "mart_advertiser_concentration",
}


def fetch(warehouse, name: str) -> DataFrame:
    """A named report read with its presentation order (K1/K2).

    An unknown name raises KeyError. Ordering is applied at read time; it is
    not a property of the stored mart.
    """
    if name not in REPORTS:
        raise KeyError(f"unknown report: {name}")
    df = warehouse.model(REPORTS[name])
    if name == "platform_health":
        return df.orderBy("full_date")
    if name == "campaign_performance":
        return df.orderBy("campaign_key", "date_key")
    if name == "advertiser_summary":
        return df.orderBy(F.desc("total_spend"), "advertiser_key")
    return df


def report_catalog(warehouse) -> DataFrame:
    """Each named report with its row count (K1)."""
    parts = [warehouse.model(model).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("report_name"), "row_count")
             for name, model in REPORTS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest_health(health: DataFrame) -> DataFrame:
    """The most recent day's KPI row (K3): a top-1 (TakeOrdered), no global sort."""
    return health.orderBy(F.desc("full_date")).limit(1)


def campaign_list(performance: DataFrame) -> DataFrame:
    """Distinct campaigns in the performance mart (K4)."""
    return performance.select("campaign_key", "campaign_name", "company_name").distinct()


def latest_campaign_pacing(performance: DataFrame) -> DataFrame:
    """Each campaign's latest day (K5) via max_by: one aggregation, no window."""
    cols = [c for c in performance.columns if c != "campaign_key"]
    latest = performance.groupBy("campaign_key").agg(
        F.max_by(F.struct(*cols), F.col("date_key")).alias("r"))
    return latest.select("campaign_key", *[F.col(f"r.{c}").alias(c) for c in cols])


def top_advertisers(summary: DataFrame, k: int = 10) -> DataFrame:
    """Top-k advertisers by spend (K6); key breaks ties deterministically."""
    return summary.orderBy(F.desc("total_spend"), F.asc("advertiser_key")).limit(k)


def revenue_by_vertical(summary: DataFrame) -> DataFrame:
    """Spend per industry vertical (K7)."""
    return summary.groupBy("industry_vertical").agg(F.sum("total_spend").alias("total_spend"))


def frequency_summary(freq: DataFrame) -> DataFrame:
    """Unweighted mean violation rate and frequency (2 dp), summed reach (K8),
    and the verdict of the unrounded mean violation rate."""
    agg = freq.agg(F.sum(F.col("violation_rate_pct") * 10).alias("v"),
                   F.sum(F.col("avg_frequency") * 10).alias("f"),
                   F.count(F.lit(1)).alias("n"),
                   F.sum("total_subscribers").alias("total_reach"))
    return agg.select(
        round_ratio(F.col("v").cast("decimal(38,0)"), F.col("n") * 10, 2).alias("mean_violation_rate_pct"),
        round_ratio(F.col("f").cast("decimal(38,0)"), F.col("n") * 10, 2).alias("mean_frequency"),
        F.col("total_reach").cast("long").alias("total_reach"),
        band(F.col("v").cast("double") / F.nullif(F.col("n") * 10, F.lit(0)),
             C.FREQUENCY_VIOLATION_PCT).alias("violation_verdict"))


def planned_spend_curve(campaigns: DataFrame) -> DataFrame:
    """Straight-line plan per campaign: day d of n -> budget * d / n (K9).

    One row per campaign per flight day (bounded by the catalog); a flight
    shorter than one day fails the job.
    """
    n = F.col("flight_days").cast("int")
    checked = campaigns.select(
        "campaign_key", "total_budget_usd",
        F.when(n < 1, F.raise_error(F.concat(F.lit("flight_days must be at least 1, got "),
                                             n.cast("string")))).otherwise(n).alias("n"))
    days = checked.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("flight_day"))
    cents = (F.col("total_budget_usd") * 100).cast("decimal(38,0)")
    return days.select(
        "campaign_key", "flight_day",
        round_ratio(cents * F.col("flight_day"), F.col("n") * 100, 2).alias("planned_spend_usd"))


def planned_vs_actual(curve: DataFrame, performance: DataFrame) -> DataFrame:
    """Planned spend by flight day against actual cumulative spend.

    Spend before or after the flight keeps its rows, without a plan.
    """
    actual = performance.select("campaign_key", F.col("elapsed_days").alias("flight_day"),
                                F.col("cumulative_spend").alias("actual_spend_usd"))
    return curve.join(actual, ["campaign_key", "flight_day"], "full")


def kpi_bands(health: DataFrame) -> DataFrame:
    """Per-day verdicts for fill, eCPM, viewability and RPSH."""
    return health.select(
        "date_key",
        band(F.col("fill_rate_pct"), C.FILL_RATE_PCT).alias("fill_verdict"),
        band(F.col("ecpm_usd"), C.ECPM_USD).alias("ecpm_verdict"),
        band(F.col("viewability_rate_pct"), C.VIEWABILITY_PCT).alias("viewability_verdict"),
        band(F.col("revenue_per_subscriber_hour"), C.RPSH_USD).alias("rpsh_verdict"))


def pacing_verdicts(performance: DataFrame) -> DataFrame:
    """Verdict for each warehouse pacing label."""
    return performance.select("campaign_key", "date_key", "pacing_status",
                              verdict_for_status("pacing_status", C.PACING_STATUS_VERDICT)
                              .alias("verdict"))


def concentration_verdict(concentration: DataFrame) -> DataFrame:
    return concentration.select("concentration_band", verdict_for_status(
        "concentration_band", C.CONCENTRATION_VERDICT).alias("verdict"))


def campaign_violation_bands(freq: DataFrame) -> DataFrame:
    """Frequency-cap violation verdict per campaign."""
    return freq.select("campaign_key", "campaign_name", "violation_rate_pct",
                       band(F.col("violation_rate_pct"), C.FREQUENCY_VIOLATION_PCT)
                       .alias("verdict"))


def metric_labels(health: DataFrame) -> DataFrame:
    """Display text per day; a missing metric reads 'n/a', never 0."""
    return health.select(
        "date_key",
        format_metric("fill_rate_pct", 1, suffix="%").alias("fill_rate_label"),
        format_metric("ecpm_usd", 2, prefix="$").alias("ecpm_label"),
        format_metric("completion_rate_pct", 1, suffix="%").alias("completion_label"),
        format_metric("viewability_rate_pct", 1, suffix="%").alias("viewability_label"),
        format_metric("revenue_per_subscriber_hour", 3, prefix="$").alias("rpsh_label"),
        format_metric("total_revenue_usd", 0, prefix="$", grouped=True).alias("daily_revenue_label"))
