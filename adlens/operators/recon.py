"""Reconciliation checks: recompute a metric a second way and compare.

Each function returns both sides and a ``passed`` flag. Whole-table checks
return one row (both sides are one-row aggregates); row-level checks return
one row per checked key. ``failures.failing_reconciliations``
keeps the rows that did not pass.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.exprs import micros, round_decimal, round_ratio
from adlens.functions.joins import broadcast_if_small, with_totals
from adlens.functions.metrics import elapsed_days, per_hour
from adlens.sources.schemas import MONEY_SUM


def recon_revenue_share(summary: DataFrame) -> DataFrame:
    """Advertiser revenue shares sum to 100 within 1 point."""
    return summary.agg(F.sum("revenue_share_pct").alias("total_pct")).select(
        "total_pct",
        (F.abs(F.col("total_pct") - F.lit(100)) <= F.lit(1)).alias("passed"))


def recon_elapsed_days(fct_daily: DataFrame, dim_date: DataFrame,
                       dim_campaigns: DataFrame) -> DataFrame:
    """elapsed_days equals calendar days since flight start (R2)."""
    dd = broadcast_if_small(dim_date).select("date_key", "full_date")
    dc = broadcast_if_small(dim_campaigns).select("campaign_key", "flight_start")
    df = fct_daily.select("campaign_key", "date_key", "elapsed_days").join(dd, "date_key") \
        .join(dc, "campaign_key")
    return df.select(
        "campaign_key", "date_key", "elapsed_days",
        elapsed_days("full_date", "flight_start").alias("calendar_elapsed_days"),
    ).withColumn("passed", F.col("elapsed_days") == F.col("calendar_elapsed_days"))


def recon_hhi(concentration: DataFrame, summary: DataFrame) -> DataFrame:
    """HHI equals sum((share / 100)^2) * 10000 within 0.1.

    The long route is kept in exact decimals: share * 0.01 squared, summed,
    scaled by 10000.
    """
    # narrow each operand so no product exceeds 38 digits (no silent rescaling)
    frac = (F.col("revenue_share_pct").cast("decimal(18,2)") * F.lit(Decimal("0.01"))) \
        .cast("decimal(10,4)")
    squares = F.sum((frac * frac).cast("decimal(21,8)")).cast("decimal(31,8)")
    expected = summary.agg((squares * F.lit(10000)).cast("decimal(18,4)").alias("expected_hhi"))
    df = with_totals(concentration.select("hhi"), expected)
    return df.withColumn("passed", F.abs(F.col("hhi") - F.col("expected_hhi")) <= F.lit(0.1))


def recon_filled(stg_requests: DataFrame, fct_imp: DataFrame) -> DataFrame:
    """Filled requests equal impressions in the fact."""
    filled = stg_requests.agg(F.count_if("was_filled").alias("request_count"))
    served = fct_imp.agg(F.count(F.lit(1)).alias("impression_count"))
    return with_totals(filled, served).withColumn(
        "passed", F.col("request_count") == F.col("impression_count"))


def recon_pacing_ratio(fct_daily: DataFrame) -> DataFrame:
    """Shipped ratio equals the published formula, null-safe.

    Second route: the formula split into its cases (flight over or not, no
    flight length), each an exact rounded quotient of the emitted columns.
    """
    spend = micros("cumulative_spend")
    cents = (F.col("total_budget_usd") * F.lit(100)).cast("decimal(38,0)")
    fd, el = F.col("flight_days"), F.col("elapsed_days")
    whole_budget = round_ratio(spend, cents * F.lit(10_000), 3, signed=True)
    partial = round_ratio(spend * fd, cents * el * F.lit(10_000), 3, signed=True)
    expected = (F.when(fd.isNull() | (fd == 0) | (el >= fd), whole_budget)
                .otherwise(partial))
    df = fct_daily.select("campaign_key", "date_key", "budget_pacing_ratio",
                          expected.alias("expected_ratio"))
    return df.withColumn("passed", F.col("budget_pacing_ratio").eqNullSafe(F.col("expected_ratio")))


def recon_pacing_status(fct_daily: DataFrame) -> DataFrame:
    """The status label follows from the ratio column."""
    r = F.col("budget_pacing_ratio")
    expected = (F.when(r.isNull(), "UNKNOWN").when(r < F.lit(Decimal("0.9")), "UNDER_PACING")
                .when(r > F.lit(Decimal("1.1")), "OVER_PACING").otherwise("ON_PACE"))
    df = fct_daily.select("campaign_key", "date_key", "budget_pacing_ratio", "pacing_status",
                          expected.alias("expected_status"))
    return df.withColumn("passed", F.col("pacing_status") == F.col("expected_status"))


def recon_platform_health(health: DataFrame, fct_imp: DataFrame) -> DataFrame:
    """Daily rollup totals equal the fact totals: count exact, revenue within 1.00."""
    rollup = health.agg(F.sum("total_impressions").cast("long").alias("rollup_impressions"),
                        round_decimal(F.sum("total_revenue_usd"), 2, 38).alias("rollup_revenue"))
    fact = fct_imp.agg(F.count(F.lit(1)).alias("fact_impressions"),
                       round_decimal(F.sum("revenue_usd"), 2, 38).alias("fact_revenue"))
    df = with_totals(rollup, fact)
    return df.withColumn("passed", (F.col("rollup_impressions") == F.col("fact_impressions")) &
                         (F.abs(F.col("rollup_revenue") - F.col("fact_revenue")) <= F.lit(1)))


def recon_rpsh(health: DataFrame, fct_imp: DataFrame, fct_sessions: DataFrame) -> DataFrame:
    """RPSH equals fact revenue over fact content hours per day, null-safe."""
    rev = fct_imp.groupBy("date_key").agg(F.sum("revenue_usd").cast(MONEY_SUM).alias("rev"))
    secs = fct_sessions.groupBy("date_key").agg(F.sum("watch_seconds").alias("secs"))
    expected = rev.join(secs, "date_key").select(
        "date_key", per_hour("rev", "secs").alias("expected_rpsh"))
    df = health.select("date_key", "revenue_per_subscriber_hour").join(expected, "date_key")
    return df.withColumn("passed", F.col("revenue_per_subscriber_hour")
                         .eqNullSafe(F.col("expected_rpsh")))
