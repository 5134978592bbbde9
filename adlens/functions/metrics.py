"""Metric expressions: exact ratios behind every published number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens import constants as C
from adlens.functions.exprs import col, micros, round_ratio


def pct(part: str | Column, whole: str | Column, scale: int = 1) -> Column:
    """round(100 * part / whole, scale); null when whole is 0 or null."""
    return round_ratio(F.lit(100) * col(part), whole, scale)


def ecpm(revenue: str | Column, impressions: str | Column) -> Column:
    """round(revenue / impressions * 1000, 2)."""
    return round_ratio(micros(revenue), col(impressions) * F.lit(1000), 2)


def share_pct(amount: str | Column, total: str | Column) -> Column:
    """round(100 * amount / total, 2) for two money amounts."""
    return round_ratio(F.lit(100) * micros(amount), micros(total), 2)


def per_hour(revenue: str | Column, seconds: str | Column) -> Column:
    """round(revenue / (seconds / 3600), 4): revenue per viewing hour."""
    return round_ratio(micros(revenue) * F.lit(3600),
                       col(seconds).cast("decimal(38,0)") * F.lit(1_000_000), 4)


def hours(seconds: str | Column) -> Column:
    """round(seconds / 3600, 1)."""
    return round_ratio(seconds, F.lit(3600), 1)


def mean(total: str | Column, count: str | Column, scale: int = 1) -> Column:
    """round(avg, scale) from an exact sum and count."""
    return round_ratio(total, count, scale)


def elapsed_days(full_date: str | Column, flight_start: str | Column) -> Column:
    """Calendar days since flight start, inclusive: (date - start) + 1."""
    return (F.datediff(col(full_date), col(flight_start)) + F.lit(1)).cast("int")


def pacing_terms(cumulative_spend: str | Column, budget: str | Column,
                 elapsed: str | Column, flight_days: str | Column) -> tuple[Column, Column]:
    """Integral numerator and denominator of the pacing ratio.

    spend / (budget * least(elapsed / flight_days, 1.0)) equals
    spend * flight_days / (budget * least(elapsed, flight_days)) when
    flight_days > 0; with a null or zero flight length least(null, 1.0) is
    1.0, so it is spend / budget. Money is in micro-dollars and cents.
    """
    spend = micros(cumulative_spend)
    cents = (col(budget).cast("decimal(38,2)") * F.lit(100)).cast("decimal(38,0)")
    fd, el = col(flight_days), col(elapsed)
    has_flight = fd.isNotNull() & (fd != 0)
    num = F.when(has_flight, spend * fd.cast("decimal(38,0)")).otherwise(spend)
    den = F.when(has_flight, cents * F.least(el, fd).cast("decimal(38,0)")).otherwise(cents) \
        * F.lit(10_000)
    return num.cast("decimal(38,0)"), den.cast("decimal(38,0)")


def pacing_ratio(cumulative_spend: str | Column, budget: str | Column,
                 elapsed: str | Column, flight_days: str | Column) -> Column:
    """round(spend / (budget * least(elapsed / flight_days, 1.0)), 3), exact;
    null when the denominator is 0 (no budget, or elapsed = 0)."""
    num, den = pacing_terms(cumulative_spend, budget, elapsed, flight_days)
    return round_ratio(num, den, 3, signed=True)


def pacing_status(ratio: str | Column) -> Column:
    """Label from the rounded ratio: null UNKNOWN, <0.9 UNDER, >1.1 OVER, else ON."""
    r = col(ratio)
    return (F.when(r.isNull(), F.lit("UNKNOWN"))
            .when(r < F.lit(C.PACING_UNDER).cast("decimal(2,1)"), F.lit("UNDER_PACING"))
            .when(r > F.lit(C.PACING_OVER).cast("decimal(2,1)"), F.lit("OVER_PACING"))
            .otherwise(F.lit("ON_PACE")))


def concentration_band(hhi: str | Column) -> Column:
    h = col(hhi)
    return (F.when(h < F.lit(C.HHI_MODERATE), F.lit("DIVERSIFIED"))
            .when(h < F.lit(C.HHI_CONCENTRATED), F.lit("MODERATE"))
            .otherwise(F.lit("CONCENTRATED")))
