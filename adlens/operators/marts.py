"""Analytics marts: the daily and per-entity metrics the reports read.

Aggregations run before dimension joins wherever the join key is the group
key (or the dimension key is unique), so facts are reduced before any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.exprs import date_key, round_decimal
from adlens.functions.joins import broadcast_if_small, is_small_id_set, with_totals
from adlens.functions.metrics import (
    concentration_band, ecpm, hours, mean, pct, per_hour, share_pct,
)
from adlens.functions.packed import (
    key_numbers, named_keys, numbered_keys, packed_text, unpacked_text,
)
from adlens.operators.reach import measured, one
from adlens.sources.schemas import MONEY_SUM

def _zero_money():
    return F.lit(0).cast(MONEY_SUM)


def daily_requests(stg_requests: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Requests per calendar day (A3); days outside the calendar are dropped."""
    per_day = (stg_requests.groupBy(date_key("request_timestamp").alias("date_key"))
               .agg(F.count(F.lit(1)).alias("total_requests")))
    return per_day.join(broadcast_if_small(dim_date).select("date_key"), "date_key")


def daily_impressions(fct_imp: DataFrame) -> DataFrame:
    """Impression KPIs per day including distinct subscribers (A5)."""
    return measured(fct_imp, ["date_key"], {
        "total_impressions": one(), "completed_impressions": one("completed"),
        "viewable_impressions": one("is_viewable"), "total_revenue_usd": F.col("revenue_usd"),
    }, "unique_subscribers").withColumn(
        "total_revenue_usd", F.col("total_revenue_usd").cast(MONEY_SUM))


def daily_viewing(fct_sessions: DataFrame) -> DataFrame:
    """Content watch seconds per day (A4); hours are formed at the last step."""
    return fct_sessions.groupBy("date_key").agg(
        F.sum("watch_seconds").alias("watch_seconds"))


def mart_platform_health(stg_requests: DataFrame, fct_imp: DataFrame,
                         fct_sessions: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Daily fill, eCPM, completion, viewability, revenue, reach, hours, RPSH (M4).

    requests FULL OUTER impressions on the day, the coalesced day inner-joined
    to the calendar, viewing LEFT joined. All inputs are day aggregates.
    """
    dr = (stg_requests.groupBy(date_key("request_timestamp").alias("date_key"))
          .agg(F.count(F.lit(1)).alias("total_requests")))
    di = daily_impressions(fct_imp)
    dv = daily_viewing(fct_sessions)
    dd = broadcast_if_small(dim_date).select("date_key", "full_date")
    # a using-column full outer join yields coalesce(dr.date_key, di.date_key)
    days = dr.join(di, "date_key", "full_outer").join(dd, "date_key").join(dv, "date_key", "left")
    imps = F.coalesce("total_impressions", F.lit(0))
    revenue = F.coalesce("total_revenue_usd", _zero_money())
    return days.select(
        "date_key",
        "full_date",
        F.coalesce("total_requests", F.lit(0)).cast("long").alias("total_requests"),
        imps.cast("long").alias("total_impressions"),
        pct(imps, "total_requests").alias("fill_rate_pct"),
        ecpm(revenue, "total_impressions").alias("ecpm_usd"),
        pct(F.coalesce("completed_impressions", F.lit(0)), "total_impressions")
        .alias("completion_rate_pct"),
        pct(F.coalesce("viewable_impressions", F.lit(0)), "total_impressions")
        .alias("viewability_rate_pct"),
        revenue.alias("total_revenue_usd"),
        F.coalesce("unique_subscribers", F.lit(0)).cast("long").alias("unique_subscribers"),
        F.coalesce(hours("watch_seconds"), F.lit(0).cast("decimal(18,1)"))
        .alias("viewing_hours"),
        per_hour(revenue, "watch_seconds").alias("revenue_per_subscriber_hour"),
    )


def mart_campaign_performance(fct_daily: DataFrame, dim_campaigns: DataFrame,
                              dim_advertisers: DataFrame) -> DataFrame:
    """Campaign x day pacing with names, vertical and cap (M5)."""
    dc = broadcast_if_small(dim_campaigns).select(
        "campaign_key", "advertiser_key", "campaign_name", "frequency_cap")
    da = broadcast_if_small(dim_advertisers).select(
        "advertiser_key", "company_name", "industry_vertical")
    df = fct_daily.join(dc, "campaign_key").join(da, "advertiser_key")
    return df.select(
        "campaign_key", "campaign_name", "company_name", "industry_vertical", "date_key",
        "elapsed_days", F.col("impressions_served").alias("impressions"), "revenue_usd",
        "cumulative_spend", "total_budget_usd", "flight_days", "budget_pacing_ratio",
        "pacing_status", "frequency_cap",
    )


def platform_total(fct_imp: DataFrame) -> DataFrame:
    """Total platform revenue, one row."""
    return fct_imp.agg(F.sum("revenue_usd").cast(MONEY_SUM).alias("total_platform_spend"))


def mart_advertiser_summary(fct_imp: DataFrame, dim_advertisers: DataFrame) -> DataFrame:
    """Per-advertiser spend, delivery quality, campaigns and revenue share (M6).

    Aggregated by advertiser_key before the dimension join (the key is unique
    in the dimension, so this equals join-then-group); the platform total is a
    one-row aggregate joined to every row.
    """
    agg = fct_imp.groupBy("advertiser_key").agg(
        F.sum("revenue_usd").cast(MONEY_SUM).alias("total_spend"),
        F.count(F.lit(1)).alias("total_impressions"),
        F.count_if("completed").alias("n_completed"),
        F.count_if("is_viewable").alias("n_viewable"),
        F.count_distinct("campaign_key").alias("campaign_count"),
    )
    da = broadcast_if_small(dim_advertisers).select(
        "advertiser_key", "company_name", "industry_vertical", "spend_tier")
    df = with_totals(agg.join(da, "advertiser_key"), platform_total(fct_imp))
    return df.select(
        "advertiser_key", "company_name", "industry_vertical", "spend_tier",
        "total_spend", "total_impressions",
        ecpm("total_spend", "total_impressions").alias("ecpm"),
        pct("n_completed", "total_impressions").alias("completion_rate_pct"),
        pct("n_viewable", "total_impressions").alias("viewability_rate_pct"),
        "campaign_count",
        share_pct("total_spend", "total_platform_spend").alias("revenue_share_pct"),
    )


def mart_advertiser_concentration(summary: DataFrame) -> DataFrame:
    """HHI over the 2-dp revenue shares, band from the unrounded sum (M7)."""
    s = F.col("revenue_share_pct")
    scored = summary.agg(
        F.sum(s * s).alias("hhi_exact"),
        F.count(F.lit(1)).alias("advertiser_count"),
        F.max(s).alias("top_share"),
    )
    return scored.select(
        round_decimal("hhi_exact", 1).alias("hhi"),
        concentration_band("hhi_exact").alias("concentration_band"),
        "advertiser_count",
        round_decimal("top_share", 2).alias("top_advertiser_share_pct"),
    )


def subscriber_campaign_counts(fct_imp: DataFrame) -> DataFrame:
    """Impressions per (subscriber, campaign) over the whole window (A8 first level)."""
    return fct_imp.groupBy(packed_text("subscriber_key").alias("subscriber_key"), "campaign_key").agg(
        F.count(F.lit(1)).alias("times_seen")).withColumn(
        "subscriber_key", unpacked_text("subscriber_key"))


def mart_frequency_analysis(fct_imp: DataFrame, dim_campaigns: DataFrame) -> DataFrame:
    """Reach, subscribers strictly over the cap, excess impressions (M8)."""
    numbers = key_numbers(dim_campaigns, "campaign_key")   # others are dropped by the cap's join
    pairs = named_keys(subscriber_campaign_counts(numbered_keys(fct_imp, numbers, "campaign_key")),
                       numbers, "campaign_key")
    caps = broadcast_if_small(dim_campaigns).select("campaign_key", "frequency_cap")
    n = F.col("times_seen")
    cap = F.col("frequency_cap")
    over = n > cap
    per_campaign = pairs.join(caps, "campaign_key").groupBy("campaign_key", "frequency_cap").agg(
        F.count(F.lit(1)).alias("total_subscribers"),
        F.count_if(over).alias("subscribers_exceeding_cap"),
        F.sum(F.when(over, n - cap).otherwise(F.lit(0))).cast("long").alias("total_violations"),
        F.sum(n).alias("impressions"),
    )
    names = broadcast_if_small(dim_campaigns).select("campaign_key", "campaign_name")
    return per_campaign.join(names, "campaign_key").select(
        "campaign_key", "campaign_name", "frequency_cap", "total_subscribers",
        "subscribers_exceeding_cap", "total_violations",
        pct("subscribers_exceeding_cap", "total_subscribers").alias("violation_rate_pct"),
        mean("impressions", "total_subscribers").alias("avg_frequency"),
    )


def mart_content_monetization(fct_imp: DataFrame, dim_content: DataFrame) -> DataFrame:
    """Genre x day impressions, revenue, mean ad view seconds (M9).

    Keys and genres are broadcast while they are under the bounds of an id set, and
    impressions are combined by (genre, day) before the only shuffle. Beyond that they
    are pre-aggregated to (content, day), so the join sees one row per title-day.
    """
    dc = dim_content.select("content_key", "genre")
    if is_small_id_set(dc):
        titles = fct_imp.join(F.broadcast(dc), "content_key").select(
            "genre", "date_key", one().alias("n"), F.col("revenue_usd").alias("rev"),
            F.col("view_duration_sec").alias("view"))
    else:
        titles = fct_imp.groupBy("content_key", "date_key").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("revenue_usd").alias("rev"),
            F.sum("view_duration_sec").alias("view"),
        ).join(dc, "content_key")
    per_genre = titles.groupBy("genre", "date_key").agg(
        F.sum("n").alias("impressions"),
        F.sum("rev").cast(MONEY_SUM).alias("revenue_usd"),
        F.sum("view").alias("view"),
    )
    return per_genre.select(
        "genre", "date_key", "impressions", "revenue_usd",
        mean("view", "impressions").alias("avg_view_duration_sec"),
    )
