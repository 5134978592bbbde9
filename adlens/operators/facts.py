"""Fact tables: impressions, viewing sessions, campaign x day pacing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions.exprs import date_key
from adlens.functions.joins import attach_key, broadcast_if_small, conform
from adlens.functions.exprs import round_ratio
from adlens.functions.metrics import elapsed_days, pacing_status, pacing_terms
from adlens.functions.packed import key_numbers, named_keys, numbered_keys
from adlens.operators.reach import measured, one
from adlens.sources.schemas import CONTRACTS, MONEY_SUM


def fct_ad_impressions(stg_imp: DataFrame, dim_campaigns: DataFrame,
                       dim_advertisers: DataFrame, dim_subscribers: DataFrame,
                       dim_content: DataFrame, dim_ad_slots: DataFrame,
                       dim_date: DataFrame) -> DataFrame:
    """One row per impression with ids replaced by conformed keys.

    Inner joins drop orphans. Every dimension goes through a checked
    broadcast, so the fact is never shuffled for a small dimension. The two that
    grow with the data come first, while rows are narrow: over the bound only
    their ids are sent (``attach_key``), beyond that they join by shuffle.
    """
    imp = attach_key(stg_imp, dim_subscribers, "subscriber_key", "subscriber_id")
    imp = attach_key(imp, dim_content, "content_key", "content_id")
    imp = imp.withColumn("date_key", date_key("impression_timestamp"))
    cmp = broadcast_if_small(dim_campaigns).select("campaign_key", "campaign_id")
    adv = broadcast_if_small(dim_advertisers).select("advertiser_key", "advertiser_id")
    slt = broadcast_if_small(dim_ad_slots).select("slot_key", "slot_position")
    dt = broadcast_if_small(dim_date).select("date_key")
    df = (imp.join(cmp, "campaign_id")
          .join(adv, "advertiser_id")
          .join(slt, "slot_position")
          .join(dt, "date_key"))
    return conform(df, CONTRACTS["fct_ad_impressions"])


def fct_viewing_sessions(stg_sessions: DataFrame, dim_subscribers: DataFrame,
                         dim_content: DataFrame, dim_date: DataFrame) -> DataFrame:
    ses = attach_key(stg_sessions, dim_subscribers, "subscriber_key", "subscriber_id")
    ses = attach_key(ses, dim_content, "content_key", "content_id")
    dt = broadcast_if_small(dim_date).select("date_key")
    df = ses.withColumn("date_key", date_key("session_start")).join(dt, "date_key")
    return conform(df, CONTRACTS["fct_viewing_sessions"])


def campaign_daily_agg(fct_imp: DataFrame) -> DataFrame:
    """Campaign x day delivery: counts, filtered counts, spend, reach (A1).

    The exact distinct count is shuffled by (campaign, day, subscriber), so a hot
    campaign-day is spread over tasks.
    """
    return measured(fct_imp, ["campaign_key", "date_key"], {
        "impressions_served": one(), "impressions_viewable": one("is_viewable"),
        "impressions_completed": one("completed"), "revenue_usd": F.col("revenue_usd"),
    }, "unique_subscribers").withColumn("revenue_usd", F.col("revenue_usd").cast(MONEY_SUM))


def cumulative_spend(daily: DataFrame) -> DataFrame:
    """Running spend per campaign ordered by day.

    The input is already one row per campaign-day, so a partition holds at
    most one campaign's flight; date_key is unique within it, so the default
    RANGE frame equals this ROWS frame.
    """
    w = (Window.partitionBy("campaign_key").orderBy("date_key")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.withColumn("cumulative_spend", F.sum("revenue_usd").over(w).cast(MONEY_SUM))


def fct_campaign_daily(fct_imp: DataFrame, dim_campaigns: DataFrame,
                       dim_date: DataFrame) -> DataFrame:
    """Campaign x day pacing: aggregate, running spend, elapsed days, ratio, status.

    Impressions of unknown campaigns are dropped, so the aggregate's shuffles carry the
    number of a campaign in a small dimension instead of its key.
    """
    numbers = key_numbers(dim_campaigns, "campaign_key")
    agg = named_keys(campaign_daily_agg(numbered_keys(fct_imp, numbers, "campaign_key")),
                     numbers, "campaign_key")
    cmp = broadcast_if_small(dim_campaigns).select(
        "campaign_key", "total_budget_usd", "flight_days", "flight_start")
    dt = broadcast_if_small(dim_date).select("date_key", "full_date")
    cum = cumulative_spend(agg.join(cmp, "campaign_key").join(dt, "date_key"))
    cum = cum.withColumn("elapsed_days", elapsed_days("full_date", "flight_start"))
    # numerator and denominator as their own columns: each is computed once
    # and the rounding expression stays small
    num, den = pacing_terms("cumulative_spend", "total_budget_usd", "elapsed_days", "flight_days")
    cum = cum.withColumns({"_num": num, "_den": den})
    cum = cum.withColumn("budget_pacing_ratio", round_ratio("_num", "_den", 3, signed=True))
    cum = cum.withColumn("pacing_status", pacing_status("budget_pacing_ratio"))
    return conform(cum, CONTRACTS["fct_campaign_daily"])
