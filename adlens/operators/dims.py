"""Conformed dimensions (surrogate keys + attributes) and the calendar builder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions.exprs import surrogate_key
from adlens.functions.joins import broadcast_if_small, conform
from adlens.sources.schemas import CONTRACTS, RAW_SCHEMAS


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day in [start, end] with its calendar attributes (dates_ads)."""
    return calendar_between(spark.range(1).select(F.lit(start).alias("start_date"),
                                                  F.lit(end).alias("end_date")))


def calendar_between(bounds: DataFrame) -> DataFrame:
    """Calendar rows for every day in [start_date, end_date] of each row of
    ``bounds`` (typically one row of bounds computed from the data)."""
    days = bounds.select(
        F.explode(F.sequence(F.col("start_date"), F.col("end_date"), F.expr("interval 1 day")))
        .alias("full_date"))
    d = F.col("full_date")
    df = days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"),
        d,
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.year(d).alias("year"),
    )
    return conform(df, RAW_SCHEMAS["dates_ads"])


def dim_advertisers(stg_advertisers: DataFrame) -> DataFrame:
    df = stg_advertisers.select(surrogate_key("advertiser_id").alias("advertiser_key"), "*")
    return conform(df, CONTRACTS["dim_advertisers"])


def dim_campaigns(stg_campaigns: DataFrame, dim_adv: DataFrame) -> DataFrame:
    """Campaigns carrying their advertiser's key; inner join drops orphans."""
    adv = broadcast_if_small(dim_adv).select("advertiser_key", "advertiser_id")
    df = (stg_campaigns.join(adv, "advertiser_id")
          .select(surrogate_key("campaign_id").alias("campaign_key"), "*"))
    return conform(df, CONTRACTS["dim_campaigns"])


def dim_content(stg_content: DataFrame) -> DataFrame:
    df = stg_content.select(surrogate_key("content_id").alias("content_key"), "*")
    return conform(df, CONTRACTS["dim_content"])


def dim_subscribers(stg_subscribers: DataFrame) -> DataFrame:
    df = stg_subscribers.select(surrogate_key("subscriber_id").alias("subscriber_key"), "*")
    return conform(df, CONTRACTS["dim_subscribers"])


def dim_ad_slots(stg_ad_slots: DataFrame) -> DataFrame:
    df = stg_ad_slots.select(surrogate_key("slot_position").alias("slot_key"), "*")
    return conform(df, CONTRACTS["dim_ad_slots"])


def dim_date_ads(dates_ads: DataFrame) -> DataFrame:
    return conform(dates_ads, CONTRACTS["dim_date_ads"])
