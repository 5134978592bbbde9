"""Declared schemas: the nine raw tables and the enforced mart contracts.

Raw columns are positional (CSV order) and all NOT NULL; each table's primary
key is its first column. Mart contracts list name and Spark type per column.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, SH, I, L = T.StringType(), T.ShortType(), T.IntegerType(), T.LongType()
B, D, TS = T.BooleanType(), T.DateType(), T.TimestampNTZType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "ad_slots": struct(
        ("slot_position", S), ("typical_duration_sec", SH),
        ("avg_completion_rate", dec(5, 2)), ("avg_viewability", dec(5, 2))),
    "advertisers": struct(
        ("advertiser_id", S), ("company_name", S), ("industry_vertical", S),
        ("spend_tier", S), ("country", S)),
    "content_catalog": struct(
        ("content_id", S), ("title", S), ("content_type", S), ("genre", S),
        ("avg_episode_minutes", SH), ("maturity_rating", S)),
    "subscribers": struct(
        ("subscriber_id", S), ("subscription_tier", S), ("signup_date", D),
        ("region", S), ("device_primary", S), ("age_band", S)),
    "campaigns": struct(
        ("campaign_id", S), ("advertiser_id", S), ("campaign_name", S), ("objective", S),
        ("daily_budget_usd", dec(12, 2)), ("total_budget_usd", dec(12, 2)),
        ("flight_start", D), ("flight_end", D), ("flight_days", SH),
        ("frequency_cap", SH), ("pacing_goal", S), ("status", S)),
    "dates_ads": struct(
        ("date_key", I), ("full_date", D), ("day_of_week", S), ("is_weekend", B),
        ("week_of_year", SH), ("month_name", S), ("quarter", S), ("year", SH)),
    "viewing_sessions": struct(
        ("session_id", S), ("subscriber_id", S), ("content_id", S),
        ("session_start", TS), ("device", S), ("watch_seconds", I),
        ("deepest_slot", S), ("ad_requests", SH)),
    "ad_requests": struct(
        ("request_id", S), ("session_id", S), ("subscriber_id", S), ("content_id", S),
        ("slot_position", S), ("request_timestamp", TS), ("device", S),
        ("was_filled", B)),
    "ad_impressions": struct(
        ("impression_id", S), ("request_id", S), ("campaign_id", S),
        ("advertiser_id", S), ("subscriber_id", S), ("content_id", S),
        ("slot_position", S), ("device", S), ("bid_price_usd", dec(12, 6)),
        ("revenue_usd", dec(12, 6)), ("is_viewable", B), ("completed", B),
        ("view_duration_sec", SH), ("impression_timestamp", TS)),
}

# FIXED VALUES: the longest text that each raw column holds, in characters.
RAW_LENGTHS: dict[str, dict[str, int]] = {
    "ad_slots": {"slot_position": 20},
    "advertisers": {"advertiser_id": 20, "company_name": 200, "industry_vertical": 50,
                    "spend_tier": 20, "country": 10},
    "content_catalog": {"content_id": 20, "title": 500, "content_type": 20, "genre": 50,
                        "maturity_rating": 10},
    "subscribers": {"subscriber_id": 20, "subscription_tier": 20, "region": 20,
                    "device_primary": 20, "age_band": 10},
    "campaigns": {"campaign_id": 20, "advertiser_id": 20, "campaign_name": 500,
                  "objective": 20, "pacing_goal": 20, "status": 20},
    "dates_ads": {"day_of_week": 10, "month_name": 10, "quarter": 5},
    "viewing_sessions": {"session_id": 20, "subscriber_id": 20, "content_id": 20,
                         "device": 20, "deepest_slot": 20},
    "ad_requests": {"request_id": 20, "session_id": 20, "subscriber_id": 20,
                    "content_id": 20, "slot_position": 20, "device": 20},
    "ad_impressions": {"impression_id": 20, "request_id": 20, "campaign_id": 20,
                       "advertiser_id": 20, "subscriber_id": 20, "content_id": 20,
                       "slot_position": 20, "device": 20},
}

# Load order: dimensions before the tables that reference them.
RAW_TABLES = list(RAW_SCHEMAS)

PRIMARY_KEYS = {name: schema.fieldNames()[0] for name, schema in RAW_SCHEMAS.items()}

# Types used for unconstrained numerics in the marts.
MONEY_SUM = dec(38, 6)

CONTRACTS: dict[str, T.StructType] = {
    "dim_advertisers": struct(
        ("advertiser_key", S), ("advertiser_id", S), ("company_name", S),
        ("industry_vertical", S), ("spend_tier", S), ("country", S)),
    "dim_content": struct(
        ("content_key", S), ("content_id", S), ("title", S), ("content_type", S),
        ("genre", S), ("avg_episode_minutes", SH), ("maturity_rating", S)),
    "dim_subscribers": struct(
        ("subscriber_key", S), ("subscriber_id", S), ("subscription_tier", S),
        ("signup_date", D), ("region", S), ("device_primary", S), ("age_band", S)),
    "dim_campaigns": struct(
        ("campaign_key", S), ("campaign_id", S), ("advertiser_key", S),
        ("campaign_name", S), ("objective", S), ("daily_budget_usd", dec(12, 2)),
        ("total_budget_usd", dec(12, 2)), ("flight_start", D), ("flight_end", D),
        ("flight_days", SH), ("frequency_cap", SH), ("pacing_goal", S), ("status", S)),
    "dim_ad_slots": struct(
        ("slot_key", S), ("slot_position", S), ("typical_duration_sec", SH),
        ("avg_completion_rate", dec(5, 2)), ("avg_viewability", dec(5, 2))),
    "dim_date_ads": struct(
        ("date_key", I), ("full_date", D), ("day_of_week", S), ("is_weekend", B),
        ("week_of_year", SH), ("month_name", S), ("quarter", S), ("year", SH)),
    "fct_ad_impressions": struct(
        ("impression_id", S), ("request_id", S), ("campaign_key", S),
        ("advertiser_key", S), ("subscriber_key", S), ("content_key", S),
        ("slot_key", S), ("date_key", I), ("bid_price_usd", dec(12, 6)),
        ("revenue_usd", dec(12, 6)), ("is_viewable", B), ("completed", B),
        ("view_duration_sec", SH), ("device", S), ("impression_timestamp", TS)),
    "fct_campaign_daily": struct(
        ("campaign_key", S), ("date_key", I), ("impressions_served", L),
        ("impressions_viewable", L), ("impressions_completed", L),
        ("revenue_usd", MONEY_SUM), ("unique_subscribers", L),
        ("total_budget_usd", dec(12, 2)), ("cumulative_spend", MONEY_SUM),
        ("elapsed_days", I), ("flight_days", SH), ("budget_pacing_ratio", dec(18, 3)),
        ("pacing_status", S)),
    "fct_viewing_sessions": struct(
        ("session_id", S), ("subscriber_key", S), ("content_key", S), ("date_key", I),
        ("watch_seconds", I), ("deepest_slot", S), ("ad_requests", SH), ("device", S),
        ("session_start", TS)),
}
