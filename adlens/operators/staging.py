"""Staging projections: one lazy 1:1 column list per raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adlens.sources.schemas import RAW_SCHEMAS

# Raw table each staging model reads. dates_ads has no staging model.
STAGING_SOURCES = {
    "stg_ad_impressions": "ad_impressions",
    "stg_ad_requests": "ad_requests",
    "stg_viewing_sessions": "viewing_sessions",
    "stg_campaigns": "campaigns",
    "stg_advertisers": "advertisers",
    "stg_subscribers": "subscribers",
    "stg_content_catalog": "content_catalog",
    "stg_ad_slots": "ad_slots",
}


def stage(raw: dict[str, DataFrame], model: str) -> DataFrame:
    """The staging view ``model``: the declared columns of its raw table."""
    source = STAGING_SOURCES[model]
    return raw[source].select(*RAW_SCHEMAS[source].fieldNames())


def staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {model: stage(raw, model) for model in STAGING_SOURCES}
