"""The model DAG: raw tables -> staging -> dimensions -> facts -> marts.

``Warehouse`` composes lazy DataFrames and memoises each model, so a model
read by several downstream models is one logical plan. With ``persist`` the
facts are written once to the shared checkpoint folder, which cuts their lineage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from adlens.operators import dims, facts, marts
from adlens.operators.staging import STAGING_SOURCES, stage


class _Staging(dict):
    """Staging views built on first use (each reads only its own raw table)."""

    def __init__(self, raw):
        super().__init__()
        self.raw = raw

    def __missing__(self, model: str) -> DataFrame:
        if model not in STAGING_SOURCES:
            raise KeyError(model)
        self[model] = df = stage(self.raw, model)
        return df


# Raw tables that grow with the data: lazy scans, never copied or cached whole.
ACTIVITY_TABLES = ("ad_requests", "ad_impressions", "viewing_sessions")


class LoadedTables(dict):
    """Raw tables built on first use.

    Activity tables stay lazy, so each query scans only the columns it uses;
    the small catalogs are cached.
    """

    def __init__(self, builders: dict):
        super().__init__()
        self.builders = builders

    def __missing__(self, name: str) -> DataFrame:
        df = self.builders[name]()
        self[name] = df = df if name in ACTIVITY_TABLES else df.cache()
        return df

    def __iter__(self):
        return iter(self.builders)

    def items(self):
        return [(k, self[k]) for k in self.builders]

    def keys(self):
        return list(self.builders)

    def __len__(self):
        return len(self.builders)


class Warehouse:
    """Lazily built models over a dict of raw tables.

    ``persist=True`` (used by the shared session warehouse) caches the
    dimensions and marts, whose sizes are bounded by catalogs and days, and
    writes each fact once to the shared checkpoint folder, so downstream
    models read a table with pruning and pushdown instead of re-running the
    star join, as a table-materialised model build would. With
    ``persist=False`` every model is a pure lazy plan.
    """

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], persist: bool = False):
        self.spark = spark
        self.raw = raw
        self.persist = persist

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, persist: bool = False) -> "Warehouse":
        from adlens.sources.testdata import TestdataBinding, bind_testdata
        if not persist:
            return cls(spark, bind_testdata(spark, sf_dir))
        binding = TestdataBinding(spark, sf_dir)
        from adlens.sources.schemas import RAW_SCHEMAS
        builders = {name: getattr(binding, name) for name in RAW_SCHEMAS}
        return cls(spark, LoadedTables(builders), persist=True)

    def _dim(self, df: DataFrame) -> DataFrame:
        return df.cache() if self.persist else df

    def _mart(self, df: DataFrame) -> DataFrame:
        # marts are aggregates bounded by days x campaigns / advertisers / genres
        return df.cache() if self.persist else df

    def _fact(self, name: str, df: DataFrame) -> DataFrame:
        if not self.persist:
            return df
        from adlens.session import scratch_path
        path = scratch_path(self.spark, name)
        # zstd: hashed keys and ids are most of a fact, and snappy leaves them as they are.
        # Not sorted by day: rows of a kilobyte in memory spill, for a smaller column or two.
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    # -- staging -------------------------------------------------------------
    @cached_property
    def stg(self) -> dict[str, DataFrame]:
        return _Staging(self.raw)

    # -- dimensions ----------------------------------------------------------
    @cached_property
    def dim_advertisers(self) -> DataFrame:
        return self._dim(dims.dim_advertisers(self.stg["stg_advertisers"]))

    @cached_property
    def dim_campaigns(self) -> DataFrame:
        return self._dim(dims.dim_campaigns(self.stg["stg_campaigns"], self.dim_advertisers))

    @cached_property
    def dim_content(self) -> DataFrame:
        return self._dim(dims.dim_content(self.stg["stg_content_catalog"]))

    @cached_property
    def dim_subscribers(self) -> DataFrame:
        return self._dim(dims.dim_subscribers(self.stg["stg_subscribers"]))

    @cached_property
    def dim_ad_slots(self) -> DataFrame:
        return self._dim(dims.dim_ad_slots(self.stg["stg_ad_slots"]))

    @cached_property
    def dim_date_ads(self) -> DataFrame:
        return self._dim(dims.dim_date_ads(self.raw["dates_ads"]))

    # -- facts ---------------------------------------------------------------
    @cached_property
    def fct_ad_impressions(self) -> DataFrame:
        return self._fact("fct_ad_impressions", facts.fct_ad_impressions(
            self.stg["stg_ad_impressions"], self.dim_campaigns, self.dim_advertisers,
            self.dim_subscribers, self.dim_content, self.dim_ad_slots, self.dim_date_ads))

    @cached_property
    def fct_viewing_sessions(self) -> DataFrame:
        return self._fact("fct_viewing_sessions", facts.fct_viewing_sessions(
            self.stg["stg_viewing_sessions"], self.dim_subscribers, self.dim_content,
            self.dim_date_ads))

    @cached_property
    def fct_campaign_daily(self) -> DataFrame:
        return self._fact("fct_campaign_daily", facts.fct_campaign_daily(
            self.fct_ad_impressions, self.dim_campaigns, self.dim_date_ads))

    # -- marts ---------------------------------------------------------------
    @cached_property
    def mart_platform_health(self) -> DataFrame:
        return self._mart(marts.mart_platform_health(
            self.stg["stg_ad_requests"], self.fct_ad_impressions,
            self.fct_viewing_sessions, self.dim_date_ads))

    @cached_property
    def mart_campaign_performance(self) -> DataFrame:
        return self._mart(marts.mart_campaign_performance(
            self.fct_campaign_daily, self.dim_campaigns, self.dim_advertisers))

    @cached_property
    def mart_advertiser_summary(self) -> DataFrame:
        return self._mart(marts.mart_advertiser_summary(self.fct_ad_impressions, self.dim_advertisers))

    @cached_property
    def mart_advertiser_concentration(self) -> DataFrame:
        return self._mart(marts.mart_advertiser_concentration(self.mart_advertiser_summary))

    @cached_property
    def mart_frequency_analysis(self) -> DataFrame:
        return self._mart(marts.mart_frequency_analysis(self.fct_ad_impressions, self.dim_campaigns))

    @cached_property
    def mart_content_monetization(self) -> DataFrame:
        return self._mart(marts.mart_content_monetization(self.fct_ad_impressions, self.dim_content))

    MODELS = [
        "dim_advertisers", "dim_campaigns", "dim_content", "dim_subscribers",
        "dim_ad_slots", "dim_date_ads", "fct_ad_impressions", "fct_viewing_sessions",
        "fct_campaign_daily", "mart_platform_health", "mart_campaign_performance",
        "mart_advertiser_summary", "mart_advertiser_concentration",
        "mart_frequency_analysis", "mart_content_monetization",
    ]

    def model(self, name: str) -> DataFrame:
        if name.startswith("stg_"):
            return self.stg[name]
        if name not in self.MODELS:
            raise KeyError(name)
        return getattr(self, name)
