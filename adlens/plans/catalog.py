"""Registry of named queries: key -> (spark, sf_dir) -> DataFrame, plus the
DuckDB oracle SQL for each key that has one.

Each query starts from the given test tables through the binding, so its
work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlens.plans import oracle as O
from adlens.plans.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[key] = fn
        if oracle is not None:
            _ORACLES[key] = oracle
        return fn
    return deco


_WAREHOUSES: dict[tuple[int, str], Warehouse] = {}


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The session's warehouse over ``sf_dir``: dimensions cached, facts
    written once and shared by every query of the session."""
    key = (id(spark), sf_dir)
    w = _WAREHOUSES.get(key)
    if w is None or w.spark is not spark:
        w = Warehouse.from_testdata(spark, sf_dir, persist=True)
        _WAREHOUSES[key] = w
    return w


def _model_query(name: str) -> Query:
    return lambda spark, sf_dir: wh(spark, sf_dir).model(name)


# The six ad slots are a fixed list, so their two models are no queries.
MODEL_KEYS = [
    "stg_ad_impressions", "stg_ad_requests", "stg_viewing_sessions", "stg_campaigns",
    "stg_advertisers", "stg_subscribers", "stg_content_catalog",
    "dim_advertisers", "dim_campaigns", "dim_content", "dim_subscribers",
    "dim_date_ads", "fct_ad_impressions", "fct_viewing_sessions", "fct_campaign_daily",
    "mart_platform_health", "mart_campaign_performance", "mart_advertiser_summary",
    "mart_advertiser_concentration", "mart_frequency_analysis", "mart_content_monetization",
]

for _name in MODEL_KEYS:
    register(_name, O.with_prelude(f"SELECT * FROM {_name}"))(_model_query(_name))


def queries() -> dict[str, Query]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # importing these modules registers their queries
    from adlens.plans import queries_extra  # noqa: F401
