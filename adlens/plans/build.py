"""Full build: every model materialised, contracts enforced, every check and
reconciliation run; the build fails on any failing check.

This is the one call that turns raw tables into a verified warehouse. Facts are
staged in the shared folder and every check reads the staged tables; only then
are the models published under ``out_dir``, all together (``plans/publish``), so a
failing or killed build leaves the published tables as they were. The rows behind
failing checks are published beside the models.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators import failures, quality, recon
from adlens.plans.publish import publish
from adlens.plans.warehouse import Warehouse
from adlens.sources.schemas import CONTRACTS

# The facts, laid out by day, each with the column that spreads a busy day.
FACTS = {"fct_ad_impressions": "impression_id", "fct_viewing_sessions": "session_id",
         "fct_campaign_daily": "campaign_key"}

RECONCILIATIONS = {
    "recon_revenue_share": lambda w: recon.recon_revenue_share(w.mart_advertiser_summary),
    "recon_elapsed_days": lambda w: recon.recon_elapsed_days(
        w.fct_campaign_daily, w.dim_date_ads, w.dim_campaigns),
    "recon_hhi": lambda w: recon.recon_hhi(w.mart_advertiser_concentration,
                                           w.mart_advertiser_summary),
    "recon_filled": lambda w: recon.recon_filled(w.stg["stg_ad_requests"], w.fct_ad_impressions),
    "recon_pacing_ratio": lambda w: recon.recon_pacing_ratio(w.fct_campaign_daily),
    "recon_pacing_status": lambda w: recon.recon_pacing_status(w.fct_campaign_daily),
    "recon_platform_health": lambda w: recon.recon_platform_health(
        w.mart_platform_health, w.fct_ad_impressions),
    "recon_rpsh": lambda w: recon.recon_rpsh(
        w.mart_platform_health, w.fct_ad_impressions, w.fct_viewing_sessions),
}


@dataclass
class BuildResult:
    warehouse: Warehouse
    checks: DataFrame          # one row per declarative check
    reconciliations: DataFrame  # (name, failing_rows)


def reconciliation_summary(w: Warehouse) -> DataFrame:
    parts = [fn(w).agg(F.count_if(~F.col("passed")).alias("failing_rows"))
             .select(F.lit(name).alias("name"), "failing_rows")
             for name, fn in RECONCILIATIONS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build(spark: SparkSession, raw: dict[str, DataFrame], out_dir: str | None = None,
          fail_on_error: bool = True) -> BuildResult:
    w = Warehouse(spark, raw, persist=True)
    for name in Warehouse.MODELS:
        if name in CONTRACTS:
            quality.enforce_contract(name, w.model(name), CONTRACTS[name])
    checks = quality.run_checks(w.model)
    recons = reconciliation_summary(w)
    if fail_on_error:
        quality.assert_clean(checks)
        bad = recons.filter(F.col("failing_rows") > 0).collect()   # at most 8 rows
        if bad:
            raise AssertionError("reconciliations failed: " +
                                 ", ".join(f"{r.name} ({r.failing_rows})" for r in bad))
    if out_dir:
        tables = {name: w.model(name) for name in Warehouse.MODELS}
        tables["dq_failing_rows"] = failures.failing_rows(w.model)
        tables["recon_failing_rows"] = failures.failing_reconciliations(
            {name: fn(w) for name, fn in RECONCILIATIONS.items()})
        publish(spark, tables, out_dir, FACTS)
    return BuildResult(w, checks, recons)
