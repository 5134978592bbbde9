"""Hot keys: one campaign, day and subscriber hold a third of all rows.

Results must stay exact (checked against a brute-force pandas computation)
and the plans must spread the hot group over tasks: the exact distinct reach
is shuffled on (campaign, day, subscriber) with a map-side partial aggregate
first, and the weighted allocation joins on (day, bucket), never on the day
alone.
"""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from adlens.operators import facts, marts, prep

N = 3000
HOT = N // 3


@pytest.fixture(scope="module")
def skewed(spark):
    rows = []
    for i in range(N):
        hot = i < HOT
        rows.append((
            "c-hot" if hot else f"c{i % 37}",
            20240101 if hot else 20240101 + i % 9,
            "s-hot" if hot else f"s{i % 211}",
            Decimal(i % 97) / Decimal(100),
            i % 3 == 0,
            i % 5 != 0,
        ))
    schema = ("campaign_key string, date_key int, subscriber_key string, "
              "revenue_usd decimal(12,6), is_viewable boolean, completed boolean")
    return spark.createDataFrame(rows, schema).repartition(8), pd.DataFrame(
        rows, columns=["campaign_key", "date_key", "subscriber_key", "revenue_usd",
                       "is_viewable", "completed"])


def plan_text(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_daily_aggregate_exact_under_hot_keys(spark, skewed, capsys):
    df, pdf = skewed
    got = {(r.campaign_key, r.date_key): (r.impressions_served, r.impressions_viewable,
                                          r.impressions_completed, r.revenue_usd,
                                          r.unique_subscribers)
           for r in facts.campaign_daily_agg(df).collect()}
    want = {}
    for (c, d), g in pdf.groupby(["campaign_key", "date_key"]):
        want[(c, d)] = (len(g), int(g.is_viewable.sum()), int(g.completed.sum()),
                        sum(g.revenue_usd, Decimal(0)), g.subscriber_key.nunique())
    assert got == want
    assert got[("c-hot", 20240101)][0] == HOT
    # the distinct reach is spread by subscriber before the per-group count
    plan = plan_text(facts.campaign_daily_agg(df), capsys)
    assert "hashpartitioning(campaign_key#" in plan
    first_exchange = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln][-1]
    assert "subscriber_key" in first_exchange and "partial_" in plan


def test_frequency_pairs_exact_under_hot_pair(spark, skewed):
    df, pdf = skewed
    caps = spark.createDataFrame(
        [(c, 2, f"name-{c}") for c in pdf.campaign_key.unique()],
        "campaign_key string, frequency_cap smallint, campaign_name string")
    got = {r.campaign_key: (r.total_subscribers, r.subscribers_exceeding_cap, r.total_violations)
           for r in marts.mart_frequency_analysis(df, caps).collect()}
    want = {}
    for c, g in pdf.groupby("campaign_key"):
        n = g.groupby("subscriber_key").size()
        want[c] = (len(n), int((n > 2).sum()), int((n[n > 2] - 2).sum()))
    assert got == want
    assert got["c-hot"] == (1, 1, HOT - 2)


def test_weighted_allocation_spreads_a_hot_day(spark, capsys):
    day = date(2024, 1, 1)
    ts = datetime(2024, 1, 1, 12, 0)
    n_hot = 2000
    reqs = [(f"r{i}", ts if i < n_hot else ts + timedelta(days=1 + i % 3)) for i in range(3000)]
    requests = spark.createDataFrame(reqs, "request_id string, request_timestamp timestamp")
    cands = [(day + timedelta(days=k), f"camp{j}", Decimal(100 + 50 * j))
             for k in range(4) for j in range(5)]
    candidates = spark.createDataFrame(cands, "day date, campaign_id string, "
                                              "total_budget_usd decimal(12,2)")
    out = prep.weighted_allocation(requests, candidates)
    rows = out.collect()
    # every request lands exactly once, on a campaign in flight that day
    assert sorted(r.request_id for r in rows) == sorted(r for r, _ in reqs)
    assert {(r.day, r.campaign_id) for r in rows} <= {(d, c) for d, c, _ in cands}
    # budget-weighted: the largest budget wins the most requests of the hot day
    hot = pd.Series([r.campaign_id for r in rows if r.day == day]).value_counts()
    assert hot.index[0] == "camp4" and hot.sum() == n_hot
    # the interval lookup is an equi-join on (day, bucket)
    plan = plan_text(out, capsys)
    assert any("Join" in ln and "bucket" in ln for ln in plan.splitlines())
