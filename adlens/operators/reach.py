"""Exact reach over any span of days and campaigns from bitmaps that merge.

A count of distinct subscribers cannot be added up: a week's reach is not the
sum of its days'. Here subscribers are numbered without gaps, and each group
(a day, a campaign's day) keeps the set of numbers it reached as bitmaps of
64 bits, one long each: a group that reached few holds few of them, and they are
aggregated by hash in fixed memory. Sets of any coarser group are the union of the finer ones, so the
impressions are read once and every later count reads bitmaps only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.joins import broadcast_if_small, is_small
from adlens.functions.packed import packed_text
from adlens.functions.running import numbered

BITS = 64   # subscriber numbers a bitmap holds


def one(flag: str | None = None) -> Column:
    """1 for each row, or for each whose flag is true, else 0."""
    return (F.lit(1) if flag is None else F.when(F.col(flag), 1).otherwise(0)).cast("long")


def measured(fct_imp: DataFrame, by: list[str], measures: dict[str, Column],
             people: str) -> DataFrame:
    """(*by, *measures, people): sums over impressions and the exact distinct subscribers.

    The sums are combined before their shuffle; the distinct ones are shuffled by (group,
    subscriber) with nothing but the packed key, so a hot group is spread over tasks. Both
    meet in the sums by group, null groups included.
    """
    names = list(measures)
    shown = fct_imp.select(*by, *[m.alias(n) for n, m in measures.items()],
                           F.lit(0).cast("long").alias(people))
    met = fct_imp.where("subscriber_key IS NOT NULL").select(
        *by, packed_text("subscriber_key").alias("subscriber_key")).distinct()
    nothing = [F.lit(None).cast(shown.schema[n].dataType).alias(n) for n in names]
    return shown.unionAll(met.select(*by, *nothing, F.lit(1).cast("long").alias(people))).groupBy(
        *by).agg(*[F.sum(n).alias(n) for n in [*names, people]])


def number_subscribers(dim_subscribers: DataFrame) -> DataFrame:
    """(subscriber_key, subscriber_no): 0, 1, 2... by key. Keys must be unique."""
    return numbered(dim_subscribers.select("subscriber_key"), "subscriber_key", "subscriber_no")


def reach_bitmaps(fct_imp: DataFrame, dim_subscribers: DataFrame, by: list[str]) -> DataFrame:
    """(*by, bucket, people): who was reached in each group, a bitmap (long) for
    each 64 subscriber numbers that holds any.

    Every task sets its own bits first, so a hot group is shuffled as one
    bitmap a bucket and task, whatever its impressions. The numbers are
    broadcast while subscribers are under the size bound, else joined by key.
    Impressions of unknown subscribers reach nobody; null groups are groups.
    """
    numbers = number_subscribers(dim_subscribers)
    if is_small(dim_subscribers.select("subscriber_key")):
        numbers = F.broadcast(numbers)
    shown = fct_imp.select(*by, "subscriber_key").join(numbers, "subscriber_key")
    bit = F.expr(f"shiftleft(1L, CAST(subscriber_no % {BITS} AS INT))")
    return shown.groupBy(*by, F.expr(f"subscriber_no DIV {BITS}").alias("bucket")).agg(
        F.bit_or(bit).alias("people"))


def merge_bitmaps(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """The bitmaps of coarser groups: the union over everything but ``by``."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bit_or("people").alias("people"))


def reach(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """(*by, reach): distinct subscribers of each coarser group."""
    return merge_bitmaps(bitmaps, by).groupBy(*by).agg(
        F.sum(F.bit_count("people")).alias("reach"))


def weekly_reach(daily_bitmaps: DataFrame, dim_date: DataFrame) -> DataFrame:
    """(week_start, reach) of the weeks from Monday, from bitmaps by day."""
    weeks = broadcast_if_small(dim_date).select(
        "date_key", F.date_trunc("week", "full_date").cast("date").alias("week_start"))
    return reach(daily_bitmaps.join(weeks, "date_key"), ["week_start"])


def advertiser_weekly_reach(campaign_bitmaps: DataFrame, dim_campaigns: DataFrame,
                            dim_date: DataFrame) -> DataFrame:
    """(advertiser_key, week_start, reach) from bitmaps by campaign and day: merged
    across an advertiser's campaigns and the days of a week at once."""
    owner = broadcast_if_small(dim_campaigns).select("campaign_key", "advertiser_key")
    weeks = broadcast_if_small(dim_date).select(
        "date_key", F.date_trunc("week", "full_date").cast("date").alias("week_start"))
    of = campaign_bitmaps.join(owner, "campaign_key").join(weeks, "date_key")
    return reach(of, ["advertiser_key", "week_start"])
