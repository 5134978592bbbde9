"""Data-preparation jobs: campaign status and labels, audience filter, session
expansion into ad requests, in-flight candidates, budget-weighted allocation,
budget calibration, clearing prices and the platform summaries.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens import constants as C
from adlens.functions.exprs import col, date_key, lookup, micros, pick, round_ratio
from adlens.functions.joins import literal_table, with_totals
from adlens.functions.running import running_total
from adlens.sources.schemas import MONEY_SUM

UNIT_BITS = 60          # allocation draws are 60-bit integers in [0, 2^60)
BUCKET_BITS = 10        # 1024 equi-join buckets per day for interval lookup
NO_DAY = -(1 << 31)     # stands for a null day, long before any date
SLICE_BLOCKS = 16       # blocks of campaigns in which a day's budgets are added up


def campaign_status(flight_start: str | Column, flight_end: str | Column,
                    as_of: date | str | Column) -> Column:
    """completed if the flight ended before ``as_of``, active if it started by
    then, else scheduled (G1)."""
    asof = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return (F.when(col(flight_end) < asof, F.lit("completed"))
            .when(col(flight_start) <= asof, F.lit("active"))
            .otherwise(F.lit("scheduled")))


def campaign_label(objective: str | Column, prefix_idx: str | Column,
                   vertical: str | Column, flight_start: str | Column) -> Column:
    """'<prefix> - <vertical short> Q<n> <year>' (G3).

    The prefix is the ``prefix_idx``-th name of the objective's list, or
    "Campaign" for an objective without a list.
    """
    prefix = F.lit("Campaign")
    for obj, names in C.CAMPAIGN_PREFIXES.items():
        prefix = F.when(col(objective) == obj, pick(names, col(prefix_idx))).otherwise(prefix)
    short = F.coalesce(lookup(C.VERTICAL_SHORT, col(vertical)), F.substring(col(vertical), 1, 5))
    fs = col(flight_start)
    return F.concat(prefix, F.lit(" - "), short, F.lit(" Q"), F.quarter(fs).cast("string"),
                    F.lit(" "), F.year(fs).cast("string"))


def ad_supported_audience(subscribers: DataFrame) -> DataFrame:
    """Subscribers who see ads: every tier except the no-ads one."""
    return subscribers.filter(F.col("subscription_tier") != C.NO_ADS_TIER)


def slot_table(spark: SparkSession) -> DataFrame:
    """The six slots with their firing depth and time fraction (hundredths)."""
    rows = [(name, i, int(Decimal(frac) * 100)) for i, (name, _, _, _, frac)
            in enumerate(C.AD_SLOTS)]
    return literal_table(spark, rows, [("slot_position", "string"), ("slot_depth", "int"),
                                       ("frac_pct", "int")])


def expand_sessions(sessions: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Session -> the ad requests it passed through.

    A session emits every slot up to its deepest one, in order; a request's
    time is the session start plus the slot's fraction of the watch time.
    A per-row explode of the slot-order prefix: no join and no shuffle. A
    session whose deepest slot is not a known slot emits nothing.
    """
    names = F.array(*[F.lit(name) for name in C.SLOT_ORDER])
    fracs = F.array(*[F.lit(int(Decimal(frac) * 100)) for *_, frac in C.AD_SLOTS])
    n_slots = F.array_position(names, F.col("deepest_slot")).cast("int")   # 0 when unknown
    s = sessions.filter(n_slots > 0)
    df = s.select("*", F.explode(F.sequence(F.lit(0), n_slots - 1)).alias("slot_depth"))
    df = df.withColumns({
        "slot_position": F.element_at(names, F.col("slot_depth") + 1),
        "frac_pct": F.element_at(fracs, F.col("slot_depth") + 1),
    })
    offset_us = F.col("watch_seconds").cast("long") * F.col("frac_pct") * F.lit(10_000)
    return df.select(
        F.concat_ws("-", "session_id", F.col("slot_depth").cast("string")).alias("request_id"),
        "session_id", "subscriber_id", "content_id", "slot_position",
        F.timestamp_add("MICROSECOND", offset_us, F.col("session_start")).alias("request_timestamp"),
        "device",
    )


def flight_days_exploded(campaigns: DataFrame) -> DataFrame:
    """One row per campaign per day of its flight (inclusive both ends). A flight
    without a start or an end, or that ends before it starts, has no days."""
    return campaigns.filter("flight_start <= flight_end").select(
        "campaign_id", "total_budget_usd",
        F.explode(F.sequence("flight_start", "flight_end")).alias("day"))


def _asked_days(days: DataFrame) -> DataFrame:
    """(asked): the distinct given days as numbers, a null day as ``NO_DAY``. At
    most one row a calendar date; never null, so that no reader adds a filter
    and all of them share one scan of ``days``."""
    return days.select(F.coalesce(F.unix_date(F.col("day").cast("date")),
                                  F.lit(NO_DAY)).alias("asked")).distinct()


def uncovered_days(days: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The given days on which no campaign is in flight, once each.

    A sweep over the flights' ends: each flight opens on its first day and
    closes after its last, so the openings less the closings up to a day are
    the flights open on it. They are summed by date before the sweep, which
    therefore sees at most two rows a calendar date, however many campaigns
    there are. A null day is never covered.
    """
    return _uncovered(_asked_days(days), campaigns)


def _uncovered(asked: DataFrame, campaigns: DataFrame) -> DataFrame:
    first, after = F.unix_date("flight_start"), F.unix_date(F.date_add("flight_end", 1))
    ends = F.array(F.struct(first.alias("at"), F.lit(1).alias("opened")),
                   F.struct(after.alias("at"), F.lit(-1).alias("opened")))
    steps = (campaigns.filter("flight_start <= flight_end").select(F.inline(ends))
             .groupBy("at").agg(F.sum("opened").alias("opened")).withColumn("question", F.lit(False)))
    questions = asked.select(F.col("asked").alias("at"), F.lit(0).cast("long").alias("opened"),
                             F.lit(True).alias("question"))
    sweep = Window.orderBy("at", "question").rowsBetween(Window.unboundedPreceding,
                                                         Window.currentRow)
    swept = steps.unionAll(questions).withColumn("open", F.sum("opened").over(sweep))
    return swept.filter("question AND open = 0").select(
        F.when(F.col("at") != NO_DAY, F.date_from_unix_date("at")).alias("day"))


def in_flight_candidates(days: DataFrame, campaigns: DataFrame, strict: bool = True) -> DataFrame:
    """Campaigns in flight on each given day.

    Range containment flight_start <= day <= flight_end without a range join
    and without a shuffle of the result: the given days, at most one row a
    calendar date, are broadcast to the campaigns, each exploded into the days
    of its flight where it lies. A day without any campaign in flight
    (``uncovered_days``) keeps one row with a null campaign; with ``strict`` it
    fails the call (``require_covered``).
    """
    asked = _asked_days(days)
    inside = flight_days_exploded(campaigns).join(
        F.broadcast(asked), F.unix_date("day") == F.col("asked")).select(
        "day", "campaign_id", "total_budget_usd")
    out = inside.unionByName(_uncovered(asked, campaigns), allowMissingColumns=True)
    if strict:
        require_covered(out)
    return out


def require_covered(candidates: DataFrame) -> None:
    """Fail unless every day of ``candidates`` has a campaign in flight.

    A job of its own (at most ten days reach the driver), so a caller that
    reads only some columns of the candidates cannot skip it.
    """
    lost = (candidates.filter("campaign_id IS NULL").select("day")
            .orderBy("day").limit(10).collect())
    if lost:
        raise ValueError("no campaign in flight on " + ", ".join(str(r.day) for r in lost))


def unit_draw(key: str | Column) -> Column:
    """Deterministic draw in [0, 2^60): the first 60 bits of md5(key)."""
    return F.conv(F.substring(F.md5(col(key).cast("string")), 1, UNIT_BITS // 4), 16, 10).cast("long")


def allocation_slices(candidates: DataFrame) -> DataFrame:
    """Each day's campaigns, ordered by id, as consecutive half-open slices
    [lo, hi) of [0, 2^60) proportional to their budgets.

    No positive budget gets an empty slice while a day's budgets sum to at most
    2^60 cents; a budget of nothing gets none. Campaigns are once a day. The
    budgets before each one are a running total over blocks of campaigns, so a
    day of very many campaigns is not one task's.
    """
    unit = 1 << UNIT_BITS
    cents = (F.col("total_budget_usd") * 100).cast("long")
    c = candidates.filter("campaign_id IS NOT NULL").select(
        "day", "campaign_id", cents.alias("cents")).filter("cents > 0")
    c = running_total(c, ["day"], "campaign_id", "cents", "lo_c", "day_total", SLICE_BLOCKS)
    lo_c = F.col("lo_c").cast("decimal(38,0)")
    total = F.col("day_total").cast("decimal(38,0)")
    return c.select("day", "campaign_id",
                    F.call_function("div", lo_c * F.lit(unit), total).alias("lo"),
                    F.call_function("div", (lo_c + F.col("cents")) * F.lit(unit), total).alias("hi"))


def weighted_allocation(requests: DataFrame, candidates: DataFrame) -> DataFrame:
    """Assign each request to one in-flight campaign, weighted by budget.

    A request takes the slice of its day (``allocation_slices``) that holds its
    draw. The interval lookup is an equi-join on (day, bucket): each slice is
    exploded into the 1024-ths of the range it overlaps, so a request meets
    about one candidate rather than every campaign of its day.

    Every request has one row: one on a day without a campaign in flight keeps
    a null campaign, with the reason beside it.
    """
    shift = UNIT_BITS - BUCKET_BITS
    c = allocation_slices(candidates)
    c = c.select("*", F.explode(F.sequence(F.shiftright("lo", shift),
                                           F.shiftright(F.col("hi") - 1, shift))).alias("bucket"))
    r = requests.select("request_id", F.to_date("request_timestamp").alias("day"),
                        unit_draw("request_id").alias("u"))
    r = r.withColumn("bucket", F.shiftright("u", shift))
    slices = c.select(F.col("day").alias("c_day"), F.col("bucket").alias("c_bucket"),
                      "campaign_id", "lo", "hi")
    inside = (F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))
    j = r.join(slices, (F.col("day") == F.col("c_day"))
               & (F.col("bucket") == F.col("c_bucket")) & inside, "left")
    return j.select("request_id", "day", "campaign_id", F.when(
        F.col("campaign_id").isNull(), F.lit(C.NO_CAMPAIGN_IN_FLIGHT)).alias("unallocated_reason"))


def calibrate_budgets(campaigns: DataFrame, impressions: DataFrame,
                      target_pct: str | Column) -> DataFrame:
    """Restate budgets from delivery.

    total = round(max(delivered / target, 0.10 * flight_days), 2) with target
    a per-campaign percentage column; daily = round(total / flight_days, 2).
    A campaign with no delivery gets the floor.
    """
    delivered = impressions.groupBy("campaign_id").agg(
        F.sum("revenue_usd").cast(MONEY_SUM).alias("delivered"))
    df = campaigns.join(delivered, "campaign_id", "left")
    target = col(target_pct)
    # delivered / (target / 100) in dollars = micros * 100 / (target * 10^6)
    by_target = round_ratio(micros(F.coalesce("delivered", F.lit(0))) * 100,
                            target * F.lit(1_000_000), 2, 12)
    floor = (F.col("flight_days") * F.lit(Decimal("0.10"))).cast("decimal(12,2)")
    total = F.greatest(by_target, floor)
    df = df.withColumn("total_budget_usd", total)
    daily = round_ratio((F.col("total_budget_usd") * 100).cast("decimal(38,0)"),
                        F.col("flight_days") * 100, 2, 12)
    return df.withColumn("daily_budget_usd", daily)


def clearing_revenue(cents: str | Column, discount_pct: str | Column) -> tuple[Column, Column]:
    """Per-impression price from a CPM bid in cents, and the cleared revenue
    after a second-price discount (G8): price = CPM / 1000,
    revenue = price * (100 - discount%) / 100, both to 6 dp."""
    c = col(cents).cast("decimal(38,0)")
    price = round_ratio(c, F.lit(100_000), 6)
    revenue = round_ratio(c * (F.lit(100) - col(discount_pct)), F.lit(10_000_000), 6)
    return price, revenue


def platform_summary(impressions: DataFrame, requests: DataFrame) -> DataFrame:
    """eCPM, completion, viewability, mean bid CPM, fill rate in one pass each."""
    imp = impressions.agg(
        F.count(F.lit(1)).alias("impressions"),
        F.sum("revenue_usd").cast(MONEY_SUM).alias("revenue"),
        F.sum("bid_price_usd").cast(MONEY_SUM).alias("bids"),
        F.count_if("completed").alias("n_completed"),
        F.count_if("is_viewable").alias("n_viewable"))
    req = requests.agg(F.count(F.lit(1)).alias("requests"),
                       F.count_if("was_filled").alias("filled"))
    df = with_totals(imp, req)
    return df.select(
        round_ratio(micros("revenue"), F.col("impressions") * 1000, 2).alias("ecpm_usd"),
        round_ratio(F.col("n_completed") * 100, "impressions", 1).alias("completion_rate_pct"),
        round_ratio(F.col("n_viewable") * 100, "impressions", 1).alias("viewability_rate_pct"),
        round_ratio(micros("bids"), F.col("impressions") * 1000, 2).alias("avg_bid_cpm_usd"),
        round_ratio(F.col("filled") * 100, "requests", 1).alias("fill_rate_pct"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of one column."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def viewing_summary(sessions: DataFrame) -> DataFrame:
    """Total viewing hours (1 dp) and mean session minutes (2 dp)."""
    agg = sessions.agg(F.sum("watch_seconds").alias("secs"), F.count(F.lit(1)).alias("n"))
    return agg.select(
        round_ratio("secs", F.lit(3600), 1).alias("viewing_hours"),
        round_ratio("secs", F.col("n") * 60, 2).alias("mean_session_minutes"),
        F.col("n").alias("sessions"))
