"""Binding of the TPC-H-style test tables to the nine raw ad-delivery tables.

Each raw table is a Spark projection/aggregation of the given parquet tables,
so its size grows with them. Money is derived in integer arithmetic (cents and
micro-dollars) so every engine computes the same exact decimals.

The same binding is written as DuckDB SQL in ``adlens.plans.oracle`` for the
correctness oracle; the two must stay in step.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens import constants as C
from adlens.functions.exprs import date_key, pick, round_ratio
from adlens.functions.joins import conform, literal_table, spread, with_totals
from adlens.functions.packed import look_up
from adlens.sources.schemas import RAW_SCHEMAS

# FIXED VALUES of the binding.
FILL_DISCOUNT = 0.02            # a request is filled when l_discount >= this
STATUS_AS_OF = date(1998, 6, 30)
FLIGHT_ORIGIN = date(1995, 1, 2)
SESSION_WINDOW_START = date(1995, 1, 1)      # the window the session audit demands
SESSION_WINDOW_END = date(2001, 12, 31)
TIER_BY_SEGMENT = {
    "FURNITURE": "premium_no_ads",
    "BUILDING": "ads_basic",
    "AUTOMOBILE": "ads_basic",
    "HOUSEHOLD": "ads_standard",
    "MACHINERY": "ads_standard",
}
COUNTRIES = ["US", "CA", "GB"]

TPCH_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


# Tables that grow with the data; their scans are spread over the cluster when
# stored in too few splits (see ``spread``).
LARGE_TABLES = {"lineitem", "orders"}


def read_tpch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _device_from_priority(priority: F.Column) -> F.Column:
    # '1-URGENT' .. '5-LOW' -> DEVICES[0..4]
    return pick(C.DEVICES, F.substring(priority, 1, 1).cast("int") - 1)


def _brand_number(brand: F.Column) -> F.Column:
    return F.substring_index(brand, "#", -1).cast("int")


def _tier_from_segment(seg: F.Column) -> F.Column:
    expr = None
    for k, v in TIER_BY_SEGMENT.items():
        expr = (F.when(seg == k, v) if expr is None else expr.when(seg == k, v))
    return expr


def _packed_flags() -> F.Column:
    """Line number (32 bits and one for null), seconds viewed (16; of a null quantity
    30, as ``least`` skips nulls) and two nullable flags as one long for the shuffle."""
    return F.expr(
        "shiftleft(CAST(coalesce(l_linenumber, 0) AS BIGINT), 22)"
        " | shiftleft(CAST(CAST(least(l_quantity, 30.0D) AS SMALLINT) AS BIGINT) & 65535, 6)"
        " | if(l_linenumber IS NULL, 32L, 0L)"
        " | CASE WHEN l_returnflag <> 'R' THEN 4L WHEN l_returnflag = 'R' THEN 0L ELSE 8L END"
        " | CASE WHEN l_linestatus = 'F' THEN 1L WHEN l_linestatus <> 'F' THEN 0L ELSE 2L END"
    ).alias("flags")


def _unpacked_flags(df: DataFrame) -> DataFrame:
    """The columns of ``_packed_flags``."""
    return df.select(
        "*",
        F.expr("if(flags & 32 = 0, CAST(shiftright(flags, 22) AS INT), NULL)").alias("l_linenumber"),
        F.expr("CAST((shiftright(flags, 6) & 65535 ^ 32768) - 32768 AS SMALLINT)").alias("view_duration_sec"),
        F.expr("if(flags & 8 = 0, flags & 4 <> 0, NULL)").alias("is_viewable"),
        F.expr("if(flags & 2 = 0, flags & 1 <> 0, NULL)").alias("completed"))


class TestdataBinding:
    """Lazily derived raw tables over one scale-factor directory."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _t(self, name: str) -> DataFrame:
        return read_tpch(self.spark, self.sf_dir, name)

    # -- small reference tables ------------------------------------------
    def ad_slots(self) -> DataFrame:
        rows = [(s, d, c, v) for s, d, c, v, _ in C.AD_SLOTS]
        return literal_table(self.spark, rows, [
            (f.name, f.dataType.simpleString()) for f in RAW_SCHEMAS["ad_slots"].fields])

    def dates_ads(self) -> DataFrame:
        """Every day from the first to the last activity of the given tables, so
        no order or request falls outside the calendar."""
        from adlens.operators.dims import calendar_between
        orders = self._t("orders").agg(F.to_date(F.min("o_orderdate")).alias("first_order"),
                                       F.to_date(F.max("o_orderdate")).alias("last_order"))
        items = self._t("lineitem").agg(F.to_date(F.min("l_shipdate")).alias("first_ship"),
                                        F.to_date(F.max("l_shipdate")).alias("last_ship"))
        return calendar_between(with_totals(orders, items).select(
            F.least("first_order", "first_ship").alias("start_date"),
            F.greatest("last_order", "last_ship").alias("end_date")))

    # -- catalogs derived from part --------------------------------------
    def advertisers(self) -> DataFrame:
        brands = self._t("part").select("p_brand").distinct()
        n = _brand_number(F.col("p_brand"))
        return conform(brands.select(
            F.col("p_brand").alias("advertiser_id"),
            F.col("p_brand").alias("company_name"),
            pick(C.VERTICALS, n % 10).alias("industry_vertical"),
            pick(C.SPEND_TIERS, n % 4).alias("spend_tier"),
            pick(COUNTRIES, n % 3).alias("country"),
        ), RAW_SCHEMAS["advertisers"])

    def campaigns(self) -> DataFrame:
        from adlens.operators.prep import campaign_label, campaign_status
        grouped = (self._t("part")
                   .groupBy("p_brand", "p_type")
                   .agg(F.min("p_partkey").alias("k"),
                        F.sum(F.round(F.col("p_retailprice") * 100).cast("long")).alias("cents")))
        k = F.col("k")
        n = _brand_number(F.col("p_brand"))
        start = F.date_add(F.lit(FLIGHT_ORIGIN), ((k * 37) % 200).cast("int"))
        flight_days = (F.lit(365) + F.lit(30) * (k % 50)).cast("int")
        total_cents = F.call_function("div", F.col("cents"), F.lit(1600))
        df = grouped.select(
            F.concat_ws("|", "p_brand", "p_type").alias("campaign_id"),
            F.col("p_brand").alias("advertiser_id"),
            pick(C.OBJECTIVES, k % 4).alias("objective"),
            pick(C.VERTICALS, n % 10).alias("vertical"),
            (k % 5).alias("prefix_idx"),
            total_cents.alias("total_cents"),
            start.alias("flight_start"),
            flight_days.alias("flight_days"),
            (F.lit(1) + k % 3).alias("frequency_cap"),
            pick(C.PACING_GOALS, k % 3).alias("pacing_goal"),
        )
        df = df.select(
            "*",
            F.date_add("flight_start", F.col("flight_days") - 1).alias("flight_end"),
            (F.col("total_cents").cast("decimal(18,0)") * F.lit(Decimal("0.01")))
            .cast("decimal(12,2)").alias("total_budget_usd"),
            round_ratio(F.col("total_cents"), F.col("flight_days") * 100, 2, 12)
            .alias("daily_budget_usd"),
        )
        df = df.select(
            "*",
            campaign_label("objective", "prefix_idx", "vertical", "flight_start")
            .alias("campaign_name"),
            campaign_status("flight_start", "flight_end", STATUS_AS_OF).alias("status"),
        )
        return conform(df, RAW_SCHEMAS["campaigns"])

    # -- audience and content --------------------------------------------
    def subscribers(self) -> DataFrame:
        cust = self._t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        nat = self._t("nation").select("n_nationkey", "n_regionkey")
        reg = self._t("region").select("r_regionkey", "r_name")
        geo = nat.join(reg, nat.n_regionkey == reg.r_regionkey).select("n_nationkey", "r_name")
        ck = F.col("c_custkey")
        df = cust.join(geo, cust.c_nationkey == geo.n_nationkey).select(
            ck.cast("string").alias("subscriber_id"),
            _tier_from_segment(F.col("c_mktsegment")).alias("subscription_tier"),
            F.date_add(F.lit(date(2020, 1, 1)), (ck % 2000).cast("int")).alias("signup_date"),
            F.col("r_name").alias("region"),
            pick(C.DEVICES, ck % 5).alias("device_primary"),
            pick(C.AGE_BANDS, ck % 6).alias("age_band"),
        )
        return conform(df, RAW_SCHEMAS["subscribers"])

    def content_catalog(self) -> DataFrame:
        sup = self._t("supplier").select("s_suppkey", "s_name", "s_nationkey")
        nat = self._t("nation").select("n_nationkey", "n_name")
        sk = F.col("s_suppkey")
        df = sup.join(nat, sup.s_nationkey == nat.n_nationkey).select(
            sk.cast("string").alias("content_id"),
            F.col("s_name").alias("title"),
            pick(C.CONTENT_TYPES, sk % 3).alias("content_type"),
            F.col("n_name").alias("genre"),
            (F.lit(20) + sk % 101).alias("avg_episode_minutes"),
            pick(C.MATURITY_RATINGS, sk % 4).alias("maturity_rating"),
        )
        return conform(df, RAW_SCHEMAS["content_catalog"])

    # -- activity ----------------------------------------------------------
    def viewing_sessions(self) -> DataFrame:
        orders = spread(self._t("orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                                 "o_orderdate", "o_orderpriority"))
        # catalog size as a scalar subquery: computed once, inlined as a value
        n_content = self._t("supplier").agg(F.count(F.lit(1))).scalar()
        ok = F.col("o_orderkey")
        depth = ok % 6
        df = orders.select(
            ok.cast("string").alias("session_id"),
            F.col("o_custkey").cast("string").alias("subscriber_id"),
            (ok % n_content).cast("string").alias("content_id"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("session_start"),
            _device_from_priority(F.col("o_orderpriority")).alias("device"),
            (F.lit(30) + F.floor("o_totalprice").cast("long") % 7171).alias("watch_seconds"),
            pick(C.SLOT_ORDER, depth).alias("deepest_slot"),
            (depth + 1).alias("ad_requests"),
        )
        return conform(df, RAW_SCHEMAS["viewing_sessions"])

    def _request_base(self, filled: bool = False) -> DataFrame:
        """Requests with the order's columns; the filled ones also with the part's.
        Texts are made after the joins, whose shuffle then carries numbers, and flags
        and cents before it, which are shorter than the columns they come from."""
        li = spread(self._t("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"))
        was_filled = F.col("l_discount") >= F.lit(FILL_DISCOUNT)
        ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"]
        if filled:
            li = li.filter(was_filled).select(
                *ids, F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
                F.round(F.col("l_discount") * 100).cast("long").alias("disc"),
                _packed_flags())
        else:
            li = li.select(*ids, "l_linenumber", was_filled.alias("was_filled"))
        orders = self._t("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        base = li.join(orders, li.l_orderkey == orders.o_orderkey)
        if filled:
            base = _unpacked_flags(base)
            base = look_up(base, "l_partkey", self._t("part"), "p_partkey", ["p_brand", "p_type"])
        return base.select(
            "*",
            F.concat_ws("-", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                        date_key("l_shipdate").cast("string")).alias("request_id"),
            _device_from_priority(F.col("o_orderpriority")).alias("device"),
            pick(C.SLOT_ORDER, (F.col("l_linenumber") - 1) % 6).alias("slot_position"),
        )

    def ad_requests(self) -> DataFrame:
        df = self._request_base().select(
            "request_id",
            F.col("l_orderkey").cast("string").alias("session_id"),
            F.col("o_custkey").cast("string").alias("subscriber_id"),
            F.col("l_suppkey").cast("string").alias("content_id"),
            "slot_position",
            F.col("l_shipdate").cast("timestamp_ntz").alias("request_timestamp"),
            "device",
            "was_filled",
        )
        return conform(df, RAW_SCHEMAS["ad_requests"])

    def ad_impressions(self) -> DataFrame:
        df = self._request_base(filled=True)
        cents, disc = F.col("cents"), F.col("disc")
        micro = Decimal("0.000001")
        revenue = (F.call_function("div", cents * (F.lit(100) - disc), F.lit(20000))
                   .cast("decimal(18,0)") * F.lit(micro))
        bid = (F.call_function("div", cents * F.lit(100), F.lit(20000))
               .cast("decimal(18,0)") * F.lit(micro))
        df = df.select(
            F.concat(F.lit("imp-"), F.col("request_id")).alias("impression_id"),
            "request_id",
            F.concat_ws("|", "p_brand", "p_type").alias("campaign_id"),
            F.col("p_brand").alias("advertiser_id"),
            F.col("o_custkey").cast("string").alias("subscriber_id"),
            F.col("l_suppkey").cast("string").alias("content_id"),
            "slot_position",
            "device",
            bid.alias("bid_price_usd"),
            revenue.alias("revenue_usd"),
            "is_viewable",
            "completed",
            "view_duration_sec",
            F.col("l_shipdate").cast("timestamp_ntz").alias("impression_timestamp"),
        )
        return conform(df, RAW_SCHEMAS["ad_impressions"])

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def all(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in RAW_SCHEMAS}


def bind_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine raw tables derived from ``sf_dir``."""
    return TestdataBinding(spark, sf_dir).all()
