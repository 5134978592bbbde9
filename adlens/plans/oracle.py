"""DuckDB SQL used as the correctness oracle for every registered query.

The oracle restates, in plain SQL over the pre-registered test tables, the
binding (``adlens.sources.testdata``) and the model DAG, as one CTE prelude
shared by all keys. Every rounded ratio is computed in HUGEINT integer
arithmetic, half away from zero (DuckDB divides decimals in DOUBLE), so both
engines produce identical decimals.
"""

from __future__ import annotations

from adlens import constants as C
from adlens.sources import testdata as B


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def pick(values, index_sql: str) -> str:
    return f"{sql_list(values)}[({index_sql}) + 1]"


def case_map(mapping: dict, key_sql: str, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {key_sql} {whens} ELSE {default} END"


def rr(num: str, den: str, scale: int, precision: int = 18) -> str:
    """round(num/den, scale) half away from zero, exact, null when den = 0."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    q = f"((2 * abs({n}) * {10 ** scale} + abs({d})) // (2 * abs({d})))"
    signed = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -{q} ELSE {q} END)"
    if scale:
        val = f"CAST({signed} AS DECIMAL(38,0)) * CAST('{10 ** -scale:.{scale}f}' AS DECIMAL({scale + 1},{scale}))"
    else:
        val = signed
    return (f"(CASE WHEN {d} = 0 OR {d} IS NULL THEN NULL "
            f"ELSE CAST({val} AS DECIMAL({precision},{scale})) END)")


def micros(x: str) -> str:
    return f"CAST(CAST(({x}) AS DECIMAL(38,6)) * 1000000 AS HUGEINT)"


def skey(x: str) -> str:
    return f"md5(coalesce(CAST({x} AS VARCHAR), '{C.SURROGATE_NULL}'))"


def dkey(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"


MONEY = "DECIMAL(38,6)"


def _device(priority: str) -> str:
    return pick(C.DEVICES, f"CAST(substr({priority}, 1, 1) AS INTEGER) - 1")


def _slots_values() -> str:
    rows = ", ".join(
        f"('{s}', CAST({d} AS SMALLINT), CAST('{c}' AS DECIMAL(5,2)), CAST('{v}' AS DECIMAL(5,2)))"
        for s, d, c, v, _ in C.AD_SLOTS)
    return (f"SELECT * FROM (VALUES {rows}) AS t(slot_position, typical_duration_sec, "
            f"avg_completion_rate, avg_viewability)")


def _label(objective: str, k: str, vertical: str, start: str) -> str:
    prefix = "CASE " + " ".join(
        f"WHEN {objective} = '{obj}' THEN {pick(names, f'{k} % 5')}"
        for obj, names in C.CAMPAIGN_PREFIXES.items()) + " ELSE 'Campaign' END"
    short = f"coalesce({case_map(C.VERTICAL_SHORT, vertical)}, substr({vertical}, 1, 5))"
    return (f"{prefix} || ' - ' || {short} || ' Q' || CAST(quarter({start}) AS VARCHAR) "
            f"|| ' ' || CAST(year({start}) AS VARCHAR)")


def _status(start: str, end: str, as_of: str) -> str:
    return (f"CASE WHEN {end} < DATE '{as_of}' THEN 'completed' "
            f"WHEN {start} <= DATE '{as_of}' THEN 'active' ELSE 'scheduled' END")


def _tier(seg: str) -> str:
    return case_map(B.TIER_BY_SEGMENT, seg)


PACING_NUM = ("CASE WHEN flight_days IS NOT NULL AND flight_days <> 0 "
              f"THEN {micros('cumulative_spend')} * flight_days ELSE {micros('cumulative_spend')} END")
PACING_DEN = ("(CASE WHEN flight_days IS NOT NULL AND flight_days <> 0 "
              "THEN CAST(total_budget_usd * 100 AS HUGEINT) * least(elapsed_days, flight_days) "
              "ELSE CAST(total_budget_usd * 100 AS HUGEINT) END) * 10000")


def pacing_status_sql(ratio: str) -> str:
    return (f"CASE WHEN {ratio} IS NULL THEN 'UNKNOWN' WHEN {ratio} < 0.9 THEN 'UNDER_PACING' "
            f"WHEN {ratio} > 1.1 THEN 'OVER_PACING' ELSE 'ON_PACE' END")


def _ctes() -> list[tuple[str, str]]:
    fs = "flight_start"
    ctes: list[tuple[str, str]] = []
    add = lambda name, body: ctes.append((name, body))

    # ---------------- binding: the nine raw tables ----------------
    add("ad_slots", _slots_values())
    add("dates_ads", f"""
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
               strftime(d, '%A') AS day_of_week, isodow(d) >= 6 AS is_weekend,
               CAST(weekofyear(d) AS SMALLINT) AS week_of_year, strftime(d, '%B') AS month_name,
               'Q' || CAST(quarter(d) AS VARCHAR) AS quarter, CAST(year(d) AS SMALLINT) AS year
        FROM (SELECT CAST(unnest(range(min(d), max(d) + 1, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
                    UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem))""")
    add("advertisers", f"""
        SELECT p_brand AS advertiser_id, p_brand AS company_name,
               {pick(C.VERTICALS, 'n % 10')} AS industry_vertical,
               {pick(C.SPEND_TIERS, 'n % 4')} AS spend_tier,
               {pick(B.COUNTRIES, 'n % 3')} AS country
        FROM (SELECT DISTINCT p_brand, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS n FROM part)""")
    add("campaign_base", f"""
        SELECT p_brand, p_type, k, cents // 1600 AS total_cents,
               CAST(split_part(p_brand, '#', 2) AS INTEGER) AS n,
               {pick(C.OBJECTIVES, 'k % 4')} AS objective,
               DATE '{B.FLIGHT_ORIGIN}' + CAST((k * 37) % 200 AS INTEGER) AS flight_start,
               CAST(365 + 30 * (k % 50) AS INTEGER) AS flight_days
        FROM (SELECT p_brand, p_type, min(p_partkey) AS k,
                     sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS cents
              FROM part GROUP BY p_brand, p_type)""")
    add("campaigns", f"""
        SELECT p_brand || '|' || p_type AS campaign_id, p_brand AS advertiser_id,
               {_label('objective', 'k', pick(C.VERTICALS, 'n % 10'), fs)} AS campaign_name,
               objective,
               {rr('total_cents', 'CAST(flight_days AS BIGINT) * 100', 2, 12)} AS daily_budget_usd,
               CAST(CAST(total_cents AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2)) AS total_budget_usd,
               flight_start, flight_start + flight_days - 1 AS flight_end,
               CAST(flight_days AS SMALLINT) AS flight_days,
               CAST(1 + k % 3 AS SMALLINT) AS frequency_cap,
               {pick(C.PACING_GOALS, 'k % 3')} AS pacing_goal,
               {_status(fs, 'flight_start + flight_days - 1', B.STATUS_AS_OF)} AS status
        FROM campaign_base""")
    add("subscribers", f"""
        SELECT CAST(c_custkey AS VARCHAR) AS subscriber_id, {_tier('c_mktsegment')} AS subscription_tier,
               DATE '2020-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS signup_date,
               r_name AS region, {pick(C.DEVICES, 'c_custkey % 5')} AS device_primary,
               {pick(C.AGE_BANDS, 'c_custkey % 6')} AS age_band
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
    add("content_catalog", f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS content_id, s_name AS title,
               {pick(C.CONTENT_TYPES, 's_suppkey % 3')} AS content_type, n_name AS genre,
               CAST(20 + s_suppkey % 101 AS SMALLINT) AS avg_episode_minutes,
               {pick(C.MATURITY_RATINGS, 's_suppkey % 4')} AS maturity_rating
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
    add("viewing_sessions", f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS session_id, CAST(o_custkey AS VARCHAR) AS subscriber_id,
               CAST(o_orderkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS content_id,
               CAST(o_orderdate AS TIMESTAMP) AS session_start, {_device('o_orderpriority')} AS device,
               CAST(30 + CAST(floor(o_totalprice) AS BIGINT) % 7171 AS INTEGER) AS watch_seconds,
               {pick(C.SLOT_ORDER, 'o_orderkey % 6')} AS deepest_slot,
               CAST(o_orderkey % 6 + 1 AS SMALLINT) AS ad_requests
        FROM orders""")
    add("request_base", f"""
        SELECT l.*, o_custkey,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, {dkey('l_shipdate')}) AS request_id,
               {_device('o_orderpriority')} AS device,
               {pick(C.SLOT_ORDER, '(l_linenumber - 1) % 6')} AS slot_position
        FROM lineitem AS l JOIN orders ON l_orderkey = o_orderkey""")
    add("ad_requests", f"""
        SELECT request_id, CAST(l_orderkey AS VARCHAR) AS session_id,
               CAST(o_custkey AS VARCHAR) AS subscriber_id, CAST(l_suppkey AS VARCHAR) AS content_id,
               slot_position, CAST(l_shipdate AS TIMESTAMP) AS request_timestamp, device,
               l_discount >= {B.FILL_DISCOUNT} AS was_filled
        FROM request_base""")
    add("ad_impressions", f"""
        SELECT 'imp-' || request_id AS impression_id, request_id,
               p_brand || '|' || p_type AS campaign_id, p_brand AS advertiser_id,
               CAST(o_custkey AS VARCHAR) AS subscriber_id, CAST(l_suppkey AS VARCHAR) AS content_id,
               slot_position, device,
               CAST(CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * 100) // 20000 AS DECIMAL(18,0))
                    * 0.000001 AS DECIMAL(12,6)) AS bid_price_usd,
               CAST(CAST((CAST(round(l_extendedprice * 100) AS BIGINT)
                          * (100 - CAST(round(l_discount * 100) AS BIGINT))) // 20000 AS DECIMAL(18,0))
                    * 0.000001 AS DECIMAL(12,6)) AS revenue_usd,
               l_returnflag <> 'R' AS is_viewable, l_linestatus = 'F' AS completed,
               CAST(least(l_quantity, 30.0) AS SMALLINT) AS view_duration_sec,
               CAST(l_shipdate AS TIMESTAMP) AS impression_timestamp
        FROM request_base JOIN part ON l_partkey = p_partkey
        WHERE l_discount >= {B.FILL_DISCOUNT}""")

    # ---------------- staging ----------------
    for stg, raw in [("stg_ad_impressions", "ad_impressions"), ("stg_ad_requests", "ad_requests"),
                     ("stg_viewing_sessions", "viewing_sessions"), ("stg_campaigns", "campaigns"),
                     ("stg_advertisers", "advertisers"), ("stg_subscribers", "subscribers"),
                     ("stg_content_catalog", "content_catalog"), ("stg_ad_slots", "ad_slots")]:
        add(stg, f"SELECT * FROM {raw}")

    # ---------------- dimensions ----------------
    add("dim_advertisers", f"SELECT {skey('advertiser_id')} AS advertiser_key, * FROM stg_advertisers")
    add("dim_campaigns", f"""
        SELECT {skey('c.campaign_id')} AS campaign_key, c.campaign_id, a.advertiser_key,
               c.campaign_name, c.objective, c.daily_budget_usd, c.total_budget_usd, c.flight_start,
               c.flight_end, c.flight_days, c.frequency_cap, c.pacing_goal, c.status
        FROM stg_campaigns AS c JOIN dim_advertisers AS a ON c.advertiser_id = a.advertiser_id""")
    add("dim_content", f"SELECT {skey('content_id')} AS content_key, * FROM stg_content_catalog")
    add("dim_subscribers", f"SELECT {skey('subscriber_id')} AS subscriber_key, * FROM stg_subscribers")
    add("dim_ad_slots", f"SELECT {skey('slot_position')} AS slot_key, * FROM stg_ad_slots")
    add("dim_date_ads", "SELECT * FROM dates_ads")

    # ---------------- facts ----------------
    add("fct_ad_impressions", f"""
        SELECT i.impression_id, i.request_id, c.campaign_key, a.advertiser_key, s.subscriber_key,
               n.content_key, sl.slot_key, d.date_key, i.bid_price_usd, i.revenue_usd,
               i.is_viewable, i.completed, i.view_duration_sec, i.device, i.impression_timestamp
        FROM stg_ad_impressions AS i
        JOIN dim_campaigns AS c ON i.campaign_id = c.campaign_id
        JOIN dim_advertisers AS a ON i.advertiser_id = a.advertiser_id
        JOIN dim_subscribers AS s ON i.subscriber_id = s.subscriber_id
        JOIN dim_content AS n ON i.content_id = n.content_id
        JOIN dim_ad_slots AS sl ON i.slot_position = sl.slot_position
        JOIN dim_date_ads AS d ON {dkey('i.impression_timestamp')} = d.date_key""")
    add("fct_viewing_sessions", f"""
        SELECT v.session_id, s.subscriber_key, n.content_key, d.date_key, v.watch_seconds,
               v.deepest_slot, v.ad_requests, v.device, v.session_start
        FROM stg_viewing_sessions AS v
        JOIN dim_subscribers AS s ON v.subscriber_id = s.subscriber_id
        JOIN dim_content AS n ON v.content_id = n.content_id
        JOIN dim_date_ads AS d ON {dkey('v.session_start')} = d.date_key""")
    add("campaign_daily_agg", f"""
        SELECT campaign_key, date_key, count(*) AS impressions_served,
               count(*) FILTER (WHERE is_viewable) AS impressions_viewable,
               count(*) FILTER (WHERE completed) AS impressions_completed,
               CAST(sum(revenue_usd) AS {MONEY}) AS revenue_usd,
               count(DISTINCT subscriber_key) AS unique_subscribers
        FROM fct_ad_impressions GROUP BY campaign_key, date_key""")
    add("campaign_daily_cum", f"""
        SELECT a.*, c.total_budget_usd, c.flight_days,
               CAST(sum(a.revenue_usd) OVER (PARTITION BY a.campaign_key ORDER BY a.date_key) AS {MONEY})
                   AS cumulative_spend,
               CAST((d.full_date - c.flight_start) + 1 AS INTEGER) AS elapsed_days
        FROM campaign_daily_agg AS a
        JOIN dim_campaigns AS c ON a.campaign_key = c.campaign_key
        JOIN dim_date_ads AS d ON a.date_key = d.date_key""")
    add("campaign_daily_ratio", f"""
        SELECT *, {rr(PACING_NUM, PACING_DEN, 3)} AS budget_pacing_ratio FROM campaign_daily_cum""")
    add("fct_campaign_daily", f"""
        SELECT campaign_key, date_key, impressions_served, impressions_viewable, impressions_completed,
               revenue_usd, unique_subscribers, total_budget_usd, cumulative_spend, elapsed_days,
               flight_days, budget_pacing_ratio, {pacing_status_sql('budget_pacing_ratio')} AS pacing_status
        FROM campaign_daily_ratio""")

    # ---------------- marts ----------------
    add("daily_requests", f"""
        SELECT d.date_key, r.total_requests
        FROM (SELECT {dkey('request_timestamp')} AS date_key, count(*) AS total_requests
              FROM stg_ad_requests GROUP BY 1) AS r
        JOIN dim_date_ads AS d ON r.date_key = d.date_key""")
    add("daily_impressions", f"""
        SELECT date_key, count(*) AS total_impressions,
               count(*) FILTER (WHERE completed) AS completed_impressions,
               count(*) FILTER (WHERE is_viewable) AS viewable_impressions,
               CAST(sum(revenue_usd) AS {MONEY}) AS total_revenue_usd,
               count(DISTINCT subscriber_key) AS unique_subscribers
        FROM fct_ad_impressions GROUP BY date_key""")
    add("daily_viewing", """
        SELECT date_key, sum(watch_seconds) AS watch_seconds
        FROM fct_viewing_sessions GROUP BY date_key""")
    # one line per day and source, summed by day: no outer join
    add("day_lines", f"""
        SELECT {dkey('request_timestamp')} AS day, count(*) AS asked, 0 AS shown, 0 AS finished, 0 AS seen,
               CAST(0 AS {MONEY}) AS money, 0 AS people, NULL AS secs
        FROM stg_ad_requests GROUP BY 1
        UNION ALL
        SELECT date_key, 0, count(*), sum(completed::INT), sum(is_viewable::INT),
               CAST(sum(revenue_usd) AS {MONEY}), count(DISTINCT subscriber_key), NULL
        FROM fct_ad_impressions GROUP BY date_key
        UNION ALL
        SELECT date_key, 0, 0, 0, 0, CAST(0 AS {MONEY}), 0, sum(watch_seconds)
        FROM fct_viewing_sessions GROUP BY date_key""")
    add("mart_platform_health", f"""
        SELECT day AS date_key, CAST(strptime(CAST(day AS VARCHAR), '%Y%m%d') AS DATE) AS full_date,
               CAST(asked AS BIGINT) AS total_requests, CAST(shown AS BIGINT) AS total_impressions,
               {rr('100 * shown', 'nullif(asked, 0)', 1)} AS fill_rate_pct,
               {rr(micros('money') + ' * 1000', 'nullif(shown, 0) * 1000000', 2)} AS ecpm_usd,
               {rr('100 * finished', 'nullif(shown, 0)', 1)} AS completion_rate_pct,
               {rr('100 * seen', 'nullif(shown, 0)', 1)} AS viewability_rate_pct,
               money AS total_revenue_usd, CAST(people AS BIGINT) AS unique_subscribers,
               coalesce({rr('secs', '3600', 1)}, CAST(0 AS DECIMAL(18,1))) AS viewing_hours,
               {rr(micros('money') + ' * 3600', 'secs * 1000000', 4)} AS revenue_per_subscriber_hour
        FROM (SELECT day, sum(asked) AS asked, sum(shown) AS shown, sum(finished) AS finished,
                     sum(seen) AS seen, CAST(sum(money) AS {MONEY}) AS money, sum(people) AS people,
                     sum(secs) AS secs
              FROM day_lines WHERE day IN (SELECT date_key FROM dim_date_ads) GROUP BY day)
        WHERE asked + shown > 0""")
    add("mart_campaign_performance", """
        WITH sold AS (SELECT campaign_key, campaign_name, frequency_cap, company_name, industry_vertical
                      FROM dim_campaigns JOIN dim_advertisers USING (advertiser_key)),
             pace AS (SELECT campaign_key, date_key, elapsed_days, impressions_served AS impressions,
                             revenue_usd, cumulative_spend, total_budget_usd, flight_days,
                             budget_pacing_ratio, pacing_status FROM fct_campaign_daily)
        SELECT * FROM pace JOIN sold USING (campaign_key)""")
    add("mart_advertiser_summary", f"""
        SELECT advertiser_key, company_name, industry_vertical, spend_tier, money AS total_spend,
               shown AS total_impressions,
               {rr(micros('money') + ' * 1000', 'shown * 1000000', 2)} AS ecpm,
               {rr('100 * finished', 'shown', 1)} AS completion_rate_pct,
               {rr('100 * seen', 'shown', 1)} AS viewability_rate_pct,
               campaigns AS campaign_count,
               {rr('100 * ' + micros('money'), micros('everything'), 2)} AS revenue_share_pct
        FROM (SELECT *, CAST(sum(money) OVER () AS {MONEY}) AS everything
              FROM (SELECT advertiser_key, CAST(sum(revenue_usd) AS {MONEY}) AS money, count(*) AS shown,
                           CAST(sum(completed::INT) AS BIGINT) AS finished,
                           CAST(sum(is_viewable::INT) AS BIGINT) AS seen,
                           count(DISTINCT campaign_key) AS campaigns
                    FROM fct_ad_impressions GROUP BY advertiser_key))
        JOIN dim_advertisers USING (advertiser_key)""")
    add("mart_advertiser_concentration", """
        SELECT CAST(round(hhi, 1) AS DECIMAL(18,1)) AS hhi,
               CASE WHEN hhi < 1500 THEN 'DIVERSIFIED' WHEN hhi < 2500 THEN 'MODERATE'
                    ELSE 'CONCENTRATED' END AS concentration_band,
               advertiser_count,
               CAST(round(top_share, 2) AS DECIMAL(18,2)) AS top_advertiser_share_pct
        FROM (SELECT sum(revenue_share_pct * revenue_share_pct) AS hhi, count(*) AS advertiser_count,
                     max(revenue_share_pct) AS top_share FROM mart_advertiser_summary)""")
    # people by how often they saw a campaign
    add("frequency_histogram", """
        SELECT campaign_key, times, count(*) AS people
        FROM (SELECT campaign_key, count(*) AS times FROM fct_ad_impressions
              GROUP BY campaign_key, subscriber_key)
        GROUP BY campaign_key, times""")
    add("mart_frequency_analysis", f"""
        SELECT *, {rr('100 * subscribers_exceeding_cap', 'total_subscribers', 1)} AS violation_rate_pct,
               (SELECT {rr('sum(times * people)', 'sum(people)', 1)} FROM frequency_histogram AS h
                WHERE h.campaign_key = m.campaign_key) AS avg_frequency
        FROM (SELECT campaign_key, campaign_name, frequency_cap,
                     CAST(sum(people) AS BIGINT) AS total_subscribers,
                     CAST(coalesce(sum(people) FILTER (WHERE times > frequency_cap), 0) AS BIGINT)
                         AS subscribers_exceeding_cap,
                     CAST(sum(people * greatest(times - frequency_cap, 0)) AS BIGINT) AS total_violations
              FROM frequency_histogram JOIN dim_campaigns USING (campaign_key) GROUP BY ALL) AS m""")
    add("mart_content_monetization", f"""
        SELECT genre, date_key, impressions, revenue_usd,
               {rr('view', 'impressions', 1)} AS avg_view_duration_sec
        FROM (SELECT dc.genre, i.date_key, count(*) AS impressions,
                     CAST(sum(i.revenue_usd) AS {MONEY}) AS revenue_usd,
                     sum(i.view_duration_sec) AS view
              FROM fct_ad_impressions AS i JOIN dim_content AS dc ON i.content_key = dc.content_key
              GROUP BY dc.genre, i.date_key)""")
    return ctes


_PRELUDE_CACHE: list[tuple[str, str]] | None = None


def ctes() -> list[tuple[str, str]]:
    global _PRELUDE_CACHE
    if _PRELUDE_CACHE is None:
        _PRELUDE_CACHE = _ctes()
    return _PRELUDE_CACHE


def with_prelude(select: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Full SQL text: the shared CTE prelude (plus ``extra``) and ``select``."""
    parts = [f"{name} AS ({body.strip()})" for name, body in ctes() + (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + select
