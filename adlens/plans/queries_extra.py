"""Registered queries beyond the models: sources, building blocks, quality,
reconciliation, audits, reports and preparation jobs, each with its DuckDB
oracle where the result is SQL-expressible."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlens import constants as C
from adlens.functions.exprs import optional_number
from adlens.operators import audit as V
from adlens.operators import facts, failures, marts, prep, quality, reach, recon, report
from adlens.plans import oracle as O
from adlens.plans.catalog import register, wh
from adlens.sources import raw as S
from adlens.sources.csv_records import read_csv_records
from adlens.sources import testdata as B

P = O.with_prelude
rr, micros = O.rr, O.micros

# --------------------------------------------------------------------------
# extra oracle CTEs
# --------------------------------------------------------------------------
SLOT_DEPTHS = ("slot_depths", "SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', {i}, {int(round(float(frac) * 100))})"
    for i, (name, _, _, _, frac) in enumerate(C.AD_SLOTS)) +
    ") AS t(slot_position, slot_depth, frac_pct)")
EXPANDED = ("expanded_requests", """
    SELECT v.session_id || '-' || CAST(s.slot_depth AS VARCHAR) AS request_id, v.session_id,
           v.subscriber_id, v.content_id, s.slot_position,
           v.session_start + to_microseconds(CAST(v.watch_seconds AS BIGINT) * s.frac_pct * 10000)
               AS request_timestamp, v.device
    FROM viewing_sessions AS v
    JOIN slot_depths AS d ON v.deepest_slot = d.slot_position
    JOIN slot_depths AS s ON s.slot_depth <= d.slot_depth""")
FLIGHT_DAYS = ("in_flight", """
    SELECT d.day, c.campaign_id, c.total_budget_usd
    FROM (SELECT DISTINCT CAST(request_timestamp AS DATE) AS day FROM ad_requests WHERE was_filled) AS d
    LEFT JOIN campaigns AS c ON d.day BETWEEN c.flight_start AND c.flight_end""")


def draw_sql(x: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 15)) AS BIGINT)"


def band_sql(x: str, table) -> str:
    parts = [f"WHEN {x} IS NULL THEN '{C.UNKNOWN}'"]
    for upper, verdict in table:
        if upper is None:
            return "CASE " + " ".join(parts) + f" ELSE '{verdict}' END"
        parts.append(f"WHEN {x} < {upper} THEN '{verdict}'")
    return "CASE " + " ".join(parts) + f" ELSE '{C.UNKNOWN}' END"


def summary_sql(table: str, violation: str) -> str:
    return (f"SELECT count(*) AS checked, count(*) FILTER (WHERE {violation}) AS violations, "
            f"count(*) FILTER (WHERE {violation}) = 0 AS passed FROM {table}")


# --------------------------------------------------------------------------
# sources (S1-S4, S8)
# --------------------------------------------------------------------------
@register("scan_typed", P("SELECT * FROM ad_requests"))
def _scan_typed(spark, sf_dir):
    """Bound ad_requests written as CSV (S8) and read back typed (S1). The test
    tables' ids are longer than the raw columns, so no lengths are checked."""
    from adlens.session import scratch_path
    path = scratch_path(spark, "ad_requests_csv")
    S.write_csv(B.TestdataBinding(spark, sf_dir).ad_requests(), path)
    return S.load_table(spark, path, "ad_requests", lengths={})


@register("csv_round_trip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _csv_round_trip(spark, sf_dir):
    """All documents written as CSV (S8), whose texts hold quotes, commas and line
    breaks, and read back in splits (S1)."""
    from adlens.session import scratch_path
    path = scratch_path(spark, "documents_csv")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars")
    S.write_csv(docs, path)
    return read_csv_records(spark, path, docs.schema)


@register("load_row_counts", P(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in ["ad_slots", "advertisers", "content_catalog", "subscribers", "campaigns",
              "dates_ads", "viewing_sessions", "ad_requests", "ad_impressions"])))
def _row_counts(spark, sf_dir):
    return S.row_counts(wh(spark, sf_dir).raw)


# --------------------------------------------------------------------------
# keys, calendar, semi join, range join
# --------------------------------------------------------------------------
@register("surrogate_key", P(f"""
    SELECT campaign_id,
           md5(coalesce(CAST(campaign_id AS VARCHAR), '{C.SURROGATE_NULL}') || '-' ||
               coalesce(CAST(advertiser_id AS VARCHAR), '{C.SURROGATE_NULL}')) AS pair_key,
           md5(coalesce(CAST(campaign_id AS VARCHAR), '{C.SURROGATE_NULL}') || '-' ||
               '{C.SURROGATE_NULL}') AS null_key
    FROM campaigns"""))
def _surrogate_key(spark, sf_dir):
    from adlens.functions.exprs import surrogate_key
    c = wh(spark, sf_dir).raw["campaigns"]
    return c.select("campaign_id", surrogate_key("campaign_id", "advertiser_id").alias("pair_key"),
                    surrogate_key("campaign_id", F.lit(None).cast("string")).alias("null_key"))


@register("calendar", f"""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
           strftime(d, '%A') AS day_of_week, isodow(d) >= 6 AS is_weekend,
           CAST(weekofyear(d) AS SMALLINT) AS week_of_year, strftime(d, '%B') AS month_name,
           'Q' || CAST(quarter(d) AS VARCHAR) AS quarter, CAST(year(d) AS SMALLINT) AS year
    FROM (SELECT CAST(unnest(range((SELECT CAST(min(o_orderdate) AS DATE) FROM orders),
                                   (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem) + 1,
                                   INTERVAL 1 DAY)) AS DATE) AS d)""")
def _calendar(spark, sf_dir):
    """The calendar builder (D8) over the activity span of the given tables:
    first order date to last ship date."""
    from adlens.functions.joins import with_totals
    from adlens.operators.dims import calendar_between
    start = B.read_tpch(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("start_date"))
    end = B.read_tpch(spark, sf_dir, "lineitem").agg(
        F.to_date(F.max("l_shipdate")).alias("end_date"))
    return calendar_between(with_totals(start, end))


@register("served_flag", P("""
    SELECT request_id, request_id IN (SELECT request_id FROM ad_impressions) AS was_filled
    FROM ad_requests"""))
def _served_flag(spark, sf_dir):
    """was_filled recomputed as membership in the served set (left join on distinct ids)."""
    w = wh(spark, sf_dir)
    served = w.raw["ad_impressions"].select("request_id").distinct().withColumn("hit", F.lit(True))
    return (w.raw["ad_requests"].select("request_id").join(served, "request_id", "left")
            .select("request_id", F.coalesce("hit", F.lit(False)).alias("was_filled")))


def _filled_days(w):
    return (w.raw["ad_requests"].filter("was_filled")
            .select(F.to_date("request_timestamp").alias("day")))


@register("in_flight_candidates", P("SELECT * FROM in_flight", [FLIGHT_DAYS]))
def _in_flight(spark, sf_dir):
    w = wh(spark, sf_dir)
    return prep.in_flight_candidates(_filled_days(w), w.raw["campaigns"], strict=False)


@register("uncovered_flight_days", P("""
    SELECT d.day FROM (SELECT DISTINCT CAST(request_timestamp AS DATE) AS day
                       FROM ad_requests WHERE was_filled) AS d
    WHERE NOT EXISTS (SELECT 1 FROM campaigns AS c WHERE d.day BETWEEN c.flight_start AND c.flight_end)"""))
def _uncovered(spark, sf_dir):
    """Days with filled requests but no campaign in flight (what the strict guard reports)."""
    return _in_flight(spark, sf_dir).filter("campaign_id IS NULL").select("day")


# --------------------------------------------------------------------------
# aggregations, window, pacing parts (A1, A3-A5, W1, M3a-c, M4d)
# --------------------------------------------------------------------------
register("campaign_daily_agg", P("SELECT * FROM campaign_daily_agg"))(
    lambda spark, sf: facts.campaign_daily_agg(wh(spark, sf).fct_ad_impressions))
register("daily_requests", P("SELECT * FROM daily_requests"))(
    lambda spark, sf: (lambda w: marts.daily_requests(w.stg["stg_ad_requests"],
                                                      w.dim_date_ads))(wh(spark, sf)))
register("daily_impressions", P("SELECT * FROM daily_impressions"))(
    lambda spark, sf: marts.daily_impressions(wh(spark, sf).fct_ad_impressions))
register("daily_viewing", P("SELECT * FROM daily_viewing"))(
    lambda spark, sf: marts.daily_viewing(wh(spark, sf).fct_viewing_sessions))

for _key, _cols in {
    "cumulative_spend": ["campaign_key", "date_key", "revenue_usd", "cumulative_spend"],
    "elapsed_days": ["campaign_key", "date_key", "elapsed_days"],
    "budget_pacing": ["campaign_key", "date_key", "budget_pacing_ratio"],
    "pacing_status": ["campaign_key", "date_key", "budget_pacing_ratio", "pacing_status"],
}.items():
    register(_key, P(f"SELECT {', '.join(_cols)} FROM fct_campaign_daily"))(
        (lambda cols: lambda spark, sf: wh(spark, sf).fct_campaign_daily.select(*cols))(_cols))

register("rpsh_daily", P("SELECT date_key, revenue_per_subscriber_hour FROM mart_platform_health"))(
    lambda spark, sf: wh(spark, sf).mart_platform_health.select(
        "date_key", "revenue_per_subscriber_hour"))


# --------------------------------------------------------------------------
# data quality (Q1-Q8)
# --------------------------------------------------------------------------
def _check_sql(types) -> str:
    sels = []
    for model, spec in quality.CHECKS.items():
        head = f"SELECT '{model}' AS model, '{{t}}' AS check_name, '{{c}}' AS column_name, "
        if quality.NN in types:
            for c in spec.get(quality.NN, []):
                sels.append(head.format(t=quality.NN, c=c) +
                            f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {model}")
        if quality.AV in types:
            for c, vals in spec.get(quality.AV, {}).items():
                lst = ", ".join(f"'{v}'" for v in vals)
                sels.append(head.format(t=quality.AV, c=c) +
                            f"CAST(count(DISTINCT CASE WHEN {c} IS NOT NULL AND {c} NOT IN ({lst}) "
                            f"THEN {c} END) AS BIGINT) AS failures FROM {model}")
        if quality.AR in types:
            for c, (lo, hi) in spec.get(quality.AR, {}).items():
                conds = ([f"{c} < {lo}"] if lo is not None else []) + \
                        ([f"{c} > {hi}"] if hi is not None else [])
                sels.append(head.format(t=quality.AR, c=c) +
                            f"CAST(count(*) FILTER (WHERE {' OR '.join(conds)}) AS BIGINT) "
                            f"AS failures FROM {model}")
        if quality.U in types:
            for c in spec.get(quality.U, []):
                sels.append(head.format(t=quality.U, c=c) +
                            f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {model} "
                            f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        if quality.UC in types:
            for cols in spec.get(quality.UC, []):
                cl = ", ".join(cols)
                sels.append(head.format(t=quality.UC, c=",".join(cols)) +
                            f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {cl} FROM {model} "
                            f"GROUP BY {cl} HAVING count(*) > 1)")
        if quality.FK in types:
            for c, (parent, pcol) in spec.get(quality.FK, {}).items():
                sels.append(head.format(t=quality.FK, c=c) +
                            f"CAST(count(*) AS BIGINT) AS failures FROM {model} AS ch "
                            f"WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                            f"(SELECT 1 FROM {parent} AS pa WHERE pa.{pcol} = ch.{c})")
    return P("\nUNION ALL\n".join(sels))


def _dq(types):
    def run(spark, sf_dir):
        w = wh(spark, sf_dir)   # facts already written once; checks read the written copy
        return quality.run_checks(w.model, types=types)
    return run


for _key, _types in {
    "dq_not_null": [quality.NN], "dq_unique": [quality.U],
    "dq_unique_combination": [quality.UC], "dq_accepted_values": [quality.AV],
    "dq_relationships": [quality.FK], "dq_accepted_range": [quality.AR],
    "dq_report": quality.CHECK_TYPES,
}.items():
    register(_key, _check_sql(_types))(_dq(_types))


def _failing_sql() -> str:
    """The failing rows of every check, one SELECT each."""
    def joined(cols):
        return ("concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
                + ")") if cols else "''"

    sels = []
    for model, spec in quality.CHECKS.items():
        key = joined(failures.key_columns(model, spec))
        one = (f"SELECT '{model}' AS model, '{{t}}' AS check_name, '{{c}}' AS column_name, {key} AS "
               f"row_key, {{v}} AS value, CAST(1 AS BIGINT) AS n_rows FROM {model} WHERE {{w}}")
        many = (f"SELECT '{model}', '{{t}}', '{{c}}', CAST(NULL AS VARCHAR), {{v}}, count(*) "
                f"FROM {model} WHERE {{w}} GROUP BY {{g}} HAVING {{h}}")
        text = "CAST({} AS VARCHAR)".format
        sels += [one.format(t=quality.NN, c=c, v="CAST(NULL AS VARCHAR)", w=f"{c} IS NULL")
                 for c in spec.get(quality.NN, [])]
        for c, (lo, hi) in spec.get(quality.AR, {}).items():
            conds = ([f"{c} < {lo}"] if lo is not None else []) + \
                    ([f"{c} > {hi}"] if hi is not None else [])
            sels.append(one.format(t=quality.AR, c=c, v=text(f"CAST({c} AS DECIMAL(38,6))"),
                                   w=" OR ".join(conds)))
        for c, (parent, pcol) in spec.get(quality.FK, {}).items():
            sels.append(one.format(t=quality.FK, c=c, v=text(c), w=f"{c} NOT IN (SELECT {pcol} "
                                   f"FROM {parent} WHERE {pcol} IS NOT NULL)"))
        sels += [many.format(t=quality.U, c=c, v=text(c), w=f"{c} IS NOT NULL", g=c, h="count(*) > 1")
                 for c in spec.get(quality.U, [])]
        sels += [many.format(t=quality.UC, c=",".join(cols), v=joined(cols), w="true",
                             g=", ".join(cols), h="count(*) > 1") for cols in spec.get(quality.UC, [])]
        for c, values in spec.get(quality.AV, {}).items():
            lst = ", ".join(f"'{v}'" for v in values)
            sels.append(many.format(t=quality.AV, c=c, v=text(c), w=f"{c} NOT IN ({lst})", g=c,
                                    h="true"))
    return P("\nUNION ALL\n".join(sels))


@register("dq_failing_rows", _failing_sql())
def _dq_failing_rows(spark, sf_dir):
    return failures.failing_rows(wh(spark, sf_dir).model)


# --------------------------------------------------------------------------
# reconciliation
# --------------------------------------------------------------------------
register("recon_revenue_share", P("""
    SELECT sum(revenue_share_pct) AS total_pct, abs(sum(revenue_share_pct) - 100) <= 1 AS passed
    FROM mart_advertiser_summary"""))(
    lambda spark, sf: recon.recon_revenue_share(wh(spark, sf).mart_advertiser_summary))

register("recon_elapsed_days", P("""
    SELECT f.campaign_key, f.date_key, f.elapsed_days,
           CAST((dd.full_date - dc.flight_start) + 1 AS INTEGER) AS calendar_elapsed_days,
           f.elapsed_days = CAST((dd.full_date - dc.flight_start) + 1 AS INTEGER) AS passed
    FROM fct_campaign_daily AS f JOIN dim_date_ads AS dd ON f.date_key = dd.date_key
    JOIN dim_campaigns AS dc ON f.campaign_key = dc.campaign_key"""))(
    lambda spark, sf: (lambda w: recon.recon_elapsed_days(
        w.fct_campaign_daily, w.dim_date_ads, w.dim_campaigns))(wh(spark, sf)))

register("recon_hhi", P("""
    SELECT hhi, expected_hhi, abs(hhi - expected_hhi) <= 0.1 AS passed
    FROM (SELECT c.hhi,
                 (SELECT CAST(sum((revenue_share_pct * 0.01) * (revenue_share_pct * 0.01)) * 10000
                         AS DECIMAL(18,4)) FROM mart_advertiser_summary) AS expected_hhi
          FROM mart_advertiser_concentration AS c)"""))(
    lambda spark, sf: (lambda w: recon.recon_hhi(
        w.mart_advertiser_concentration, w.mart_advertiser_summary))(wh(spark, sf)))

register("recon_filled", P("""
    SELECT request_count, impression_count, request_count = impression_count AS passed
    FROM (SELECT r.request_count, (SELECT count(*) FROM fct_ad_impressions) AS impression_count
          FROM (SELECT count(*) FILTER (WHERE was_filled) AS request_count
                FROM stg_ad_requests) AS r)"""))(
    lambda spark, sf: (lambda w: recon.recon_filled(
        w.stg["stg_ad_requests"], w.fct_ad_impressions))(wh(spark, sf)))

_cum = micros("cumulative_spend")
_cents = "CAST(total_budget_usd * 100 AS HUGEINT)"
_expected_ratio = (
    f"CASE WHEN flight_days IS NULL OR flight_days = 0 OR elapsed_days >= flight_days "
    f"THEN {rr(_cum, _cents + ' * 10000', 3)} "
    f"ELSE {rr(_cum + ' * flight_days', _cents + ' * elapsed_days * 10000', 3)} END")
register("recon_pacing_ratio", P(f"""
    SELECT campaign_key, date_key, budget_pacing_ratio, expected_ratio,
           budget_pacing_ratio IS NOT DISTINCT FROM expected_ratio AS passed
    FROM (SELECT *, {_expected_ratio} AS expected_ratio FROM fct_campaign_daily)"""))(
    lambda spark, sf: recon.recon_pacing_ratio(wh(spark, sf).fct_campaign_daily))

register("recon_pacing_status", P(f"""
    SELECT campaign_key, date_key, budget_pacing_ratio, pacing_status, expected_status,
           pacing_status = expected_status AS passed
    FROM (SELECT *, {O.pacing_status_sql('budget_pacing_ratio')} AS expected_status
          FROM fct_campaign_daily)"""))(
    lambda spark, sf: recon.recon_pacing_status(wh(spark, sf).fct_campaign_daily))

register("recon_platform_health", P("""
    SELECT rollup_impressions, rollup_revenue, fact_impressions, fact_revenue,
           rollup_impressions = fact_impressions AND abs(rollup_revenue - fact_revenue) <= 1
               AS passed
    FROM (SELECT r.rollup_impressions, r.rollup_revenue,
                 (SELECT count(*) FROM fct_ad_impressions) AS fact_impressions,
                 (SELECT CAST(round(sum(revenue_usd), 2) AS DECIMAL(38,2))
                  FROM fct_ad_impressions) AS fact_revenue
          FROM (SELECT CAST(sum(total_impressions) AS BIGINT) AS rollup_impressions,
                       CAST(round(sum(total_revenue_usd), 2) AS DECIMAL(38,2)) AS rollup_revenue
                FROM mart_platform_health) AS r)"""))(
    lambda spark, sf: (lambda w: recon.recon_platform_health(
        w.mart_platform_health, w.fct_ad_impressions))(wh(spark, sf)))

register("recon_rpsh", P(f"""
    SELECT p.date_key, p.revenue_per_subscriber_hour, e.expected_rpsh,
           p.revenue_per_subscriber_hour IS NOT DISTINCT FROM e.expected_rpsh AS passed
    FROM mart_platform_health AS p JOIN (
        SELECT r.date_key, {rr(micros('r.rev') + ' * 3600', 'h.secs * 1000000', 4)} AS expected_rpsh
        FROM (SELECT date_key, CAST(sum(revenue_usd) AS DECIMAL(38,6)) AS rev
              FROM fct_ad_impressions GROUP BY date_key) AS r
        JOIN (SELECT date_key, sum(watch_seconds) AS secs FROM fct_viewing_sessions
              GROUP BY date_key) AS h ON r.date_key = h.date_key) AS e
    ON p.date_key = e.date_key"""))(
    lambda spark, sf: (lambda w: recon.recon_rpsh(
        w.mart_platform_health, w.fct_ad_impressions, w.fct_viewing_sessions))(wh(spark, sf)))


# --------------------------------------------------------------------------
# telemetry audits (V1-V18; V6 is dq_unique)
# --------------------------------------------------------------------------
def _raw(spark, sf, name):
    return wh(spark, sf).raw[name]


def _expanded(spark, sf):
    return prep.expand_sessions(_raw(spark, sf, "viewing_sessions"), spark)


register("audit_watch_floor", P(summary_sql("viewing_sessions", "watch_seconds < 30")))(
    lambda spark, sf: V.audit_watch_floor(_raw(spark, sf, "viewing_sessions")))

register("audit_slot_depth", P(f"""
    SELECT count(*) AS checked,
           count(*) FILTER (WHERE d.slot_depth IS NULL OR v.ad_requests <> d.slot_depth + 1) AS violations,
           count(*) FILTER (WHERE d.slot_depth IS NULL OR v.ad_requests <> d.slot_depth + 1) = 0 AS passed
    FROM viewing_sessions AS v LEFT JOIN slot_depths AS d ON v.deepest_slot = d.slot_position""",
    [SLOT_DEPTHS]))(lambda spark, sf: V.audit_slot_depth(_raw(spark, sf, "viewing_sessions"), spark))

register("audit_watch_monotone", P(f"""
    SELECT slot_depth, sessions, mean_watch_seconds,
           coalesce(mean_watch_seconds > lag(mean_watch_seconds) OVER (ORDER BY slot_depth), true) AS rises
    FROM (SELECT d.slot_depth, count(*) AS sessions,
                 {rr('sum(v.watch_seconds)', 'count(*)', 3)} AS mean_watch_seconds
          FROM viewing_sessions AS v JOIN slot_depths AS d ON v.deepest_slot = d.slot_position
          GROUP BY d.slot_depth)""", [SLOT_DEPTHS]))(
    lambda spark, sf: V.audit_watch_monotone(_raw(spark, sf, "viewing_sessions"), spark))

register("audit_ad_tier_only", P(f"""
    SELECT count(*) AS checked,
           count(*) FILTER (WHERE s.subscription_tier IS NULL OR s.subscription_tier = '{C.NO_ADS_TIER}')
               AS violations,
           count(*) FILTER (WHERE s.subscription_tier IS NULL OR s.subscription_tier = '{C.NO_ADS_TIER}') = 0
               AS passed
    FROM viewing_sessions AS v LEFT JOIN subscribers AS s ON v.subscriber_id = s.subscriber_id"""))(
    lambda spark, sf: (lambda w: V.audit_ad_tier_only(
        w.raw["viewing_sessions"], w.raw["subscribers"]))(wh(spark, sf)))

register("audit_session_window", P(f"""
    SELECT min(session_start) AS first_start, max(session_start) AS last_start,
           count(*) FILTER (WHERE session_start < TIMESTAMP '{B.SESSION_WINDOW_START}'
                            OR session_start >= TIMESTAMP '{B.SESSION_WINDOW_END}' + INTERVAL 1 DAY) AS violations,
           count(*) FILTER (WHERE session_start < TIMESTAMP '{B.SESSION_WINDOW_START}'
                            OR session_start >= TIMESTAMP '{B.SESSION_WINDOW_END}' + INTERVAL 1 DAY) = 0 AS passed
    FROM viewing_sessions"""))(
    lambda spark, sf: V.audit_session_window(_raw(spark, sf, "viewing_sessions"),
                                             B.SESSION_WINDOW_START, B.SESSION_WINDOW_END))

register("audit_orphan_requests", P("""
    SELECT (SELECT count(*) FROM expanded_requests) AS checked,
           (SELECT count(*) FROM expanded_requests AS r WHERE NOT EXISTS
               (SELECT 1 FROM viewing_sessions AS v WHERE v.session_id = r.session_id)) AS violations,
           (SELECT count(*) FROM expanded_requests AS r WHERE NOT EXISTS
               (SELECT 1 FROM viewing_sessions AS v WHERE v.session_id = r.session_id)) = 0 AS passed""",
    [SLOT_DEPTHS, EXPANDED]))(
    lambda spark, sf: V.audit_orphan_requests(_expanded(spark, sf), _raw(spark, sf, "viewing_sessions")))

register("audit_request_counts", P(summary_sql(
    "(SELECT v.ad_requests, coalesce(r.n, 0) AS n FROM viewing_sessions AS v LEFT JOIN "
    "(SELECT session_id, count(*) AS n FROM expanded_requests GROUP BY session_id) AS r "
    "ON v.session_id = r.session_id)", "n <> ad_requests"), [SLOT_DEPTHS, EXPANDED]))(
    lambda spark, sf: V.audit_request_counts(_expanded(spark, sf), _raw(spark, sf, "viewing_sessions")))

register("audit_slot_prefix", P(summary_sql(
    "(SELECT r.session_id, min(d.slot_depth) AS lo, max(d.slot_depth) AS hi, count(*) AS n, "
    "count(DISTINCT d.slot_depth) AS k FROM expanded_requests AS r JOIN slot_depths AS d "
    "ON r.slot_position = d.slot_position GROUP BY r.session_id)",
    "lo <> 0 OR hi <> n - 1 OR k <> n"), [SLOT_DEPTHS, EXPANDED]))(
    lambda spark, sf: V.audit_slot_prefix(_expanded(spark, sf), spark))

register("audit_request_in_session", P(summary_sql(
    "(SELECT r.request_timestamp, v.session_start, v.watch_seconds FROM expanded_requests AS r "
    "JOIN viewing_sessions AS v ON r.session_id = v.session_id)",
    "request_timestamp < session_start OR request_timestamp > "
    "session_start + to_seconds(CAST(watch_seconds AS BIGINT))"), [SLOT_DEPTHS, EXPANDED]))(
    lambda spark, sf: V.audit_request_in_session(_expanded(spark, sf),
                                                 _raw(spark, sf, "viewing_sessions")))

# the same audits over the given requests, which do not follow the sessions
register("audit_orphan_requests_given", P("""
    SELECT (SELECT count(*) FROM ad_requests) AS checked,
           (SELECT count(*) FROM ad_requests AS r WHERE NOT EXISTS
               (SELECT 1 FROM viewing_sessions AS v WHERE v.session_id = r.session_id)) AS violations,
           (SELECT count(*) FROM ad_requests AS r WHERE NOT EXISTS
               (SELECT 1 FROM viewing_sessions AS v WHERE v.session_id = r.session_id)) = 0 AS passed"""))(
    lambda spark, sf: V.audit_orphan_requests(_raw(spark, sf, "ad_requests"), _raw(spark, sf, "viewing_sessions")))

register("audit_request_counts_given", P(summary_sql(
    "(SELECT v.ad_requests, coalesce(r.n, 0) AS n FROM viewing_sessions AS v LEFT JOIN "
    "(SELECT session_id, count(*) AS n FROM ad_requests GROUP BY session_id) AS r "
    "ON v.session_id = r.session_id)", "n <> ad_requests")))(
    lambda spark, sf: V.audit_request_counts(_raw(spark, sf, "ad_requests"),
                                             _raw(spark, sf, "viewing_sessions")))

register("audit_slot_prefix_given", P(summary_sql(
    "(SELECT r.session_id, min(d.slot_depth) AS lo, max(d.slot_depth) AS hi, count(*) AS n, "
    "count(DISTINCT d.slot_depth) AS k FROM ad_requests AS r LEFT JOIN slot_depths AS d "
    "ON r.slot_position = d.slot_position GROUP BY r.session_id)",
    "k <> n OR coalesce(lo <> 0 OR hi <> n - 1, true)"), [SLOT_DEPTHS]))(
    lambda spark, sf: V.audit_slot_prefix(_raw(spark, sf, "ad_requests"), spark))

register("audit_request_in_session_given", P(summary_sql(
    "(SELECT r.request_timestamp, v.session_start, v.watch_seconds FROM ad_requests AS r "
    "JOIN viewing_sessions AS v ON r.session_id = v.session_id)",
    "request_timestamp < session_start OR request_timestamp > "
    "session_start + to_seconds(CAST(watch_seconds AS BIGINT))")))(
    lambda spark, sf: V.audit_request_in_session(_raw(spark, sf, "ad_requests"),
                                                 _raw(spark, sf, "viewing_sessions")))

register("ad_load_per_hour", P(f"""
    SELECT requests, watch_seconds, ads_per_hour, ads_per_hour >= 6 AND ads_per_hour <= 25 AS passed
    FROM (SELECT requests, watch_seconds, {rr('requests * 3600', 'watch_seconds', 2)} AS ads_per_hour
          FROM (SELECT r.requests,
                       (SELECT sum(watch_seconds) FROM viewing_sessions) AS watch_seconds
                FROM (SELECT count(*) AS requests FROM ad_requests) AS r))"""))(
    lambda spark, sf: (lambda w: V.ad_load_per_hour(
        w.raw["ad_requests"], w.raw["viewing_sessions"]))(wh(spark, sf)))

_PREFIXES = ("prefixes", "SELECT * FROM (VALUES " + ", ".join(
    f"('{o}', '{p}')" for o, names in C.CAMPAIGN_PREFIXES.items() for p in names) +
    ") AS t(objective, prefix)")
register("audit_campaign_name", P("""
    SELECT prefix, count(*) AS campaigns, count(DISTINCT objective) AS objectives,
           count(*) FILTER (WHERE ok IS NULL) AS foreign,
           count(DISTINCT objective) = 1 AND count(*) FILTER (WHERE ok IS NULL) = 0 AS passed
    FROM (SELECT c.objective, split_part(c.campaign_name, ' - ', 1) AS prefix, p.ok
          FROM campaigns AS c LEFT JOIN (SELECT *, true AS ok FROM prefixes) AS p
          ON c.objective = p.objective AND split_part(c.campaign_name, ' - ', 1) = p.prefix)
    GROUP BY prefix""", [_PREFIXES]))(
    lambda spark, sf: V.audit_campaign_name(_raw(spark, sf, "campaigns"), spark))

register("audit_objectives", P("SELECT objective, CAST(sum(n) AS BIGINT) AS campaigns, sum(n) > 0 AND bool_or(known) "
                               "AS passed FROM (SELECT objective, 0 AS n, true AS known FROM (VALUES " +
                               ", ".join(f"('{o}')" for o in C.OBJECTIVES) +
                               ") AS o(objective) UNION ALL SELECT objective, 1, false FROM campaigns) "
                               "GROUP BY objective"))(
    lambda spark, sf: V.audit_objectives(_raw(spark, sf, "campaigns"), spark))

register("audit_daily_budget", P(summary_sql(
    "campaigns", f"total_budget_usd <= 0 OR daily_budget_usd IS DISTINCT FROM "
    f"{rr('CAST(total_budget_usd * 100 AS HUGEINT)', 'CAST(flight_days AS BIGINT) * 100', 2, 12)}")))(
    lambda spark, sf: V.audit_daily_budget(_raw(spark, sf, "campaigns")))

_ratio = rr(micros("coalesce(d.delivered, 0)"), "CAST(c.total_budget_usd * 100 AS HUGEINT) * 10000", 3)
register("delivery_ratio_spread", P(f"""
    SELECT *, coalesce(abs(mean_ratio - 1) <= 0.1 AND under > 0 AND on_pace > 0 AND over > 0, false) AS passed
    FROM (
    SELECT count(*) AS campaigns, {rr('sum(r * 1000)', 'count(r) * 1000', 3)} AS mean_ratio,
           count(*) FILTER (WHERE r < 0.9) AS under,
           count(*) FILTER (WHERE r >= 0.9 AND r <= 1.1) AS on_pace,
           count(*) FILTER (WHERE r > 1.1) AS over
    FROM (SELECT {_ratio} AS r FROM campaigns AS c LEFT JOIN
          (SELECT campaign_id, sum(revenue_usd) AS delivered FROM ad_impressions GROUP BY campaign_id) AS d
          ON c.campaign_id = d.campaign_id))"""))(
    lambda spark, sf: (lambda w: V.delivery_ratio_spread(
        w.raw["campaigns"], w.raw["ad_impressions"]))(wh(spark, sf)))

FILL_TARGET_PCT = 85
register("audit_fill_target", P(f"""
    SELECT requests, filled, fill_rate_pct, {FILL_TARGET_PCT} AS target_pct,
           abs(fill_rate_pct - {FILL_TARGET_PCT}) <= 2 AS passed
    FROM (SELECT count(*) AS requests, count(*) FILTER (WHERE was_filled) AS filled,
                 {rr('count(*) FILTER (WHERE was_filled) * 100', 'count(*)', 4)} AS fill_rate_pct
          FROM ad_requests)"""))(
    lambda spark, sf: V.audit_fill_target(_raw(spark, sf, "ad_requests"), FILL_TARGET_PCT))

register("audit_filled_vs_served", P("""
    SELECT filled_not_served, served_not_filled,
           filled_not_served = 0 AND served_not_filled = 0 AS passed
    FROM (SELECT a.filled_not_served,
                 (SELECT count(*) FROM ad_impressions AS i WHERE NOT EXISTS
                  (SELECT 1 FROM ad_requests AS r WHERE r.was_filled AND r.request_id = i.request_id))
                     AS served_not_filled
          FROM (SELECT count(*) AS filled_not_served FROM ad_requests AS r
                WHERE r.was_filled AND NOT EXISTS
                (SELECT 1 FROM ad_impressions AS i WHERE i.request_id = r.request_id)) AS a)"""))(
    lambda spark, sf: (lambda w: V.audit_filled_vs_served(
        w.raw["ad_requests"], w.raw["ad_impressions"]))(wh(spark, sf)))

register("audit_in_flight", P(summary_sql(
    "(SELECT CAST(i.impression_timestamp AS DATE) AS d, c.flight_start, c.flight_end "
    "FROM ad_impressions AS i LEFT JOIN campaigns AS c ON i.campaign_id = c.campaign_id)",
    "flight_start IS NULL OR d < flight_start OR d > flight_end")))(
    lambda spark, sf: (lambda w: V.audit_in_flight(
        w.raw["ad_impressions"], w.raw["campaigns"]))(wh(spark, sf)))


# --------------------------------------------------------------------------
# reports (K1-K15)
# --------------------------------------------------------------------------
register("report_catalog", P(" UNION ALL ".join(
    f"SELECT '{n}' AS report_name, count(*) AS row_count FROM {m}"
    for n, m in report.REPORTS.items())))(lambda spark, sf: report.report_catalog(wh(spark, sf)))

_REPORT_ORDER = {"platform_health": " ORDER BY full_date",
                 "campaign_performance": " ORDER BY campaign_key, date_key",
                 "advertiser_summary": " ORDER BY total_spend DESC, advertiser_key"}
for _key, _mart in report.REPORTS.items():
    register(f"report_{_key}", P(f"SELECT * FROM {_mart}{_REPORT_ORDER.get(_key, '')}"))(
        (lambda name: lambda spark, sf: report.fetch(wh(spark, sf), name))(_key))

register("latest_health", P("SELECT * FROM mart_platform_health ORDER BY full_date DESC LIMIT 1"))(
    lambda spark, sf: report.latest_health(wh(spark, sf).mart_platform_health))

register("campaign_list", P("SELECT DISTINCT campaign_key, campaign_name, company_name "
                            "FROM mart_campaign_performance"))(
    lambda spark, sf: report.campaign_list(wh(spark, sf).mart_campaign_performance))

register("latest_campaign_pacing", P("""
    SELECT * FROM mart_campaign_performance
    QUALIFY row_number() OVER (PARTITION BY campaign_key ORDER BY date_key DESC) = 1"""))(
    lambda spark, sf: report.latest_campaign_pacing(wh(spark, sf).mart_campaign_performance))

register("top_advertisers", P("""
    SELECT * FROM mart_advertiser_summary ORDER BY total_spend DESC, advertiser_key LIMIT 10"""))(
    lambda spark, sf: report.top_advertisers(wh(spark, sf).mart_advertiser_summary))

register("revenue_by_vertical", P("""
    SELECT industry_vertical, sum(total_spend) AS total_spend FROM mart_advertiser_summary
    GROUP BY industry_vertical"""))(
    lambda spark, sf: report.revenue_by_vertical(wh(spark, sf).mart_advertiser_summary))

register("frequency_summary", P(f"""
    SELECT {rr('sum(violation_rate_pct * 10)', 'count(*) * 10', 2)} AS mean_violation_rate_pct,
           {rr('sum(avg_frequency * 10)', 'count(*) * 10', 2)} AS mean_frequency,
           CAST(sum(total_subscribers) AS BIGINT) AS total_reach,
           {band_sql('CAST(sum(violation_rate_pct * 10) AS DOUBLE) / (count(*) * 10)', C.FREQUENCY_VIOLATION_PCT)}
               AS violation_verdict
    FROM mart_frequency_analysis"""))(
    lambda spark, sf: report.frequency_summary(wh(spark, sf).mart_frequency_analysis))

_CURVE = ("planned_curve", f"""
    SELECT campaign_key, flight_day,
           {rr('CAST(total_budget_usd * 100 AS HUGEINT) * flight_day', 'CAST(flight_days AS BIGINT) * 100', 2)}
               AS planned_spend_usd
    FROM (SELECT campaign_key, total_budget_usd, flight_days,
                 unnest(range(1, flight_days + 1)) AS flight_day FROM dim_campaigns)""")
register("planned_spend_curve", P("SELECT * FROM planned_curve", [_CURVE]))(
    lambda spark, sf: report.planned_spend_curve(wh(spark, sf).dim_campaigns))

register("planned_vs_actual", P("""
    SELECT campaign_key, flight_day, max(planned) AS planned_spend_usd, max(actual) AS actual_spend_usd
    FROM (SELECT campaign_key, flight_day, planned_spend_usd AS planned, NULL AS actual
          FROM planned_curve
          UNION ALL
          SELECT campaign_key, elapsed_days, NULL, cumulative_spend FROM mart_campaign_performance)
    GROUP BY campaign_key, flight_day""", [_CURVE]))(
    lambda spark, sf: (lambda w: report.planned_vs_actual(
        report.planned_spend_curve(w.dim_campaigns), w.mart_campaign_performance))(wh(spark, sf)))

register("kpi_bands", P(f"""
    SELECT date_key, {band_sql('fill_rate_pct', C.FILL_RATE_PCT)} AS fill_verdict,
           {band_sql('ecpm_usd', C.ECPM_USD)} AS ecpm_verdict,
           {band_sql('viewability_rate_pct', C.VIEWABILITY_PCT)} AS viewability_verdict,
           {band_sql('revenue_per_subscriber_hour', C.RPSH_USD)} AS rpsh_verdict
    FROM mart_platform_health"""))(lambda spark, sf: report.kpi_bands(wh(spark, sf).mart_platform_health))

register("verdicts", P(f"""
    SELECT campaign_key, date_key, pacing_status,
           {O.case_map(C.PACING_STATUS_VERDICT, 'pacing_status', "'unknown'")} AS verdict
    FROM mart_campaign_performance"""))(
    lambda spark, sf: report.pacing_verdicts(wh(spark, sf).mart_campaign_performance))

register("concentration_verdict", P(f"""
    SELECT concentration_band,
           {O.case_map(C.CONCENTRATION_VERDICT, 'concentration_band', "'unknown'")} AS verdict
    FROM mart_advertiser_concentration"""))(
    lambda spark, sf: report.concentration_verdict(wh(spark, sf).mart_advertiser_concentration))


def _opt_sql(x: str) -> str:
    v = f"TRY_CAST(CAST({x} AS VARCHAR) AS DOUBLE)"
    return f"CASE WHEN isnan({v}) THEN NULL ELSE {v} END"


def _optional_number(spark, sf):
    h = wh(spark, sf).mart_platform_health
    cols = ["fill_rate_pct", "ecpm_usd", "revenue_per_subscriber_hour"]
    return h.select("date_key", *[optional_number(c).alias(c) for c in cols])


register("optional_number", P(f"""
    SELECT date_key, {_opt_sql('fill_rate_pct')} AS fill_rate_pct, {_opt_sql('ecpm_usd')} AS ecpm_usd,
           {_opt_sql('revenue_per_subscriber_hour')} AS revenue_per_subscriber_hour
    FROM mart_platform_health"""))(_optional_number)


register("campaign_violation_bands", P(f"""
    SELECT campaign_key, campaign_name, violation_rate_pct,
           {band_sql('violation_rate_pct', C.FREQUENCY_VIOLATION_PCT)} AS verdict
    FROM mart_frequency_analysis"""))(
    lambda spark, sf: report.campaign_violation_bands(wh(spark, sf).mart_frequency_analysis))


def _label_sql(x: str, n: int, prefix: str = "", suffix: str = "") -> str:
    rounded = f"CAST(round(CAST({_opt_sql(x)} AS DECIMAL(38,10)), {n}) AS DOUBLE)"
    return f"coalesce('{prefix}' || format('{{:,.{n}f}}', {rounded}) || '{suffix}', 'n/a')"


register("metric_labels", P(f"""
    SELECT date_key, {_label_sql('fill_rate_pct', 1, suffix='%')} AS fill_rate_label,
           {_label_sql('ecpm_usd', 2, '$').replace(':,', ':')} AS ecpm_label,
           {_label_sql('completion_rate_pct', 1, suffix='%')} AS completion_label,
           {_label_sql('viewability_rate_pct', 1, suffix='%')} AS viewability_label,
           {_label_sql('revenue_per_subscriber_hour', 3, '$').replace(':,', ':')} AS rpsh_label,
           {_label_sql('total_revenue_usd', 0, '$')} AS daily_revenue_label
    FROM mart_platform_health"""))(lambda spark, sf: report.metric_labels(wh(spark, sf).mart_platform_health))


# --------------------------------------------------------------------------
# preparation jobs
# --------------------------------------------------------------------------
STATUS_PROBE_DATE = "1999-12-31"
register("campaign_status", P(f"""
    SELECT campaign_id, flight_start, flight_end,
           {O._status('flight_start', 'flight_end', STATUS_PROBE_DATE)} AS status FROM campaigns"""))(
    lambda spark, sf: _raw(spark, sf, "campaigns").select(
        "campaign_id", "flight_start", "flight_end",
        prep.campaign_status("flight_start", "flight_end", STATUS_PROBE_DATE).alias("status")))

register("ad_supported_audience", P(f"""
    SELECT subscriber_id, subscription_tier FROM subscribers
    WHERE subscription_tier <> '{C.NO_ADS_TIER}'"""))(
    lambda spark, sf: prep.ad_supported_audience(_raw(spark, sf, "subscribers")).select(
        "subscriber_id", "subscription_tier"))

register("campaign_label", P("SELECT campaign_id, objective, campaign_name FROM campaigns"))(
    lambda spark, sf: _raw(spark, sf, "campaigns").select("campaign_id", "objective", "campaign_name"))

register("expand_sessions", P("SELECT * FROM expanded_requests", [SLOT_DEPTHS, EXPANDED]))(_expanded)

_ALLOC = ("allocation", f"""
    WITH iv AS (
        SELECT day, campaign_id,
               (coalesce(sum(cents) OVER (PARTITION BY day ORDER BY campaign_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 1152921504606846976)
                   // sum(cents) OVER (PARTITION BY day) AS lo,
               ((coalesce(sum(cents) OVER (PARTITION BY day ORDER BY campaign_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + cents) * 1152921504606846976)
                   // sum(cents) OVER (PARTITION BY day) AS hi
        FROM (SELECT day, campaign_id, CAST(total_budget_usd * 100 AS BIGINT) AS cents FROM in_flight
              WHERE campaign_id IS NOT NULL AND total_budget_usd > 0)),
    req AS (SELECT request_id, CAST(request_timestamp AS DATE) AS day, {draw_sql('request_id')} AS u
            FROM ad_requests WHERE was_filled)
    SELECT r.request_id, r.day, iv.campaign_id,
           CASE WHEN r.day IS NULL OR r.day NOT IN (SELECT day FROM in_flight WHERE campaign_id IS NOT NULL)
                THEN '{C.NO_CAMPAIGN_IN_FLIGHT}' END AS unallocated_reason
    FROM req AS r LEFT JOIN iv ON r.day = iv.day AND r.u >= iv.lo AND r.u < iv.hi""")
register("weighted_allocation", P("SELECT * FROM allocation", [FLIGHT_DAYS, _ALLOC]))(
    lambda spark, sf: (lambda w: prep.weighted_allocation(
        w.raw["ad_requests"].filter("was_filled"),
        prep.in_flight_candidates(_filled_days(w), w.raw["campaigns"], strict=False)))(wh(spark, sf)))


def _target_pct(x):
    return F.lit(55) + prep.unit_draw(x) % 91


register("calibrate_budgets", P(f"""
    SELECT campaign_id, total_budget_usd,
           {rr('CAST(total_budget_usd * 100 AS HUGEINT)', 'CAST(flight_days AS BIGINT) * 100', 2, 12)} AS daily_budget_usd
    FROM (SELECT c.campaign_id, c.flight_days,
                 greatest({rr(micros('coalesce(d.delivered, 0)') + ' * 100',
                              f"(55 + {draw_sql('c.campaign_id')} % 91) * 1000000", 2, 12)},
                          CAST(c.flight_days * 0.10 AS DECIMAL(12,2))) AS total_budget_usd
          FROM campaigns AS c LEFT JOIN (SELECT campaign_id, sum(revenue_usd) AS delivered
                                         FROM ad_impressions GROUP BY campaign_id) AS d
          ON c.campaign_id = d.campaign_id)"""))(
    lambda spark, sf: (lambda w: prep.calibrate_budgets(
        w.raw["campaigns"], w.raw["ad_impressions"], _target_pct("campaign_id"))
        .select("campaign_id", "total_budget_usd", "daily_budget_usd"))(wh(spark, sf)))

register("clearing_revenue", P(f"""
    SELECT l_orderkey, l_linenumber, {rr('c', '100000', 6)} AS bid_price_usd,
           {rr('c * (100 - d)', '10000000', 6)} AS revenue_usd
    FROM (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) AS c,
                 CAST(round(l_discount * 100) AS BIGINT) AS d FROM lineitem)"""))(
    lambda spark, sf: _clearing(spark, sf))


def _clearing(spark, sf):
    li = B.read_tpch(spark, sf, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    disc = F.round(F.col("l_discount") * 100).cast("long")
    price, revenue = prep.clearing_revenue(cents, disc)
    return li.select("l_orderkey", "l_linenumber", price.alias("bid_price_usd"),
                     revenue.alias("revenue_usd"))


register("platform_summary", P(f"""
    SELECT {rr(micros('i.revenue'), 'i.impressions * 1000', 2)} AS ecpm_usd,
           {rr('i.n_completed * 100', 'i.impressions', 1)} AS completion_rate_pct,
           {rr('i.n_viewable * 100', 'i.impressions', 1)} AS viewability_rate_pct,
           {rr(micros('i.bids'), 'i.impressions * 1000', 2)} AS avg_bid_cpm_usd,
           {rr('(SELECT count(*) FILTER (WHERE was_filled) FROM ad_requests) * 100',
               '(SELECT count(*) FROM ad_requests)', 1)} AS fill_rate_pct
    FROM (SELECT count(*) AS impressions, sum(revenue_usd) AS revenue, sum(bid_price_usd) AS bids,
                 count(*) FILTER (WHERE completed) AS n_completed,
                 count(*) FILTER (WHERE is_viewable) AS n_viewable FROM ad_impressions) AS i"""))(
    lambda spark, sf: (lambda w: prep.platform_summary(
        w.raw["ad_impressions"], w.raw["ad_requests"]))(wh(spark, sf)))

register("status_counts", P("SELECT status, count(*) AS n FROM campaigns GROUP BY status"))(
    lambda spark, sf: prep.value_counts(_raw(spark, sf, "campaigns"), "status"))
register("tier_counts", P("SELECT subscription_tier, count(*) AS n FROM subscribers "
                          "GROUP BY subscription_tier"))(
    lambda spark, sf: prep.value_counts(_raw(spark, sf, "subscribers"), "subscription_tier"))

register("viewing_summary", P(f"""
    SELECT {rr('sum(watch_seconds)', '3600', 1)} AS viewing_hours,
           {rr('sum(watch_seconds)', 'count(*) * 60', 2)} AS mean_session_minutes,
           count(*) AS sessions FROM viewing_sessions"""))(
    lambda spark, sf: prep.viewing_summary(_raw(spark, sf, "viewing_sessions")))


# --------------------------------------------------------------------------
# reach over any span, from bitmaps that merge
# --------------------------------------------------------------------------

register("reach_by_day", P("""
    SELECT date_key, count(DISTINCT subscriber_key) AS reach
    FROM fct_ad_impressions GROUP BY date_key"""))(
    lambda spark, sf: (lambda w: reach.reach(reach.reach_bitmaps(
        w.fct_ad_impressions, w.dim_subscribers, ["date_key"]), ["date_key"]))(wh(spark, sf)))

register("reach_by_week", P("""
    SELECT CAST(date_trunc('week', full_date) AS DATE) AS week_start,
           count(DISTINCT subscriber_key) AS reach
    FROM fct_ad_impressions JOIN dim_date_ads USING (date_key) GROUP BY 1"""))(
    lambda spark, sf: (lambda w: reach.weekly_reach(reach.reach_bitmaps(
        w.fct_ad_impressions, w.dim_subscribers, ["date_key"]), w.dim_date_ads))(wh(spark, sf)))

register("reach_by_campaign", P("""
    SELECT campaign_key, count(DISTINCT subscriber_key) AS reach
    FROM fct_ad_impressions GROUP BY campaign_key"""))(
    lambda spark, sf: (lambda w: reach.reach(reach.reach_bitmaps(
        w.fct_ad_impressions, w.dim_subscribers, ["campaign_key", "date_key"]),
        ["campaign_key"]))(wh(spark, sf)))

register("reach_by_advertiser_week", P("""
    SELECT c.advertiser_key, CAST(date_trunc('week', d.full_date) AS DATE) AS week_start,
           count(DISTINCT f.subscriber_key) AS reach
    FROM fct_ad_impressions AS f JOIN dim_campaigns AS c ON f.campaign_key = c.campaign_key
    JOIN dim_date_ads AS d ON f.date_key = d.date_key GROUP BY 1, 2"""))(
    lambda spark, sf: (lambda w: reach.advertiser_weekly_reach(reach.reach_bitmaps(
        w.fct_ad_impressions, w.dim_subscribers, ["campaign_key", "date_key"]),
        w.dim_campaigns, w.dim_date_ads))(wh(spark, sf)))
