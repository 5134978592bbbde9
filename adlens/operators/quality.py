"""Declarative data-quality checks (not_null, unique, unique combination,
accepted values, accepted range, relationships) and the enforced contracts.

Each check yields one row ``(model, check_name, column_name, failures)``
where ``failures`` is the number of rows the check's failing-row query would
return (zero = pass):

* not_null / accepted_range: rows that violate the predicate;
* accepted_values: distinct non-null values outside the list;
* unique / unique_combination: key values occurring more than once;
* relationships: non-null child rows whose key is absent from the parent.

``run_checks`` reads each model once: what a row violates and the keys it holds go to
one shuffle that counts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens import constants as C
from adlens.functions.joins import is_small_id_set as is_small
from adlens.functions.packed import PACKED_SQL, block_sql, held_sql, id_blocks, packs

NN, U, AV, FK, AR, UC = ("not_null", "unique", "accepted_values", "relationships",
                         "accepted_range", "unique_combination_of_columns")

# ---------------------------------------------------------------------------
# FIXED VALUES: the check declarations per model (295 checks).
# ---------------------------------------------------------------------------
CHECKS: dict[str, dict] = {
    # staging
    "stg_advertisers": {
        NN: ["advertiser_id", "company_name", "industry_vertical", "spend_tier", "country"],
        U: ["advertiser_id"],
        AV: {"industry_vertical": C.VERTICALS, "spend_tier": C.SPEND_TIERS}},
    "stg_content_catalog": {
        NN: ["content_id", "title", "content_type", "genre", "avg_episode_minutes",
             "maturity_rating"],
        U: ["content_id"],
        AV: {"content_type": C.CONTENT_TYPES, "maturity_rating": C.MATURITY_RATINGS}},
    "stg_subscribers": {
        NN: ["subscriber_id", "subscription_tier", "signup_date", "region", "device_primary",
             "age_band"],
        U: ["subscriber_id"],
        AV: {"subscription_tier": C.SUB_TIERS, "device_primary": C.DEVICES,
             "age_band": C.AGE_BANDS}},
    "stg_campaigns": {
        NN: ["campaign_id", "advertiser_id", "campaign_name", "objective", "daily_budget_usd",
             "total_budget_usd", "flight_start", "flight_end", "flight_days", "frequency_cap",
             "pacing_goal", "status"],
        U: ["campaign_id"],
        AV: {"objective": C.OBJECTIVES, "pacing_goal": C.PACING_GOALS,
             "status": C.CAMPAIGN_STATUSES}},
    "stg_ad_slots": {
        NN: ["slot_position", "typical_duration_sec", "avg_completion_rate", "avg_viewability"],
        U: ["slot_position"]},
    "stg_ad_requests": {
        NN: ["request_id", "session_id", "subscriber_id", "content_id", "slot_position",
             "request_timestamp", "device", "was_filled"],
        U: ["request_id"],
        FK: {"session_id": ("stg_viewing_sessions", "session_id")}},
    "stg_ad_impressions": {
        NN: ["impression_id", "request_id", "campaign_id", "advertiser_id", "subscriber_id",
             "content_id", "slot_position", "device", "bid_price_usd", "revenue_usd",
             "is_viewable", "completed", "view_duration_sec", "impression_timestamp"],
        U: ["impression_id"]},
    "stg_viewing_sessions": {
        NN: ["session_id", "subscriber_id", "content_id", "session_start", "device",
             "watch_seconds", "deepest_slot", "ad_requests"],
        U: ["session_id"],
        AV: {"deepest_slot": C.SLOT_ORDER},
        AR: {"watch_seconds": (30, None), "ad_requests": (1, 6)}},
    # marts
    "dim_advertisers": {
        NN: ["advertiser_key", "advertiser_id", "company_name", "industry_vertical",
             "spend_tier", "country"],
        U: ["advertiser_key", "advertiser_id"]},
    "dim_content": {
        NN: ["content_key", "content_id", "title", "content_type", "genre",
             "avg_episode_minutes", "maturity_rating"],
        U: ["content_key", "content_id"]},
    "dim_subscribers": {
        NN: ["subscriber_key", "subscriber_id", "subscription_tier", "signup_date", "region",
             "device_primary", "age_band"],
        U: ["subscriber_key", "subscriber_id"]},
    "dim_campaigns": {
        NN: ["campaign_key", "campaign_id", "advertiser_key", "campaign_name", "objective",
             "daily_budget_usd", "total_budget_usd", "flight_start", "flight_end", "flight_days",
             "frequency_cap", "pacing_goal", "status"],
        U: ["campaign_key", "campaign_id"],
        AV: {"pacing_goal": C.PACING_GOALS, "status": C.CAMPAIGN_STATUSES},
        FK: {"advertiser_key": ("dim_advertisers", "advertiser_key")}},
    "dim_ad_slots": {
        NN: ["slot_key", "slot_position", "typical_duration_sec", "avg_completion_rate",
             "avg_viewability"],
        U: ["slot_key", "slot_position"]},
    "dim_date_ads": {
        NN: ["date_key", "full_date", "day_of_week", "is_weekend", "week_of_year",
             "month_name", "quarter", "year"],
        U: ["date_key"]},
    "fct_ad_impressions": {
        NN: ["impression_id", "request_id", "campaign_key", "advertiser_key", "subscriber_key",
             "content_key", "slot_key", "date_key", "bid_price_usd", "revenue_usd",
             "is_viewable", "completed", "view_duration_sec", "device", "impression_timestamp"],
        U: ["impression_id"],
        FK: {"campaign_key": ("dim_campaigns", "campaign_key"),
             "advertiser_key": ("dim_advertisers", "advertiser_key"),
             "subscriber_key": ("dim_subscribers", "subscriber_key"),
             "content_key": ("dim_content", "content_key"),
             "slot_key": ("dim_ad_slots", "slot_key"),
             "date_key": ("dim_date_ads", "date_key")}},
    "fct_campaign_daily": {
        NN: ["campaign_key", "date_key", "impressions_served", "impressions_viewable",
             "impressions_completed", "revenue_usd", "unique_subscribers", "total_budget_usd",
             "cumulative_spend", "elapsed_days", "flight_days", "pacing_status"],
        AV: {"pacing_status": C.PACING_STATUSES}},
    "fct_viewing_sessions": {
        NN: ["session_id", "subscriber_key", "content_key", "date_key", "watch_seconds",
             "deepest_slot", "ad_requests", "device", "session_start"],
        U: ["session_id"],
        FK: {"subscriber_key": ("dim_subscribers", "subscriber_key"),
             "content_key": ("dim_content", "content_key"),
             "date_key": ("dim_date_ads", "date_key"),
             "deepest_slot": ("dim_ad_slots", "slot_position")},
        AR: {"watch_seconds": (30, None), "ad_requests": (1, 6)}},
    # analytics
    "mart_platform_health": {
        UC: [["date_key"]],
        NN: ["date_key", "full_date", "total_requests", "total_impressions",
             "completion_rate_pct", "viewability_rate_pct", "total_revenue_usd",
             "unique_subscribers", "viewing_hours"],
        U: ["date_key"],
        FK: {"date_key": ("dim_date_ads", "date_key")},
        AR: {"total_requests": (0, None), "total_impressions": (0, None),
             "fill_rate_pct": (0, 100), "ecpm_usd": (0, None),
             "completion_rate_pct": (0, 100), "viewability_rate_pct": (0, 100),
             "total_revenue_usd": (0, None), "unique_subscribers": (0, None),
             "viewing_hours": (0, None), "revenue_per_subscriber_hour": (0, None)}},
    "mart_campaign_performance": {
        UC: [["campaign_key", "date_key"]],
        NN: ["campaign_key", "campaign_name", "company_name", "industry_vertical", "date_key",
             "elapsed_days", "impressions", "revenue_usd", "cumulative_spend",
             "total_budget_usd", "flight_days", "pacing_status", "frequency_cap"],
        FK: {"campaign_key": ("dim_campaigns", "campaign_key"),
             "date_key": ("dim_date_ads", "date_key")},
        AV: {"pacing_status": C.PACING_STATUSES},
        AR: {"elapsed_days": (1, None), "impressions": (0, None), "revenue_usd": (0, None),
             "cumulative_spend": (0, None), "total_budget_usd": (0, None),
             "flight_days": (1, None), "budget_pacing_ratio": (0, None)}},
    "mart_advertiser_summary": {
        NN: ["advertiser_key", "company_name", "industry_vertical", "spend_tier",
             "total_spend", "total_impressions", "completion_rate_pct",
             "viewability_rate_pct", "campaign_count", "revenue_share_pct"],
        U: ["advertiser_key"],
        FK: {"advertiser_key": ("dim_advertisers", "advertiser_key")},
        AR: {"total_spend": (0, None), "total_impressions": (0, None), "ecpm": (0, None),
             "completion_rate_pct": (0, 100), "viewability_rate_pct": (0, 100),
             "campaign_count": (1, None), "revenue_share_pct": (0, 100)}},
    "mart_content_monetization": {
        UC: [["genre", "date_key"]],
        NN: ["genre", "date_key", "impressions", "revenue_usd", "avg_view_duration_sec"],
        FK: {"date_key": ("dim_date_ads", "date_key")},
        AR: {"impressions": (0, None), "revenue_usd": (0, None),
             "avg_view_duration_sec": (0, 30)}},
    "mart_advertiser_concentration": {
        NN: ["hhi", "concentration_band", "advertiser_count", "top_advertiser_share_pct"],
        AV: {"concentration_band": C.CONCENTRATION_BANDS},
        AR: {"hhi": (0, 10000), "advertiser_count": (1, None),
             "top_advertiser_share_pct": (0, 100)}},
    "mart_frequency_analysis": {
        NN: ["campaign_key", "campaign_name", "frequency_cap", "total_subscribers",
             "subscribers_exceeding_cap", "total_violations", "violation_rate_pct",
             "avg_frequency"],
        U: ["campaign_key"],
        FK: {"campaign_key": ("dim_campaigns", "campaign_key")},
        AR: {"frequency_cap": (1, None), "total_subscribers": (1, None),
             "subscribers_exceeding_cap": (0, None), "total_violations": (0, None),
             "violation_rate_pct": (0, 100), "avg_frequency": (0, None)}},
}

CHECK_TYPES = [NN, U, UC, AV, FK, AR]
RESULT_COLUMNS = ["model", "check_name", "column_name", "failures"]


def count_checks() -> dict[str, int]:
    out = {t: 0 for t in CHECK_TYPES}
    for spec in CHECKS.values():
        for t, v in spec.items():
            out[t] += len(v)
    return out


def _q(name: str) -> str:
    return f"`{name}`"


def _lit(v) -> str:
    return "'" + str(v).replace("'", "\\'") + "'"


def _row_level(spec: dict, types, parent_of) -> tuple[list[tuple[str, str, str]], str, list[str]]:
    """((check, column, violated) of not_null, accepted_range and each relationship whose
    parent can be looked up; the joins of those parents; their aliases). A parent is
    joined on its distinct keys or blocks, so that no row of the model repeats."""
    found, joins, aliases = [], "", []
    if NN in types:
        found += [(NN, c, f"ch.{_q(c)} IS NULL") for c in spec.get(NN, [])]
    if AR in types:
        for c, (lo, hi) in spec.get(AR, {}).items():
            conds = ([f"ch.{_q(c)} < {lo}"] if lo is not None else []) + \
                    ([f"ch.{_q(c)} > {hi}"] if hi is not None else [])
            found.append((AR, c, " OR ".join(conds)))
    if FK in types:
        for c, (parent, pcol) in spec.get(FK, {}).items():
            held, p, fk = parent_of(parent, pcol), f"p{len(aliases)}", f"ch.{_q(c)}"
            if held is None:
                continue
            view, packed = held
            aliases.append(p)
            if packed:
                joins += f" LEFT JOIN {view} AS {p} ON {block_sql(fk)} = {p}.block"
                found.append((FK, c, f"{fk} IS NOT NULL AND NOT {held_sql(p + '.bits', fk)}"))
            else:
                joins += (f" LEFT JOIN (SELECT DISTINCT {_q(pcol)} AS pk FROM {view}) AS {p} "
                          f"ON {fk} = {p}.pk")
                found.append((FK, c, f"{fk} IS NOT NULL AND {p}.pk IS NULL"))
    return found, joins, aliases


def _grouped_keys(spec: dict, types) -> list[tuple[str, str, str]]:
    """(check, column, key) of the checks that count distinct keys: the text of
    a unique key (null: no key), the JSON of a combination (injective, nulls
    left out), and a value outside its accepted list (null: none)."""
    out = []
    if U in types:
        out += [(U, c, f"CAST(ch.{_q(c)} AS STRING)") for c in spec.get(U, [])]
    if UC in types:
        for cols in spec.get(UC, []):
            fields = ", ".join(f"{_lit(c)}, ch.{_q(c)}" for c in cols)
            out.append((UC, ",".join(cols), f"to_json(named_struct({fields}))"))
    if AV in types:
        for c, values in spec.get(AV, {}).items():
            lst, v = ", ".join(_lit(v) for v in values), f"ch.{_q(c)}"
            out.append((AV, c, f"CASE WHEN {v} NOT IN ({lst}) THEN CAST({v} AS STRING) END"))
    return out


def run_checks(resolve, models=None, types=tuple(CHECK_TYPES)) -> DataFrame:
    """All checks of ``types`` over ``models``; ``resolve(name)`` gives a model.

    The whole report is ONE Spark SQL statement over a temp view per model
    (planned in the JVM, so building it costs a handful of driver calls
    whatever the number of checks). It reads each model once, plus once per
    relationship to a large parent, since the staging models join their tables anew
    each time they are read:

    * each row hands on what it violates (an empty key) and its keys of the unique,
      unique-combination and accepted-values checks to a single shuffle by (check id,
      key), then a tiny count per check of rows, repeated keys or values. Keys travel
      packed (an md5 as 16 bytes), and partial aggregation collapses the violations and
      a hot key before that shuffle;
    * relationships are looked up in broadcast keys, or packed blocks of them; a parent
      too large for both is met by a LEFT ANTI join of the key's counts
      (a key that many rows share is one row of it).

    Callers at scale should hand in materialised models (``Warehouse`` with
    ``persist``) so each model is computed once.
    """
    models = models or list(CHECKS)
    views: dict[str, str] = {}
    parents: dict[tuple[str, str], tuple[str, bool] | None] = {}
    spark = None

    def named(df: DataFrame, name: str) -> str:
        nonlocal spark
        spark = df.sparkSession
        view = f"adlens_dq_{name}_{abs(df.semanticHash())}"
        df.createOrReplaceTempView(view)
        return view

    def view(name: str) -> str:
        if name not in views:
            views[name] = named(resolve(name), name)
        return views[name]

    def parent_of(name: str, key: str) -> tuple[str, bool] | None:
        """The view to look a parent's key up in, and whether it is packed; None: too large."""
        if (name, key) not in parents:
            ids = resolve(name).select(key)
            parents[name, key] = (view(name), False) if is_small(ids) else (
                named(id_blocks(ids), f"{name}_blocks"), True) if packs(ids) else None
        return parents[name, key]

    def is_text(name: str, column: str) -> bool:
        return resolve(name).schema[column].dataType.simpleString() == "string"

    parts: list[str] = []
    keys, listing = [], []
    for model in models:
        spec = CHECKS[model]
        if FK in types:
            for c, (parent, pcol) in spec.get(FK, {}).items():
                if parent_of(parent, pcol) is None:
                    both = is_text(model, c) and is_text(parent, pcol)
                    fk, pk = (PACKED_SQL.format(_q(x)) if both else _q(x) for x in (c, pcol))
                    parts.append(
                        f"SELECT {_lit(model)} AS model, {_lit(FK)} AS check_name, "
                        f"{_lit(c)} AS column_name, "
                        "CAST(coalesce(sum(ch.n), 0) AS BIGINT) AS failures "
                        f"FROM (SELECT {fk} AS fk, count(*) AS n FROM {view(model)} "
                        f"WHERE {_q(c)} IS NOT NULL GROUP BY {fk}) AS ch LEFT ANTI JOIN "
                        f"(SELECT {pk} AS pk FROM {view(parent)}) AS p ON ch.fk = p.pk")
        found, joins, aliases = _row_level(spec, types, parent_of)
        pairs = []
        for kind, column, key in [(t, c, f"IF({bad}, '', NULL)") for t, c, bad in found] + \
                _grouped_keys(spec, types):
            pairs.append(f"{len(listing)}, {key}")
            listing.append(f"({len(listing)}, {_lit(model)}, {_lit(kind)}, {_lit(column)})")
        if pairs:
            hint = f"/*+ BROADCAST({', '.join(aliases)}) */ " if aliases else ""
            keys.append(f"SELECT cid, {PACKED_SQL.format('k')} AS k FROM (SELECT {hint}"
                        f"stack({len(pairs)}, {', '.join(pairs)}) AS (cid, k) "
                        f"FROM {view(model)} AS ch{joins}) WHERE k IS NOT NULL")
    if keys:
        parts.append(
            "SELECT l.model, l.check_name, l.column_name, CAST(coalesce("
            f"CASE WHEN l.check_name = {_lit(AV)} THEN d.kinds WHEN l.check_name IN ({_lit(U)}, "
            f"{_lit(UC)}) THEN d.repeated ELSE d.found END, 0) AS BIGINT) AS failures "
            f"FROM (SELECT * FROM VALUES {', '.join(listing)} AS t(cid, model, check_name, column_name)) AS l "
            "LEFT JOIN (SELECT cid, count(*) AS kinds, count_if(n > 1) AS repeated, sum(n) AS found FROM "
            "(SELECT cid, k, count(*) AS n FROM (" + " UNION ALL ".join(keys) +
            ") GROUP BY cid, k) GROUP BY cid) AS d ON l.cid = d.cid")
    if spark is None:
        raise ValueError("no checks selected")
    return spark.sql("\nUNION ALL\n".join(f"({p})" for p in parts))


def failing(report: DataFrame) -> DataFrame:
    return report.filter(F.col("failures") > 0)


def assert_clean(report: DataFrame) -> None:
    """Fail the build on any failing check (collects only failing check rows)."""
    bad = failing(report).collect()
    if bad:
        lines = [f"{r.model}.{r.column_name} {r.check_name}: {r.failures}" for r in bad]
        raise AssertionError("data-quality checks failed:\n" + "\n".join(lines))


# --------------------------- contracts ------------------------------------

def contract_diff(model: str, df: DataFrame, contract) -> list[tuple[str, str, str, str]]:
    """(model, column, expected, actual) for each column that breaks the contract."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    expected = {f.name: f.dataType.simpleString() for f in contract.fields}
    diffs = []
    for name, typ in expected.items():
        if actual.get(name) != typ:
            diffs.append((model, name, typ, actual.get(name, "<missing>")))
    for name in actual:
        if name not in expected:
            diffs.append((model, name, "<absent>", actual[name]))
    if [f.name for f in df.schema.fields] != [f.name for f in contract.fields] and not diffs:
        diffs.append((model, "<order>", ",".join(expected), ",".join(actual)))
    return diffs


def enforce_contract(model: str, df: DataFrame, contract) -> DataFrame:
    diffs = contract_diff(model, df, contract)
    if diffs:
        raise ValueError(f"contract broken for {model}: {diffs}")
    return df
