"""Fixed values of the ad-delivery domain.

Everything in this module is a FIXED VALUE: vocabularies, thresholds and the
slot table must equal the published definitions for results to be right.
They are listed plainly, in their natural order, and used by index or lookup
elsewhere. Nothing here is computed.
"""

from __future__ import annotations

# --- FIXED VALUES: vocabularies -------------------------------------------

VERTICALS = [
    "Automotive", "CPG", "Entertainment", "Finance", "Healthcare",
    "Retail", "Technology", "Telecom", "Travel", "QSR",
]
VERTICAL_SHORT = {
    "Automotive": "Auto", "CPG": "CPG", "Finance": "Fin",
    "Entertainment": "Ent", "Technology": "Tech", "Retail": "Retail",
    "Travel": "Travel", "Healthcare": "Health", "Telecom": "Telco",
    "QSR": "QSR",
}
SPEND_TIERS = ["Enterprise", "Growth", "Starter", "Self-Serve"]
CONTENT_TYPES = ["series", "movie", "special"]
MATURITY_RATINGS = ["TV-G", "TV-PG", "TV-14", "TV-MA"]
SUB_TIERS = ["ads_basic", "ads_standard", "premium_no_ads"]
NO_ADS_TIER = "premium_no_ads"
DEVICES = ["smart_tv", "mobile", "tablet", "web", "game_console"]
AGE_BANDS = ["18_24", "25_34", "35_44", "45_54", "55_64", "65_plus"]
OBJECTIVES = ["awareness", "reach", "completion", "clicks"]
PACING_GOALS = ["even", "front_loaded", "back_loaded"]
CAMPAIGN_STATUSES = ["completed", "active", "scheduled"]
CAMPAIGN_PREFIXES = {
    "awareness": ["Brand Lift", "Awareness", "Brand Reach", "Brand Spotlight", "Intro"],
    "reach": ["Max Reach", "Broad Reach", "Audience Expansion", "Scale", "Discovery"],
    "completion": ["Full View", "Engagement", "Watch Complete", "Deep View", "Lean-In"],
    "clicks": ["Click Drive", "CTA Push", "Direct Response", "Performance", "Convert"],
}

# --- FIXED VALUES: ad slots in firing order --------------------------------
# (slot_position, typical_duration_sec, avg_completion_rate, avg_viewability,
#  position of the break as a fraction of the watched time)
AD_SLOTS = [
    ("pre_roll_1", 15, "0.92", "0.95", "0.00"),
    ("pre_roll_2", 30, "0.88", "0.93", "0.01"),
    ("mid_roll_1", 15, "0.80", "0.88", "0.30"),
    ("mid_roll_2", 30, "0.75", "0.85", "0.50"),
    ("mid_roll_3", 15, "0.70", "0.82", "0.70"),
    ("post_roll_1", 15, "0.55", "0.60", "0.98"),
]
SLOT_ORDER = [s[0] for s in AD_SLOTS]
MIN_WATCH_SECONDS = 30

# --- FIXED VALUES: pacing and concentration labels ---------------------------
PACING_STATUSES = ["ON_PACE", "UNDER_PACING", "OVER_PACING", "UNKNOWN"]
PACING_UNDER = "0.9"
PACING_OVER = "1.1"
CONCENTRATION_BANDS = ["DIVERSIFIED", "MODERATE", "CONCENTRATED"]
HHI_MODERATE = 1500
HHI_CONCENTRATED = 2500

# --- FIXED VALUES: display verdicts and threshold tables ---------------------
GOOD, WARN, BAD, UNKNOWN = "good", "warn", "bad", "unknown"
# (upper bound, verdict) pairs checked in order with a strict "<"; None = rest.
FILL_RATE_PCT = [(70.0, BAD), (80.0, WARN), (90.0, GOOD), (95.0, WARN), (None, WARN)]
ECPM_USD = [(8.0, BAD), (12.0, WARN), (25.0, GOOD), (None, GOOD)]
VIEWABILITY_PCT = [(60.0, BAD), (70.0, WARN), (None, GOOD)]
FREQUENCY_VIOLATION_PCT = [(2.0, GOOD), (5.0, WARN), (None, BAD)]
ADS_PER_HOUR = (6, 25)
RPSH_USD = [(0.15, BAD), (0.35, GOOD), (None, WARN)]
PACING_STATUS_VERDICT = {
    "ON_PACE": GOOD, "OVER_PACING": WARN, "UNDER_PACING": BAD, "UNKNOWN": UNKNOWN,
}
CONCENTRATION_VERDICT = {"DIVERSIFIED": GOOD, "MODERATE": WARN, "CONCENTRATED": BAD}

# --- FIXED VALUES: surrogate keys (public dbt_utils definition) --------------
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"

# Why a filled request has no campaign.
NO_CAMPAIGN_IN_FLIGHT = "no campaign in flight"
