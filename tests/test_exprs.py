"""Expression-level behaviour: exact rounding, keys, bands, verdicts, labels."""

import hashlib
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlens import constants as C
from adlens.functions.exprs import (
    band, date_key, format_metric, optional_number, round_ratio, surrogate_key,
    verdict_for_status,
)


def exact(n: int, d: int, scale: int) -> Decimal:
    q = (Decimal(n) / Decimal(d)) if d else None
    return None if q is None else (Decimal(abs(n)) / Decimal(abs(d))).quantize(
        Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP) * (-1 if (n < 0) != (d < 0) else 1)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(-10**9, 10**9)),
                min_size=1, max_size=40),
       st.integers(0, 4))
def test_round_ratio_matches_decimal_half_up(spark, pairs, scale):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", round_ratio("n", "d", scale, 38, signed=True).alias("r")).collect()
    for row in got:
        want = exact(row.n, row.d, scale)
        assert (row.r is None and want is None) or row.r == want, (row, want)


def test_round_ratio_ties_round_away_from_zero(spark):
    df = spark.createDataFrame([(1005, 1000), (-1005, 1000), (8995, 10000), (1, 0)], "n long, d long")
    r = [x.r for x in df.select(round_ratio("n", "d", 2, signed=True).alias("r")).collect()]
    assert r[:3] == [Decimal("1.01"), Decimal("-1.01"), Decimal("0.90")]
    assert r[3] is None


def test_surrogate_key_is_dbt_compatible(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    got = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert got[0] == hashlib.md5(b"a-b").hexdigest()
    assert got[1] == hashlib.md5(("a-" + C.SURROGATE_NULL).encode()).hexdigest()
    one = df.select(surrogate_key("x").alias("k")).first().k
    assert one == hashlib.md5(b"a").hexdigest()


def test_date_key(spark):
    df = spark.sql("select timestamp_ntz'2026-03-01 23:59:59' as ts")
    assert df.select(date_key("ts").alias("k")).first().k == 20260301


STEP = Decimal("0.0001")


def around_each_bound(table):
    """A step below each bound, the bound itself and a step above it."""
    cases = []
    for (upper, below), (_, above) in zip(table, table[1:]):
        bound = Decimal(str(upper))
        cases += [(bound - STEP, below), (bound, above), (bound + STEP, above)]
    return cases


BAND_CASES = [(table, around_each_bound(table)) for table in (
    C.FILL_RATE_PCT, C.ECPM_USD, C.VIEWABILITY_PCT, C.FREQUENCY_VIOLATION_PCT, C.RPSH_USD)]


@pytest.mark.parametrize("table,cases", BAND_CASES)
def test_band_boundaries_are_strict(spark, table, cases):
    rows = [(Decimal(str(v)),) for v, _ in cases] + [(None,)]
    df = spark.createDataFrame(rows, "v decimal(18,4)")
    got = [r.b for r in df.select(band("v", table).alias("b")).collect()]
    assert got == [e for _, e in cases] + ["unknown"]


def test_verdicts_unknown_for_null_and_unrecognised(spark):
    df = spark.createDataFrame([("ON_PACE",), ("OVER_PACING",), ("UNDER_PACING",), ("UNKNOWN",),
                                ("SOMETHING",), (None,)], "s string")
    got = [r.v for r in df.select(verdict_for_status("s", C.PACING_STATUS_VERDICT).alias("v")).collect()]
    assert got == ["good", "warn", "bad", "unknown", "unknown", "unknown"]


def test_optional_number_and_labels(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("abc",), (None,)], "s string")
    got = df.select(optional_number("s").alias("n"), format_metric("s", 1).alias("l")).collect()
    assert [r.n for r in got] == [1.5, None, None, None]
    assert [r.l for r in got] == ["1.5", "n/a", "n/a", "n/a"]


def test_labels_round_half_away_from_zero(spark):
    df = spark.createDataFrame([("0.25",), ("0.35",), ("-0.25",), ("1234.5",)], "s string")
    got = [r.l for r in df.select(format_metric("s", 1, grouped=True).alias("l")).collect()]
    assert got == ["0.3", "0.4", "-0.3", "1,234.5"]
