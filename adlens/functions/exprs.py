"""Column expressions shared by every job.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens import constants as C

MICROS = 1_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the '-'-joined text of the columns, nulls spelled out (dbt_utils)."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(C.SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(C.SURROGATE_SEP, *parts))


def date_key(ts: str | Column) -> Column:
    """yyyymmdd as an integer; arithmetic rather than string formatting."""
    t = col(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def pick(values: Sequence[str], index: Column) -> Column:
    """values[index] for a 0-based integer column (null when out of range)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """mapping[key], null for an unknown or null key."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), key)


def micros(amount: str | Column) -> Column:
    """A decimal money amount as an exact integral decimal(38,0) of micro-units."""
    return (col(amount).cast("decimal(38,6)") * F.lit(MICROS)).cast("decimal(38,0)")


def round_ratio(num: str | Column, den: str | Column, scale: int,
                precision: int = 18, signed: bool = False) -> Column:
    """round(num / den, scale), half away from zero, computed exactly.

    ``num`` and ``den`` must be integral (integers or scale-0 decimals). The
    quotient is formed in integer arithmetic, (2n*10^s + d) div 2d, so there is
    no intermediate decimal rounding (a decimal division would be cut to scale
    6 and rounded twice). Null when ``den`` is 0 or null. With ``signed`` the
    operands may be negative; the magnitude is rounded and the sign restored.
    """
    n = col(num).cast("decimal(38,0)")
    d = col(den).cast("decimal(38,0)")
    if signed:
        an, ad = F.abs(n), F.abs(d)
    else:
        an, ad = n, d
    q = F.call_function("div", an * F.lit(2 * 10 ** scale) + ad, ad * F.lit(2))
    if signed:
        q = q * F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    out = q.cast(f"decimal({precision},0)")
    if scale > 0:
        out = out * F.lit(Decimal(1).scaleb(-scale))
    return F.when(d != 0, out.cast(f"decimal({precision},{scale})"))


def round_decimal(x: str | Column, scale: int, precision: int = 18) -> Column:
    """round() of a decimal (HALF_UP), cast to a fixed result type."""
    return F.round(col(x), scale).cast(f"decimal({precision},{scale})")


def band(value: str | Column, thresholds) -> Column:
    """Ordered (upper, verdict) table with strict '<'; null -> unknown."""
    v = col(value)
    expr = F.when(v.isNull(), F.lit(C.UNKNOWN))
    for upper, verdict in thresholds:
        if upper is None:
            return expr.otherwise(F.lit(verdict))
        expr = expr.when(v < F.lit(upper), F.lit(verdict))
    return expr.otherwise(F.lit(C.UNKNOWN))


def verdict_for_status(status: str | Column, mapping: dict[str, str]) -> Column:
    """Warehouse label -> verdict; unknown or null label -> 'unknown'."""
    return F.coalesce(lookup(mapping, col(status)), F.lit(C.UNKNOWN))


def optional_number(value: str | Column) -> Column:
    """null / NaN / unparseable -> null, otherwise a double."""
    v = col(value).cast("string").try_cast("double")
    return F.when(~F.isnan(v), v)


def format_metric(value: str | Column, decimals: int = 1, fallback: str = "n/a",
                  prefix: str = "", suffix: str = "", grouped: bool = False) -> Column:
    """Fixed-point text for a metric; a missing value is text, never 0.

    The one rounding rule is half away from zero on the decimal digits, as
    everywhere else in the library. ``grouped`` separates thousands by commas.
    """
    v = optional_number(value)
    text = F.format_string(f"%{',' if grouped else ''}.{decimals}f", v)
    return F.when(v.isNull(), F.lit(fallback)).otherwise(
        F.concat(F.lit(prefix), text, F.lit(suffix)))
