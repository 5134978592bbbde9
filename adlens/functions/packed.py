"""Sets of ids and lookups by number, packed so that large ones can be broadcast.

A block of ids is one row with 16 longs: a bit for each of 1,000 ids that differ in
their last three digits, or a 16-bit code for each of 64 consecutive numbers. Both are
exact. They pay while ids lie dense, which is checked (``packs``, ``codes_of``); other
ids take the callers' shuffle joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions import joins as J

WORDS = 16
GAIN = 16              # ids a block must hold on average
CODED_VALUES = 10_000  # different values that may be looked up by code
_checked: dict[tuple, bool] = {}


def packed_text(c: str | Column) -> Column:
    """A text as a binary, one to one: the 32 digits of an md5 take 17 bytes."""
    c = F.col(c) if isinstance(c, str) else c
    md5 = (F.length(c) == 32) & (F.lower(F.hex(F.unhex(c))) == c)
    return F.when(md5, F.concat(F.unhex(c), F.lit(b"\x01"))).otherwise(
        F.concat(c.cast("binary"), F.lit(b"\x00")))


PACKED_SQL = ("CASE WHEN length({0}) = 32 AND lower(hex(unhex({0}))) = {0} THEN unhex({0}) || X'01' "
              "ELSE CAST({0} AS BINARY) || X'00' END")


def unpacked_text(c: str) -> Column:
    """The text of ``packed_text``."""
    return F.expr(f"CASE WHEN right(hex({c}), 2) = '01' THEN lower(left(hex({c}), 32)) "
                  f"ELSE CAST(left({c}, length({c}) - 1) AS STRING) END")


# -- sets of text ids ---------------------------------------------------------

def _digits(c: str) -> str:
    return f"right({c}, 3)"


def block_sql(c: str) -> str:
    """Block of a text id: its length and all but its last three characters."""
    return f"concat(length({c}), ':', left({c}, length({c}) - 3))"


def place_sql(c: str) -> str:
    """Place in the block: the last three characters as a number, null if not digits."""
    return (f"CASE WHEN {c} <> '' AND translate({_digits(c)}, '0123456789', '') = '' "
            f"THEN CAST({_digits(c)} AS INT) END")


def held_sql(bits: str, c: str) -> str:
    """True when the text ``c`` is in the block ``bits`` of its own block name."""
    place = place_sql(c)
    return (f"coalesce(shiftright(element_at({bits}, CAST({place} DIV 64 + 1 AS INT)), {place} % 64) & 1 = 1, "
            "false)")


def id_blocks(ids: DataFrame) -> DataFrame:
    """(block, bits) of a single column of text ids; nulls are left out."""
    c = f"`{ids.columns[0]}`"
    placed = ids.where(f"{c} IS NOT NULL").selectExpr(f"{block_sql(c)} AS block",
                                                      f"{place_sql(c)} AS place")
    words = [F.expr(f"coalesce(bit_or(CASE WHEN place DIV 64 = {j} THEN shiftleft(1L, place % 64) "
                    f"END), 0L)").alias(f"w{j}") for j in range(WORDS)]
    return placed.groupBy("block").agg(*words).select(
        "block", F.array(*[f"w{j}" for j in range(WORDS)]).alias("bits"))


def packs(ids: DataFrame) -> bool:
    """True when all ids end in digits and their blocks are few and well filled.
    Two aggregates at most, remembered as in ``is_small``."""
    if not isinstance(ids.schema[0].dataType, T.StringType):
        return False
    key = (ids.semanticHash(), tuple(sorted(ids.inputFiles())), "packs")
    if key not in _checked:
        c = f"`{ids.columns[0]}`"
        other = ids.where(f"{c} IS NOT NULL AND ({place_sql(c)}) IS NULL")
        ok = other.limit(1).isEmpty()
        if ok:
            got = id_blocks(ids).agg(F.count(F.lit(1)).alias("blocks"), F.expr(
                "sum(aggregate(bits, 0, (n, w) -> n + bit_count(w)))").alias("ids")).first()
            ok = (got["blocks"] <= J.DEFAULT_BROADCAST_ROWS
                  and (got["ids"] or 0) >= GAIN * got["blocks"])
        _checked[key] = ok
    return _checked[key]


def keep_held(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``column`` is among ``ids``; asks ``packs(ids)`` first."""
    blocks = F.broadcast(id_blocks(ids).toDF("_block", "_bits"))
    c = f"`{column}`"
    return df.join(blocks, F.expr(f"{block_sql(c)} = _block AND {held_sql('_bits', c)}"), "left_semi")


# -- keys by number ---------------------------------------------------------------

def key_numbers(dim: DataFrame, key: str) -> DataFrame | None:
    """(key, number) of the distinct keys of a dimension under the broadcast bound, else
    None. The numbers are given in one task, to so many rows at most."""
    keys = dim.where(F.col(key).isNotNull()).select(key)
    if not J.is_small(keys):
        return None
    return keys.distinct().withColumn("_number", F.row_number().over(Window.orderBy(key)))


def numbered_keys(df: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    """``df`` with numbers as its keys, the rows of other keys dropped."""
    return df if keys is None else df.join(F.broadcast(keys), key).drop(key).withColumnRenamed(
        "_number", key)


def named_keys(df: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    """The keys of ``numbered_keys`` again."""
    return df if keys is None else df.withColumnRenamed(key, "_number").join(
        F.broadcast(keys), "_number").drop("_number")


# -- values by number -----------------------------------------------------------

def codes_of(table: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """(blocks, values) of a lookup of ``columns`` by the integer ``key``: the code of
    each of 64 consecutive numbers, 16 bits each, and the values of the codes. None when
    numbers repeat, lie thin or the values are many."""
    if not isinstance(table.schema[key].dataType, (T.ShortType, T.IntegerType, T.LongType)):
        return None
    values = table.where(f"`{key}` IS NOT NULL").select(*columns).distinct()
    if not J.is_small(values, CODED_VALUES):
        return None
    values = values.withColumn("_code", F.row_number().over(Window.orderBy(*columns)).cast("long"))
    named = F.broadcast(values.toDF(*[f"_v{i}" for i in range(len(columns))], "_code"))
    same = F.lit(True)
    for i, c in enumerate(columns):
        same = same & F.col(c).eqNullSafe(F.col(f"_v{i}"))
    placed = table.where(f"`{key}` IS NOT NULL").join(named, same).select(
        F.expr(f"shiftright(CAST(`{key}` AS BIGINT), 6) AS _block"),
        F.expr(f"CAST(CAST(`{key}` AS BIGINT) & 63 AS INT) AS place"), "_code")
    words = [F.expr(f"coalesce(bit_or(CASE WHEN place DIV 4 = {j} THEN shiftleft(_code, place % 4 * 16)"
                    f" END), 0L)").alias(f"w{j}") for j in range(WORDS)]
    blocks = placed.groupBy("_block").agg(F.count(F.lit(1)).alias("n"), *words).select(
        "_block", "n", F.array(*[f"w{j}" for j in range(WORDS)]).alias("_codes"))
    memo = (table.semanticHash(), tuple(sorted(table.inputFiles())), key, tuple(columns))
    if memo not in _checked:
        # two rows of one number leave fewer filled places than rows
        filled = ("sum(aggregate(_codes, 0, (n, w) -> n + if(w & 65535 <> 0, 1, 0) + "
                  "if(shiftright(w, 16) & 65535 <> 0, 1, 0) + if(shiftright(w, 32) & 65535 <> 0, 1, 0)"
                  " + if(shiftright(w, 48) & 65535 <> 0, 1, 0)))")
        got = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("n"),
                         F.expr(filled).alias("filled")).first()
        _checked[memo] = (got["n"] == got["filled"] and got["blocks"] <= J.DEFAULT_BROADCAST_ROWS
                          and got["n"] >= GAIN * got["blocks"])
    return (blocks.drop("n"), values) if _checked[memo] else None


def look_up(df: DataFrame, number: str, table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``df`` inner-joined with ``columns`` of ``table`` where ``number`` equals ``key``.

    A small table is broadcast. Of a larger one, packed codes are sent if its numbers
    are dense and unique; else the join shuffles both sides.
    """
    table = table.select(key, *columns)
    small = J.is_small(table)
    packed = None if small else codes_of(table, key, columns)
    if packed is None:
        return df.join(F.broadcast(table) if small else table, F.col(number) == F.col(key))
    blocks, values = packed
    n = f"CAST(`{number}` AS BIGINT)"
    coded = df.join(F.broadcast(blocks), F.expr(f"shiftright({n}, 6) = _block")).withColumn(
        "_at", F.expr(f"shiftright(element_at(_codes, CAST(({n} & 63) DIV 4 + 1 AS INT)), "
                      f"CAST({n} & 3 AS INT) * 16) & 65535"))
    return coded.where("_at <> 0").join(F.broadcast(values), F.col("_at") == F.col("_code")).withColumn(
        key, F.col(number)).drop("_block", "_codes", "_at", "_code")
