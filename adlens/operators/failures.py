"""The rows behind a failing check, as one table for all checks.

Each row is (model, check_name, column_name, row_key, value, n_rows):

* not_null, accepted_range, relationships: a row of the model that violates the
  check, named by the model's key, with the offending value;
* unique, unique_combination, accepted_values: a key or value that fails, with
  the number of rows that hold it; ``rows_of`` joins these back to the rows.

So the number of rows of a check equals its count in the quality report. A model
is read once for its row-level checks, whatever their number: every row carries
the list of checks it violates. The grouped checks of all models share one
shuffle, combined before it; a model that joins its tables anew whenever it is read
has its violations counted there too, so that it is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.joins import is_small_id_set as is_small
from adlens.functions.packed import block_sql, held_sql, id_blocks, packed_text, packs, unpacked_text
from adlens.operators.quality import AR, AV, CHECK_TYPES, CHECKS, FK, NN, UC, U

COLUMNS = ["model", "check_name", "column_name", "row_key", "value", "n_rows"]
# Key columns of the models that declare no unique key: none of a one-row model.
OTHER_KEYS = {"fct_campaign_daily": ["campaign_key", "date_key"],
              "mart_advertiser_concentration": []}
# Models whose every reading shuffles their tables for a join.
JOINED_ANEW = ("stg_ad_requests", "stg_ad_impressions")


def key_columns(model: str, spec: dict) -> list[str]:
    if model in OTHER_KEYS:
        return OTHER_KEYS[model]
    return spec[UC][0] if UC in spec else spec.get(U, [])[:1]


def joined(columns: list[str]) -> Column:
    """The columns' values as one text, nulls as empty."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def as_number(column: str) -> Column:
    return F.col(column).cast("decimal(38,6)").cast("string")


def _orphan_rows(model: str, spec: dict, column: str, df: DataFrame, parent: DataFrame) -> DataFrame:
    """The rows whose key is not in a large parent. Distinct keys alone meet the
    parent, texts packed; the orphans among them, kept since they are read twice, find
    their rows, without a shuffle of the rows while they are few."""
    texts = all(f.schema[0].dataType.simpleString() == "string" for f in (df.select(column), parent))
    short = packed_text if texts else F.col
    orphans = df.where(F.col(column).isNotNull()).select(
        short(column).alias("orphan")).distinct().join(
        parent.select(short("parent").alias("parent")), F.col("orphan") == F.col("parent"),
        "left_anti").cache()
    if is_small(orphans):
        orphans = F.broadcast(orphans)
    return df.withColumn("row_key", joined(key_columns(model, spec))).join(
        orphans, short(column) == F.col("orphan"), "left_semi").select(
        F.lit(model).alias("model"), F.lit(FK).alias("check_name"),
        F.lit(column).alias("column_name"), "row_key", F.col(column).cast("string").alias("value"),
        F.lit(1).cast("long").alias("n_rows"))


def _found(kind: str, column: str, cond: Column, row_key: Column, k: Column, value: Column):
    """(check_name, column_name, what a row holds for the check: null where ``cond`` is not true)."""
    return kind, column, F.when(cond, F.struct(
        row_key.alias("row_key"), k.alias("k"), value.alias("value")).cast(
        "struct<row_key: string, k: string, value: string>"))   # all may be null


def _none() -> Column:
    return F.lit(None).cast("string")


def _row_level(model: str, spec: dict, types, resolve, held) -> tuple[DataFrame, list, list]:
    """The model with the keys of its parents, what each row violates, and the orphans
    of parents too large to look up."""
    df, found, out = resolve(model), [], []
    row_key = joined(key_columns(model, spec))
    if NN in types:
        found += [_found(NN, c, F.col(c).isNull(), row_key, _none(), _none()) for c in spec.get(NN, [])]
    if AR in types:
        for c, (lo, hi) in spec.get(AR, {}).items():
            low = F.col(c) < lo if lo is not None else F.lit(False)
            high = F.col(c) > hi if hi is not None else F.lit(False)
            found.append(_found(AR, c, low | high, row_key, _none(), as_number(c)))
    if FK in types:
        for n, (c, (parent, parent_key)) in enumerate(spec.get(FK, {}).items()):
            how, ids = held(parent, parent_key)
            if how == "keys":
                keys = ids.select(F.col(parent_key).alias(f"parent_{n}")).distinct()
                df = df.join(F.broadcast(keys), F.col(c) == F.col(f"parent_{n}"), "left")
                lost = F.col(f"parent_{n}").isNull()
            elif how == "blocks":
                blocks = id_blocks(ids).toDF(f"block_{n}", f"bits_{n}")
                df = df.join(F.broadcast(blocks), F.expr(f"{block_sql(f'`{c}`')} = block_{n}"), "left")
                lost = ~F.expr(held_sql(f"bits_{n}", f"`{c}`"))
            else:
                out.append(_orphan_rows(model, spec, c, resolve(model), ids.select(
                    F.col(parent_key).alias("parent"))))
                continue
            found.append(_found(FK, c, F.col(c).isNotNull() & lost, row_key, _none(),
                                F.col(c).cast("string")))
    return df, found, out


def _grouped(spec: dict, types) -> list:
    """The keys each row holds for the grouped checks; a null value is the key's own text."""
    held = []

    def key(kind: str, column: str, k: Column, value: Column):
        return _found(kind, column, k.isNotNull(), _none(), k, value)

    if U in types:
        held += [key(U, c, F.col(c).cast("string"), _none()) for c in spec.get(U, [])]
    if UC in types:  # the JSON is injective, the text is for reading
        held += [key(UC, ",".join(cols), F.to_json(F.struct(*cols)), joined(cols))
                 for cols in spec.get(UC, [])]
    if AV in types:
        for c, values in spec.get(AV, {}).items():
            other = F.when(~F.col(c).isin(values), F.col(c).cast("string"))
            held.append(key(AV, c, other, _none()))
    return held


def _holding(df: DataFrame, model: str, found: list, checks: list) -> DataFrame:
    """(check, row_key, k, value): a row for each that is not null. The model, check and
    column are appended to ``checks``, whose index ``check`` is."""
    pairs = []
    for kind, column, x in found:
        pairs += [F.lit(len(checks)), x]
        checks.append((model, kind, column))
    return df.select(F.stack(F.lit(len(found)), *pairs).alias("check", "x")).where(
        "x IS NOT NULL").select("check", "x.*")


def _named(df: DataFrame, checks: list) -> DataFrame:
    """``df`` with the model, check and column of each number."""
    names = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(COLUMNS, c)]) for c in checks])
    return df.withColumn("_of", F.element_at(names, F.col("check") + 1)).select("*", "_of.*")


def _repeated(counted: DataFrame) -> DataFrame:
    """Each row as often as ``times`` says, in two steps, so no long array is made."""
    some = counted.withColumn("_part", F.explode(F.expr("sequence(0L, (times - 1) DIV 1000)")))
    return some.withColumn("_nth", F.explode(F.expr("sequence(1L, least(1000L, times - _part * 1000))")))


def failing_rows(resolve, models=None, types=tuple(CHECK_TYPES), checks=None) -> DataFrame:
    """The failing rows of all checks of ``types`` over ``models`` (see above).

    ``resolve(name)`` gives a model; hand in materialised ones at scale. Repeated
    rows are listed as often as they occur. No failure gives no rows.

    ``JOINED_ANEW`` models are read once: their violations take the grouped checks'
    shuffle, which counts equal ones. Other models are cheap to read, so theirs are
    listed by a pass of its own, without a shuffle.
    """
    checks = CHECKS if checks is None else checks
    parents: dict[tuple[str, str], tuple[str, DataFrame]] = {}

    def held(name: str, key: str) -> tuple[str, DataFrame]:
        if (name, key) not in parents:
            ids = resolve(name).select(key)
            parents[name, key] = ("keys" if is_small(ids) else "blocks" if packs(ids) else "large", ids)
        return parents[name, key]

    parts, groups, grouped_checks = [], [], []
    for model in models or list(checks):
        df, found, orphans = _row_level(model, checks[model], types, resolve, held)
        parts += orphans
        grouped = _grouped(checks[model], types)
        if model in JOINED_ANEW:
            grouped, found = grouped + found, []
        if found:
            listing = []
            parts.append(_named(_holding(df, model, found, listing), listing).withColumn(
                "n_rows", F.lit(1).cast("long")).select(*COLUMNS))
        if grouped:
            groups.append(_holding(df if model in JOINED_ANEW else resolve(model), model, grouped,
                                   grouped_checks))
    if groups:
        every = groups[0]
        for g in groups[1:]:
            every = every.unionByName(g)
        # the key decides the value: as a grouping key it leaves an aggregate by hash,
        # where the least of texts would sort every row
        counted = _named(every.withColumn("k", packed_text("k")).groupBy(*every.columns).agg(
            F.count(F.lit(1)).alias("n_rows")), grouped_checks).withColumn(
            "value", F.coalesce("value", unpacked_text("k")))
        is_grouped = F.col("check_name").isin(U, UC, AV)
        times = F.when(~is_grouped, F.col("n_rows")).when(
            (F.col("check_name") == AV) | (F.col("n_rows") > 1), 1).otherwise(0)
        parts.append(_repeated(counted.withColumn("times", times).where("times > 0")).withColumn(
            "n_rows", F.when(is_grouped, F.col("n_rows")).otherwise(1)).select(*COLUMNS))
    if not parts:
        raise ValueError("no checks selected")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*COLUMNS)


def rows_of(df: DataFrame, failing: DataFrame, model: str, check_name: str, column_name: str,
            checks=None) -> DataFrame:
    """The rows of a model behind one check, all columns: a semi-join on the row
    key, or on the bad keys of a grouped check."""
    checks = CHECKS if checks is None else checks
    grouped = check_name in (U, UC, AV)
    own = joined(column_name.split(",")) if grouped else joined(key_columns(model, checks[model]))
    bad = failing.where((F.col("model") == model) & (F.col("check_name") == check_name)
                        & (F.col("column_name") == column_name)).select(
        F.col("value" if grouped else "row_key").alias("failing_key")).distinct()
    return df.join(bad, own == F.col("failing_key"), "left_semi")


def failing_reconciliations(reconciled: dict[str, DataFrame]) -> DataFrame:
    """(name, row): the rows that did not pass, as JSON, of each reconciliation."""
    parts = [df.where(~F.coalesce(F.col("passed"), F.lit(False))).select(
        F.lit(name).alias("name"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}
                                             ).alias("row"))
             for name, df in reconciled.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
