"""Join helpers: size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.exprs import surrogate_key

# Largest dimension shipped to every task as a broadcast: at most this many
# rows and this many bytes of column data. Beyond either bound the join stays
# a shuffle join and AQE re-plans it from runtime sizes.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# A set of ids alone, which only decides which rows stay: one short column, so
# more rows of it cost a task no more memory than a wide dimension.
ID_SET_ROWS = 2_000_000

_checked: dict[tuple, bool] = {}


def _row_bytes(df: DataFrame) -> F.Column:
    """Bytes of one row: actual length of strings and binaries, the type's
    width for everything else."""
    parts = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("long"))
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0)).cast("long"))
        else:
            parts.append(F.lit(int(getattr(t, "defaultSize", lambda: 8)())).cast("long"))
    out = F.lit(0).cast("long")
    for p in parts:
        out = out + p
    return out


def is_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
             max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    Reads at most ``max_rows + 1`` rows (the limit stops the scan early) in one
    aggregate, and remembers the answer per logical plan and list of input
    files, so a dimension is checked once per session and a path that grew is
    checked again.
    """
    key = (df.semanticHash(), tuple(sorted(df.inputFiles())), max_rows, max_bytes)
    if key not in _checked:
        probe = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"),
                                           F.sum(_row_bytes(df)).alias("b")).first()
        _checked[key] = probe["n"] <= max_rows and (probe["b"] or 0) <= max_bytes
    return _checked[key]


def is_small_id_set(ids: DataFrame) -> bool:
    """True when the single column ``ids`` is within ``ID_SET_ROWS`` and the byte
    bound. One aggregate over that column, remembered as in ``is_small``; a
    limit of so many rows would gather them in one task."""
    key = (ids.semanticHash(), tuple(sorted(ids.inputFiles())), "ids", ID_SET_ROWS)
    if key not in _checked:
        probe = ids.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(ids)).alias("b")).first()
        _checked[key] = probe["n"] <= ID_SET_ROWS and (probe["b"] or 0) <= DEFAULT_BROADCAST_BYTES
    return _checked[key]


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a checked row and byte bound; otherwise a
    shuffle join."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


_plain: dict[tuple, bool] = {}


def has_plain_keys(dim: DataFrame, key: str, natural: str) -> bool:
    """True when every natural id of ``dim`` (nulls aside) is on one row and its
    key is the id's surrogate. One aggregate over the two columns; the answer is
    remembered as in ``is_small``."""
    memo = (dim.semanticHash(), tuple(sorted(dim.inputFiles())), key, natural)
    if memo not in _plain:
        other = ~F.col(key).eqNullSafe(surrogate_key(natural))
        found = dim.where(F.col(natural).isNotNull()).groupBy(natural).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(other).alias("other"))
        _plain[memo] = found.where("n > 1 OR other > 0").isEmpty()
    return _plain[memo]


def attach_key(df: DataFrame, dim: DataFrame, key: str, natural: str) -> DataFrame:
    """``df`` inner-joined with the key of ``dim`` on the natural id.

    Under the broadcast bound the key is looked up. A larger dimension with plain
    keys (checked) only decides which rows stay and the key is computed: a left
    semi join with the ids, broadcast while they are under the bounds of an id
    set or can be packed, so the rows of ``df`` are not shuffled; beyond it a shuffle join.
    Repeated ids or other keys join by shuffle.
    """
    if is_small(dim):
        return df.join(F.broadcast(dim).select(key, natural), natural)
    if has_plain_keys(dim, key, natural):
        from adlens.functions import packed
        ids = dim.select(natural)
        small = is_small_id_set(ids)
        if not small and packed.packs(ids):
            kept = packed.keep_held(df, natural, ids)
        else:
            kept = df.join(F.broadcast(ids) if small else ids, natural, "left_semi")
        return kept.withColumn(key, surrogate_key(natural))
    return df.join(dim.select(key, natural), natural)


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach the columns of the one-row aggregate ``totals`` to every row of ``df``.

    ``totals`` runs once as a scalar subquery and its values are inlined into
    the projection, so there is no join (and no nested-loop plan) at all. The
    columns of ``totals`` travel as one struct referenced once, so the
    subquery runs once.
    """
    packed = totals.select(F.struct(*totals.columns).alias("t")).scalar()
    return df.select("*", packed.alias("_totals")).select(*df.columns, "_totals.*")


def literal_table(spark, rows, fields: list[tuple[str, str]]) -> DataFrame:
    """A small constant table built JVM-side (inline of literal structs), so no
    Python worker is involved; ``fields`` are (name, Spark SQL type)."""
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan over the cluster when it has fewer splits than cores.

    A large table stored as a few unsplittable files (one row group each)
    would otherwise run every downstream map-side operator in a handful of
    tasks. A scan of many files already has enough splits and is left as is,
    so at scale this adds no shuffle.
    """
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    # split count of the planned scan (metadata only: nothing is computed here)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def conform(df: DataFrame, schema) -> DataFrame:
    """Select and cast columns into the declared order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
