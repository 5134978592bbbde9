"""Raw-table ingest and sinks: typed CSV load, missing-input guard, row
counts, and table/CSV writes with full overwrite.

CSV follows one dialect both ways: values are quoted where they hold commas,
quotes or line breaks, quotes are doubled, and null is an unquoted empty value.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.sources.csv_records import DIALECT, read_csv_records
from adlens.sources.schemas import PRIMARY_KEYS, RAW_LENGTHS, RAW_SCHEMAS, RAW_TABLES


def read_csv_typed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Lazy typed CSV scan (S1): header skipped, columns bound by POSITION to the
    declared schema. A value that does not parse fails the reads that use its
    column; ``load_table`` is the load that holds for every column."""
    return read_csv_records(spark, path, RAW_SCHEMAS[table])


def missing_inputs(paths: dict[str, str]) -> list[str]:
    """Tables whose input path does not exist (S3), by the path's own file system."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return [t for t, p in paths.items() if not os.path.exists(p)]
    conf = spark._jsc.hadoopConfiguration()

    def exists(p: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(conf).exists(path)

    return [t for t, p in paths.items() if not exists(p)]


def within_length(column: str, length: int) -> F.Column:
    """The value, without the blanks that go past its declared length."""
    c = F.col(column)
    return F.when((F.length(c) > length) & (F.length(F.rtrim(c)) <= length),
                  F.left(c, F.lit(length))).otherwise(c)


def load_table(spark: SparkSession, path: str, table: str,
               lengths: dict[str, int] | None = None) -> DataFrame:
    """Checked load of one raw table.

    Every column of every row is parsed once and written as a typed parquet
    table in the shared folder. A value that does not parse, a number beyond its
    declared precision, a text longer than its column (blanks past the end are cut
    off), a blank value (all raw columns are required) or a repeated primary key
    fails the load. Only the written table is handed out, so no later projection
    can skip the checks. ``lengths``: of the columns, in place of the declared ones.
    """
    from adlens.session import scratch_path
    out = scratch_path(spark, f"load_{table}")
    limits = RAW_LENGTHS[table] if lengths is None else lengths
    df = read_csv_typed(spark, path, table)
    df.select(*[within_length(c, limits[c]).alias(c) if c in limits else F.col(c)
                for c in df.columns]).write.mode("overwrite").parquet(out)
    loaded = spark.read.parquet(out)
    found = loaded.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}: # blank") for c in loaded.columns],
        *[F.count_if(F.length(c) > n).alias(f"{c}: # longer than {n}")
          for c, n in limits.items()]).first()
    key = PRIMARY_KEYS[table]
    repeated = loaded.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").count()
    faults = [fault.replace("#", str(n)) for fault, n in found.asDict().items() if n]
    if repeated:
        faults.append(f"{key}: {repeated} repeated keys")
    if faults:
        raise ValueError(f"load of {table} failed ({'; '.join(faults)})")
    return loaded


def read_raw_csv(spark: SparkSession, directory: str, tables=RAW_TABLES) -> dict[str, DataFrame]:
    """All raw tables from ``<directory>/<table>.csv``, each by a checked load.

    Every path is checked before anything is read, and a missing one raises
    before any downstream write can happen.
    """
    paths = {t: os.path.join(directory, f"{t}.csv") for t in tables}
    missing = missing_inputs(paths)
    if missing:
        raise FileNotFoundError(f"missing raw inputs: {', '.join(sorted(missing))}")
    return {t: load_table(spark, p, t) for t, p in paths.items()}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with a header row, full overwrite (S8); null is an unquoted empty
    value, so any text comes back as it was."""
    df.write.mode("overwrite").options(**DIALECT).option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None,
                cluster_by: str | None = None) -> None:
    """Parquet table sink, full rebuild.

    ``partition_by`` only for large partitions (e.g. day files of a big fact);
    otherwise ``cluster_by`` sorts rows within files so min/max statistics
    prune row groups.
    """
    w = df
    if cluster_by:
        w = w.sortWithinPartitions(cluster_by)
    writer = w.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table (S4): one count job per table,
    unioned into one result."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
