"""All-or-nothing publishing of tables.

Every run writes its tables into folders of their own, and readers find them only
through the manifest. That gains one file for a run, written last in a folder of
its own: until that file stands, and if a run dies before, all tables are still
those of the last whole run. Facts are laid out by day: a folder a day, a busy day in several files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.sources.raw import missing_inputs

MANIFEST = "version long, run string, name string, path string, columns array<string>"
SALTS = 1 << 16
DAY = "date_key"


def write_by_day(df: DataFrame, path: str, key: str, day: str = DAY) -> None:
    """Write ``df`` in a folder for each day.

    Rows are dealt to ranges of (day, hash of key): a quiet day is in one range or
    two, so it makes one file or two; a day of very many rows spans ranges, so no
    task writes it alone. A day filter opens the files of that day only.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(key), F.lit(SALTS))
    df.repartitionByRange(parts, F.col(day), salt).sortWithinPartitions(day).write.partitionBy(
        day).parquet(path)


def write_whole(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def manifest(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The tables of all published runs, or None where nothing is published."""
    path = f"{out_dir}/manifest"
    if missing_inputs({"manifest": path}):
        return None
    return spark.read.schema(MANIFEST).json(f"{path}/*")


def latest(spark: SparkSession, out_dir: str) -> list:
    """The manifest's rows of the last whole run; one row a table."""
    rows = manifest(spark, out_dir)
    if rows is None:
        return []
    last = rows.agg(F.max(F.struct("version", "run")).alias("m")).first()["m"]
    if last is None:
        return []
    return rows.where((F.col("version") == last["version"]) & (F.col("run") == last["run"])
                      ).collect()


def publish(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str,
            by_day: dict[str, str] | None = None) -> int:
    """Publish ``tables`` together; returns the new version.

    ``by_day`` names the tables laid out by day, each with its key column. Earlier
    versions stay readable until their folders are removed. Of two runs at once
    both are whole, and readers see the one that sorts last.
    """
    by_day = by_day or {}
    run = uuid.uuid4().hex
    version = max((r["version"] for r in latest(spark, out_dir)), default=0) + 1
    rows = []
    for name, df in tables.items():
        path = f"data/{name}/{version:06d}-{run}"
        if name in by_day:
            write_by_day(df, f"{out_dir}/{path}", by_day[name])
        else:
            write_whole(df, f"{out_dir}/{path}")
        rows.append((version, run, name, path, df.columns))
    # one file, so that its rename is the commit
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(
        f"{out_dir}/manifest/{version:06d}-{run}")
    return version


def published(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The tables of the last whole run, by name; none before the first."""
    return {r["name"]: spark.read.parquet(f"{out_dir}/{r['path']}").select(*r["columns"])
            for r in latest(spark, out_dir)}
