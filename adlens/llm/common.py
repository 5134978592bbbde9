"""Shared helpers: text columns as byte buffers, intermediate tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.session import ensure_checkpoint_dir, scratch_path

# Text bytes handled at once inside a task: bounds the working arrays whatever
# the Arrow batch size, and keeps them in the cache. One longer text is one slice.
SLICE_BYTES = 1 << 19
# Settings while an intermediate table is written: its shuffle files are deleted
# as soon as it stands, and Python workers get few rows at a time.
WRITE_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and reread it.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with settings(spark, WRITE_CONF):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Shared:
    """A value of bounded size for all tasks, sent once to each executor.

    Travels as bytes that hold its class by value too, so an executor needs no
    copy of this package; unpacked once a task.
    """

    def __init__(self, spark: SparkSession, value):
        self.box = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self.value = None

    def __getstate__(self):
        return {"box": self.box, "value": None}

    def get(self):
        if self.value is None:
            self.value = pickle.loads(self.box.value)
        return self.value

    def destroy(self) -> None:
        self.box.destroy()


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings that hold within the block only."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def drop(df: DataFrame) -> None:
    """Delete an intermediate table made by ``save`` that nothing reads any more."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if "/adlens-tables/" in folder and base.split("://")[-1].split(":")[-1] in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def in_order(df: DataFrame, order: list[Column], group: str | None = None) -> DataFrame:
    """The rows with ``place``: gapless numbers from 0 in ``order``, within each
    value of ``group`` (never null) if given. A new table, as by ``save``.

    One range exchange. A row's number is its place in its range, after the rows
    of the ranges before it, of which there are as many as shuffle partitions; no
    group is ever in one task. ``order`` should be total, then equal keys split
    too. ``df`` is read twice: give a written table.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [group] if group else []
    keys = [F.col(c).asc() for c in by] + order
    ranged = save(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn(
        "at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)),
        "in_order")
    counts = ranged.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("rows"),
                                             F.min("at").alias("first_at"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(*by, "part", (F.coalesce(F.sum("rows").over(before), F.lit(0))
                                         - F.col("first_at")).alias("shift"))
    return ranged.join(starts, [*by, "part"]).withColumn(
        "place", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``limit`` bytes of text
    (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(byte_lengths(batch.column(column)))
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def byte_lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes end to end, and the n + 1 offsets (null: empty)."""
    lengths = byte_lengths(texts)
    joined = b"".join(x for x in texts.cast(pa.binary()).to_pylist() if x)
    return (np.frombuffer(joined, np.uint8),
            np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)]))


def map_texts(df: DataFrame, text_col: str, keep: list[str], out: str,
              fn: Callable[[pa.RecordBatch], dict[str, pa.Array]],
              limit: int = SLICE_BYTES) -> DataFrame:
    """One output row per input row: ``keep`` as it is, plus the columns that
    ``fn`` derives from a slice of rows (``out``: their DDL).

    Works on whole texts, a bounded slice of rows at a time. The kept columns
    are renamed internally, so extra or clashing input columns do no harm.
    """
    from pyspark.sql import types as T

    cols = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    inner = df.select(*cols, F.col(text_col).cast("string").alias("body"))
    extra = T._parse_datatype_string(out)
    schema = T.StructType([*inner.schema.fields[:len(keep)], *extra.fields])

    def run(batches):
        for part in slices(batches, "body", limit):
            made = fn(part)
            arrays = [part.column(i) for i in range(len(keep))] + [made[f.name] for f in extra]
            yield pa.RecordBatch.from_arrays(
                arrays, names=[f"keep_{i}" for i in range(len(keep))] + [f.name for f in extra])

    got = inner.mapInArrow(run, schema)
    return got.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)],
                      *[F.col(f.name) for f in extra])


def packed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, body): all columns as one struct, so that no name of theirs can
    clash with one of an operator, and the text. ``select("row.*")`` undoes it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(text_col).cast("string").alias("body"))


SPAN = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                 ("end", pa.int32()), ("value", pa.string()),
                                 ("score", pa.float64())]))


def span_string(spans, kinds: list[str] | None = None):
    """``kind:start:end`` of each span, comma-joined; only of ``kinds`` if given."""
    col = F.col(spans) if isinstance(spans, str) else spans
    if kinds is not None:
        col = F.filter(col, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(col, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_count(spans: str, kind: str):
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")
