"""CSV records with quoted line breaks, read in parallel splits of a file.

A line break inside quotes does not end a record, so whether a line begins one
depends on all quotes before it in its file: it does if their number is even.
Each split counts its own; the parity at its start is a prefix over the splits'
counts, one row each. With that every split frames its records on its own. A
record that crosses into later splits leaves one fragment in each, and only
those fragments are shuffled, to be put together. A file without quoted line
breaks needs none of this and goes to Spark's own line-by-line parser.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.joins import is_small

# Quotes are doubled inside quotes; blanks belong to the value; an unquoted empty
# value is null and a quoted one is the empty text.
DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
           "ignoreTrailingWhiteSpace": "false"}
# What the parser puts for a quoted empty value, to tell it from null.
EMPTY = "\x00quoted empty\x00"
READ = {**DIALECT, "emptyValue": EMPTY, "mode": "FAILFAST"}
FRAME = "f string, b long, seq int, starts boolean, ends boolean, body string"


def raw_lines(spark: SparkSession, path) -> DataFrame:
    """(value, f, b): the lines of each split (file and first byte), in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"))


def _quotes(value: str) -> F.Column:
    return F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))


def split_starts(lines: DataFrame) -> DataFrame:
    """(f, b, inside): whether a split begins within quotes."""
    odd = lines.groupBy("f", "b").agg((F.sum(_quotes("value")) % 2).alias("odd"))
    before = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    return odd.select("f", "b", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias(
        "inside"))


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments of the splits, from their lines in order."""
    schema = pa.schema([("f", pa.string()), ("b", pa.int64()), ("seq", pa.int32()),
                        ("starts", pa.bool_()), ("ends", pa.bool_()), ("body", pa.string())])
    split, seq, starts, inside = None, 0, True, False
    body: list[str] = []
    out: list[tuple] = []
    for batch in batches:
        for value, f, b, opened in zip(*(batch.column(c).to_pylist()
                                         for c in ("value", "f", "b", "inside"))):
            if (f, b) != split:
                if body:  # the last split's open record
                    out.append((*split, seq, starts, False, "\n".join(body)))
                split, seq, starts, inside, body = (f, b), 0, not opened, opened, []
            body.append(value)
            inside ^= value.count('"') % 2 == 1
            if not inside:
                out.append((f, b, seq, starts, True, "\n".join(body)))
                seq, starts, body = seq + 1, True, []
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
            out = []
    if body:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t.type) for v, t in zip((*split, seq, starts, False, "\n".join(body)),
                                                   schema)], schema=schema)


def records(lines: DataFrame) -> DataFrame:
    """(f, first, body): every record, whole; ``first`` marks that of each file.

    A file that ends within quotes fails the job. Lines end in line feeds; a
    carriage return before the one that ends a record belongs to it.
    """
    starts = split_starts(lines)
    if is_small(starts):
        marked = lines.join(F.broadcast(starts), ["f", "b"])  # lines stay where and as they are
    else:
        marked = lines.withColumn("nth", F.monotonically_increasing_id()).join(
            starts, ["f", "b"]).repartition("f", "b").sortWithinPartitions("f", "b", "nth")
    frames = marked.select("value", "f", "b", "inside").mapInArrow(_frames, FRAME)
    whole = frames.where("starts AND ends").select(
        "f", ((F.col("b") == 0) & (F.col("seq") == 0)).alias("first"), "body")
    cut = frames.where("NOT (starts AND ends)")
    # a fragment belongs to the last one before it that starts a record
    begun = Window.partitionBy("f").orderBy("b", "seq").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    owned = cut.withColumn("at", F.last(F.when(F.col("starts"), F.struct("b", "seq")),
                                        ignorenulls=True).over(begun))
    whole_again = owned.groupBy("f", "at").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", "seq", "body"))),
                                 lambda x: x["body"]), "\n").alias("body"),
        F.bool_or("ends").alias("ends")).select(
        "f", ((F.col("at.b") == 0) & (F.col("at.seq") == 0)).alias("first"),
        F.when(F.col("ends"), F.col("body")).otherwise(F.raise_error(F.concat(
            F.lit("file ends within quotes: "), F.col("f")))).alias("body"))
    return whole.unionAll(whole_again).withColumn(
        "body", F.regexp_replace("body", r"\r\z", ""))


def has_line_breaks(lines: DataFrame) -> bool:
    """Whether any value may hold a line break: a line with an odd number of
    quotes, or a carriage return that does not end its line."""
    odd, inner = lines.agg(
        F.bool_or(_quotes("value") % 2 == 1),
        F.bool_or(F.col("value").rlike(r"\r(?!\z)"))).first()
    return bool(odd or inner)


def read_csv_records(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """CSV files with a header each, columns bound by position to ``schema``.

    Values may hold commas, doubled quotes and line breaks inside quotes. A value
    that does not parse, or a record of too few or too many values, fails the
    reads that use it. Empty lines are no records. No rows: no records.
    """
    lines = raw_lines(spark, path)
    if not has_line_breaks(lines):
        return _with_empties(spark.read.schema(schema).options(**READ).option(
            "header", True).option("enforceSchema", True).csv(path))
    found = records(lines).where("NOT first AND body <> ''")
    parsed = F.from_csv("body", ", ".join(
        f"`{c.name}` {c.dataType.simpleString()}" for c in schema), READ)
    return _with_empties(found.select(parsed.alias("r")).select("r.*"))


def _with_empties(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.when(F.col(f"`{c.name}`") == EMPTY, "").otherwise(F.col(f"`{c.name}`")).alias(c.name)
        if isinstance(c.dataType, T.StringType) else F.col(f"`{c.name}`") for c in df.schema])
