"""Running totals and numbering of large groups, spread over tasks.

A window without a partition, or with one hot partition, runs in one task. Here
each group's rows are cut into blocks, ranges of the order key between splitters;
blocks are summed (one row a group and block), the sums become each block's
offset, and the rows are added up within their block only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = 256         # ranges of the order key: a group is spread over so many tasks
SAMPLE_A_BLOCK = 32  # keys sampled for each splitter


def splitters(df: DataFrame, order: str, blocks: int = BLOCKS) -> Column:
    """At most ``blocks - 1`` ascending values of ``order`` that cut ``df`` into
    ranges of about equal rows, as one array.

    The sample is the distinct keys of least hash, at most 32 a block, so a task
    that runs again finds the same ones. Its rows are reduced to that many
    in each task (a top-k), and the array, of bounded length, is a scalar
    subquery: nothing passes through the driver's Python. Null keys are left out.
    """
    keys = df.select(F.col(order).alias("k")).filter("k IS NOT NULL").distinct()
    sample = keys.orderBy(F.xxhash64("k"), "k").limit(blocks * SAMPLE_A_BLOCK)
    ranked = sample.agg(F.array_sort(F.collect_list("k")).alias("ks"))
    at = F.sequence(F.lit(1), F.lit(blocks - 1))
    n = F.size("ks")
    # an empty sample has no splitters; a small one repeats some, which leaves blocks empty
    return ranked.select(F.when(n > 0, F.array_distinct(F.transform(
        at, lambda i: F.element_at("ks", (F.floor(i * n / blocks) + 1).cast("int")))))
        .otherwise(F.col("ks")).alias("cuts")).scalar()


def running_total(df: DataFrame, group: list[str], order: str, value: str,
                  before: str = "before", total: str = "total",
                  blocks: int = BLOCKS) -> DataFrame:
    """``df`` with, for each row, the sum of ``value`` over the rows of its group
    that come earlier by ``order`` (``before``) and over the whole group (``total``).

    ``order`` must be unique within a group; rows with equal keys would take
    turns in an undefined order. A null key comes first; null values add
    nothing; rows with a null in ``group`` make a group of their own. Sums are
    of the type of ``sum(value)``. An empty table gives an empty table.

    ``df`` is read twice (sums, rows) besides the sample, so it should be cheap
    or written. Rows are shuffled once, by group and block; a block of the
    largest group holds about a ``blocks``-th of the distinct keys. Column names
    that begin with an underscore are used inside.
    """
    cut = df.withColumn("_cuts", splitters(df, order, blocks))
    key = F.col(order)
    # the key's place among the splitters; null keys fall into block 0
    place = F.array_position(F.sort_array(F.array_append("_cuts", key)), key)
    cut = cut.withColumn("_block", F.coalesce(place, F.lit(0))).drop("_cuts")
    sums = cut.groupBy(*group, "_block").agg(F.sum(value).alias("_sum"))
    of_sum = sums.schema["_sum"].dataType
    # at most ``blocks`` rows a group from here on
    of_group = Window.partitionBy(*group)
    earlier = of_group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.select(
        *group, "_block", F.lit(False).alias("_row"),
        F.coalesce(F.sum("_sum").over(earlier).cast(of_sum), F.lit(0).cast(of_sum)).alias("_add"),
        F.sum("_sum").over(of_group).cast(of_sum).alias("_total"))
    # a block's head comes first in it and brings the offset: no join
    rows = cut.withColumns({"_row": F.lit(True), "_add": F.col(value).cast(of_sum)})
    within = (Window.partitionBy(*group, "_block").orderBy("_row", order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.unionByName(heads, allowMissingColumns=True)
            .withColumns({"_before": F.sum("_add").over(within).cast(of_sum),
                          "_of_group": F.first("_total").over(within)})
            .filter("_row")
            .select(*df.columns, F.col("_before").alias(before), F.col("_of_group").alias(total)))


def numbered(df: DataFrame, key: str, number: str = "number", blocks: int = BLOCKS) -> DataFrame:
    """``df`` with its rows numbered 0, 1, 2... by ``key``, without gaps.

    ``key`` must be unique. No task holds more than about a ``blocks``-th of
    the rows.
    """
    one = df.withColumn("_one", F.lit(1).cast("long")).withColumn("_all", F.lit(0))
    return running_total(one, ["_all"], key, "_one", before=number, total="_n",
                         blocks=blocks).select(*df.columns, F.col(number).cast("long"))
