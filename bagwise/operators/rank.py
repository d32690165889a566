"""Ranks of a whole table without a task that sees all of it.

A window without a partition sends every row to one task, and a rank within
groups of a prefix does the same where one prefix holds the table. Here Spark
deals the rows out by sampled range boundaries, each range is sorted on its own
and written with its rows numbered, and a table of the ranges' sizes (a row for
each partition) says how many rows come before each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bagwise.session import materialize

_POSITION_BITS = 33   # monotonically_increasing_id: the partition above, the row's position in it below


def ranked(df: DataFrame, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """`df` with `rank_col`, its rows' numbers from 1 in the given order.

    Rows that are equal in all columns of `order` get consecutive numbers in
    some order; give a full order for a repeatable rank. The boundaries cover
    all of `order`, so a value of the first column that most rows share is
    spread by the columns after it.
    """
    numbered = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
          .withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", _POSITION_BITS).cast("int")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
             .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # a row for each shuffle partition: bounded by that setting
    return (numbered.withColumn("_part", part).join(F.broadcast(sizes), "_part")
            .withColumn(rank_col, F.col("_before") + position + 1)
            .drop("_part", "_before", "_at"))
