"""Profile operators: class counts, token frequencies, bag sizes, top-k.

All of them are aggregations with partial (map-side) aggregation, so a hot
class or token is pre-aggregated per task before any shuffle. Top-k is
written as `limit` after a sort (TakeOrderedAndProject) or as `row_number`
with a filter (WindowGroupLimit runs before and after the shuffle); the
window is over the aggregated (class, token) table, whose rows per class are
bounded by the vocabulary, not by the row count. Every ranking has a full
tie-break, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bagwise.functions.tokens import token_rows


def class_counts(df: DataFrame, class_col: str) -> DataFrame:
    """A1: rows per class, largest first (ties by class name)."""
    return (df.groupBy(class_col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(class_col)))


def token_counts(df: DataFrame, bag_col: str = "tokens",
                 by=()) -> DataFrame:
    """A2/A3: occurrences per token (optionally per group columns `by`)."""
    rows = token_rows(df, bag_col, keep=list(by))
    return rows.groupBy(*by, "token").agg(F.count(F.lit(1)).alias("count"))


def top_tokens(df: DataFrame, n: int, bag_col: str = "tokens") -> DataFrame:
    """The n most frequent tokens overall, with rank 1..n."""
    counts = token_counts(df, bag_col)
    top = counts.orderBy(F.desc("count"), F.asc("token")).limit(n)
    w = Window.orderBy(F.desc("count"), F.asc("token"))
    # the window runs on at most n rows (after the limit)
    return top.withColumn("rank", F.row_number().over(w).cast("bigint"))


def top_tokens_per_class(df: DataFrame, class_col: str, n: int,
                         bag_col: str = "tokens") -> DataFrame:
    """O5 (and A3 for every class at once): top n tokens of each class."""
    counts = token_counts(df, bag_col, by=[class_col])
    w = Window.partitionBy(class_col).orderBy(F.desc("count"), F.asc("token"))
    return (counts.withColumn("rank", F.row_number().over(w).cast("bigint"))
                  .where(F.col("rank") <= n))


def top_tokens_of_class(df: DataFrame, class_col: str, value: str, n: int,
                        bag_col: str = "tokens") -> DataFrame:
    """A3 for one class (the reference's helper); the filter is on a source
    column, so it reaches the scan."""
    return top_tokens(df.where(F.col(class_col) == value), n, bag_col)


def distinct_token_count(df: DataFrame, bag_col: str = "tokens",
                         approx: bool = False) -> DataFrame:
    """Number of distinct tokens (exact by default; HyperLogLog++ on
    request)."""
    rows = token_rows(df, bag_col)
    if approx:
        return rows.agg(F.approx_count_distinct("token").alias("n_distinct_tokens"))
    return rows.select("token").distinct().agg(
        F.count(F.lit(1)).alias("n_distinct_tokens"))


def with_bag_size(df: DataFrame, bag_col: str = "tokens",
                  size_col: str = "n_tokens") -> DataFrame:
    """Bag length as a bigint column."""
    return df.withColumn(size_col, F.size(bag_col).cast("bigint"))


def bag_size_min_max(df: DataFrame, bag_col: str = "tokens") -> DataFrame:
    """A4: smallest and largest bag."""
    s = F.size(bag_col).cast("bigint")
    return df.agg(F.min(s).alias("min_tokens"), F.max(s).alias("max_tokens"))


def bag_size_histogram(df: DataFrame, bag_col: str = "tokens") -> DataFrame:
    """A5: number of bags per bag size, by size."""
    return (df.groupBy(F.size(bag_col).cast("bigint").alias("n_tokens"))
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy("n_tokens"))


def bag_size_avg_by_class(df: DataFrame, class_col: str,
                          bag_col: str = "tokens") -> DataFrame:
    """Mean bag size per class, smallest mean first."""
    return (df.groupBy(class_col)
              .agg(F.avg(F.size(bag_col)).alias("avg_tokens"))
              .orderBy("avg_tokens", class_col))


def long_bag_count(df: DataFrame, min_exclusive: int,
                   bag_col: str = "tokens") -> DataFrame:
    """number of bags with more than `min_exclusive` tokens."""
    return (df.where(F.size(bag_col) > min_exclusive)
              .agg(F.count(F.lit(1)).alias("n_bags")))


def bags_of_size(df: DataFrame, size: int, keep=(),
                 bag_col: str = "tokens") -> DataFrame:
    """F7 (and F2): bags of exactly `size` tokens with the kept columns."""
    return df.where(F.size(bag_col) == size).select(*keep, bag_col)


def distinct_classes(df: DataFrame, class_col: str) -> DataFrame:
    """The classes, sorted."""
    return df.select(class_col).distinct().orderBy(class_col)
