"""Mergeable sketches of bags per class.

A table of sketches has one row per group (a class, or a class and a day or
source): rows, a HyperLogLog sketch of the tokens and a KLL sketch of the bag
sizes. It is stored like any table and merged over groups later, without the
bags: a new day adds its rows, nothing is read again. A row has a bounded
size, so the shuffles of both steps grow with groups and tasks, not with rows,
and a class with most rows is folded inside each task.

Errors: distinct counts have a relative standard error of 1.04 / sqrt(2 ** lg_k)
(1.6 % at 12); a quantile's rank is off by about 1.65 / k at 99 % confidence
(0.8 % at 200), and exact while fewer than about k sizes were seen. KLL
sketches are randomised: two runs may differ within that error.

Defined cases: a null bag counts as a row and has no size; an empty one has size
0 and no tokens; null groups are a group of their own; an empty table has no
rows; a group without sizes has null quantiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
K = 200


def bag_sketches(df: DataFrame, by, bag_col: str = "tokens", lg_k: int = LG_K, k: int = K) -> DataFrame:
    """(by..., n_bags, token_sketch, size_sketch): one scan and one aggregation of the token rows."""
    first = F.coalesce(F.col("__at"), F.lit(0)) == 0   # a bag's first row, the only one of an empty or null bag
    size = F.when(first & F.col("__size").isNotNull(), F.col("__size"))
    rows = (df.select(*by, F.size(bag_col).alias("__n"), F.posexplode_outer(bag_col).alias("__at", "__token"))
              .withColumn("__size", F.when(F.col("__n") >= 0, F.col("__n").cast("bigint"))))
    return rows.groupBy(*by).agg(F.count_if(first).alias("n_bags"),
                                 F.hll_sketch_agg("__token", F.lit(lg_k)).alias("token_sketch"),
                                 F.kll_sketch_agg_bigint(size, F.lit(k)).alias("size_sketch"))


def merged(sketches: DataFrame, by) -> DataFrame:
    """The sketches of larger groups, from those of smaller ones."""
    return sketches.groupBy(*by).agg(F.sum("n_bags").alias("n_bags"), F.hll_union_agg("token_sketch").alias("token_sketch"),
                                     F.kll_merge_agg_bigint("size_sketch").alias("size_sketch"))


def estimates(sketches: DataFrame, by, quantiles=(0.5, 0.9)) -> DataFrame:
    """(by..., n_bags, n_distinct_tokens, sizes): `sizes` has the bag size at each of the quantiles."""
    some = F.kll_sketch_get_n_bigint("size_sketch") > 0
    sizes = F.array(*(F.kll_sketch_get_quantile_bigint("size_sketch", F.lit(float(q))) for q in quantiles))
    return sketches.select(*by, "n_bags", F.hll_sketch_estimate("token_sketch").alias("n_distinct_tokens"),
                           F.when(some, sizes).alias("sizes"))


def exact_beside(df: DataFrame, found: DataFrame, class_col: str, quantiles=(0.5, 0.9), bag_col: str = "tokens",
                 count_error: float = 0.06, rank_error: float = 0.03) -> DataFrame:
    """`estimates` of each class beside exact values: distinct tokens, and whether the sketches are within the errors.

    A size is within the error if the share of smaller bags is at most, and of bags up to it at least, its quantile.
    """
    known = found.withColumnsRenamed({class_col: "__class", "n_distinct_tokens": "__estimate"})
    size = F.size(bag_col)
    shares = [F.struct(F.avg((size < F.col("sizes")[i]).cast("int")).alias("below"),
                       F.avg((size <= F.col("sizes")[i]).cast("int")).alias("upto")).alias(f"__{i}") for i in range(len(quantiles))]
    ranks = (df.where(F.col(bag_col).isNotNull()).join(known, F.col(class_col).eqNullSafe(F.col("__class")))
               .groupBy(class_col).agg(*shares).withColumnRenamed(class_col, "__ranked"))
    inside = F.lit(True)
    for i, q in enumerate(quantiles):
        inside &= (F.col(f"__{i}.below") <= q + rank_error) & (F.col(f"__{i}.upto") >= q - rank_error)
    tokens = (df.select(class_col, F.explode(bag_col).alias("__token")).distinct().groupBy(class_col)
                .agg(F.count("*").alias("n")).select(F.col(class_col).alias("__counted"), "n"))
    exact = F.coalesce("n", F.lit(0))
    return (known.join(tokens, F.col("__class").eqNullSafe(F.col("__counted")), "left")
                 .join(ranks, F.col("__class").eqNullSafe(F.col("__ranked")), "left")
                 .select(F.col("__class").alias(class_col), "n_bags", exact.alias("n_distinct_tokens"),
                         (F.abs(F.col("__estimate") - exact) <= count_error * exact).alias("count_within"),
                         F.coalesce(inside, F.col("sizes").isNull()).alias("sizes_within")))
