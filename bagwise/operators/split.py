"""Train / test splits and folds.

The exact split (T2) puts, in every class, the ``round(f * n_class)`` rows
with the smallest ``(md5(key:seed), key)`` into the test set. Written as a
window ``row_number() over (partition by class order by hash)`` this would
sort a whole class in one task, and one class may hold a third of the table.
Instead, the k-th smallest hash of each class is found in two steps:

1. count rows per (class, first 5 hex digits of the hash) -- a partially
   aggregated table of at most classes x 2^20 rows; a running sum per class
   finds the bucket that holds the k-th row and the rank inside it;
2. rank only the rows of that bucket (expected n_class / 2^20 rows, about a
   million even for a class of 10^12 rows; they reach the window through a
   broadcast filter) and read off the threshold row.

Each step shuffles aggregates or a small candidate set; the thresholds (one
row per class) are broadcast back and every row is labelled by a compare, a
narrow map with no shuffle of the table. The result equals the window form
row for row (the DuckDB oracle uses the window form).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bagwise.functions.hashing import hash_fold, hash_unit, row_hash
from bagwise.operators.joins import MAX_BROADCAST_ROWS, bounded_table
from bagwise.session import materialize
from bagwise.sources.tables import load_facts

_G = "_g"      # group column inside the split (class, or a constant)
_H = "_h"      # md5 hex of key:seed
_K = "_key"


def _join_g(left: DataFrame, right: DataFrame, how: str = "inner",
            hint: bool = True) -> DataFrame:
    """Join on the group column, null-safe (a null class is a group too)."""
    r = right.withColumnRenamed(_G, "_gr")
    r = F.broadcast(r) if hint else r
    return left.join(r, left[_G].eqNullSafe(r["_gr"]), how).drop("_gr")


def _attach(left: DataFrame, table, by, how: str = "inner") -> DataFrame:
    """Add the columns of a bounded per-group table to every row.

    With a class column: a null-safe broadcast hash join on the class. With
    no class (one group) the table is one already-collected row: its values
    become literals, so there is no join at all (a join on a constant key
    would plan a nested-loop join).
    """
    if by is not None:
        return _join_g(left, table.df, how, hint=table.bounded)
    fields = [f for f in table.df.schema.fields if f.name != _G]
    row = table.rows[0] if table.rows else None
    if row is None and how == "inner":
        return left.where(F.lit(False)).select(
            "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    return left.select("*", *[F.lit(None if row is None else row[f.name])
                             .cast(f.dataType).alias(f.name) for f in fields])


def _boundary(counts: DataFrame, part: str, carry=()) -> DataFrame:
    """Per group: the prefix `part` holding the `_q`-th row, and the rank of
    that row inside the prefix (new `_q`). `counts` has one row per
    (group, prefix) with its row count `_n` and the group's quota `_q`."""
    w = (Window.partitionBy(_G).orderBy(part)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    c = (counts.withColumn("_cum", F.sum("_n").over(w))
               .withColumn("_prev", F.col("_cum") - F.col("_n")))
    return (c.where((F.col("_prev") < F.col("_q")) & (F.col("_q") <= F.col("_cum")))
             .select(_G, *carry, part, (F.col("_q") - F.col("_prev")).alias("_q")))


# Hex digits of the bucket prefix: 16^5 = 2^20 buckets per class.
BUCKET_HEX = 5


def split_thresholds(df: DataFrame, key: str, fraction: float, seed,
                     by: str | None = None,
                     max_groups: int = MAX_BROADCAST_ROWS,
                     bucket_hex: int = BUCKET_HEX) -> DataFrame:
    """Per group: the (hash, key) of the last test row, as a bounded table.

    Columns: ``_g`` (the class), ``_th`` (hash), ``_tk`` (key). Groups whose
    quota ``round(fraction * n)`` is 0 have no row (all their rows train).
    Two small jobs; each pulls at most one row per group to the driver.
    """
    g = F.col(by) if by else F.lit(0)
    lab = df.select(g.alias(_G), F.col(key).alias(_K), row_hash(key, seed).alias(_H))

    # level 1: rows per (group, hash bucket); the group's size and quota come
    # from the same table (a window over at most 2^20 rows per group)
    c1 = lab.groupBy(_G, F.substring(_H, 1, bucket_hex).alias("_p1")).agg(
        F.count(F.lit(1)).alias("_n"))
    c1 = c1.withColumn("_q", F.round(F.sum("_n").over(Window.partitionBy(_G))
                                     * F.lit(float(fraction))).cast("bigint"))
    b1t = bounded_table(_boundary(c1.where(F.col("_q") > 0), "_p1"), max_groups)

    # level 2: rank only the rows of each group's boundary bucket (expected
    # n_group / 2^20 rows) and read off the threshold row
    l2 = (_attach(lab, b1t, by)
          .where(F.substring(_H, 1, bucket_hex) == F.col("_p1")))
    w = Window.partitionBy(_G).orderBy(_H, _K)
    th = (l2.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == F.col("_q"))
            .select(_G, F.col(_H).alias("_th"), F.col(_K).alias("_tk")))
    return bounded_table(th, max_groups)


def check_keys(df: DataFrame, key: str, class_col: str | None = None, seed=7) -> dict:
    """S3: what one scan saw (`tables.load_facts`); null or repeated keys fail, and null classes where a class is named."""
    seen = load_facts(df, key, class_col, seed).first().asDict()
    if seen["null_keys"] or seen["duplicate_keys"]:
        raise ValueError(f"{key!r}: {seen['null_keys']} null keys, {seen['duplicate_keys']} repeated keys")
    if seen["null_classes"]:
        raise ValueError(f"{seen['null_classes']} of {seen['n_rows']} rows have no {class_col!r}")
    return seen


def with_split(df: DataFrame, key: str, test_fraction: float, seed=7,
               by: str | None = None, split_col: str = "split",
               bucket_hex: int = BUCKET_HEX, checked: bool = False) -> DataFrame:
    """T2 (by=class) / T3 exact (by=None): add ``split`` = 'train' | 'test'.

    Exactly ``round(test_fraction * n)`` rows of each class are 'test';
    the choice depends only on key and seed. Null classes form their own
    group. Null or repeated keys are rejected: the split is by key (`checked`:
    the caller has done so with `check_keys`).
    """
    if not checked:
        check_keys(df, key, seed=seed)
    th = split_thresholds(df, key, test_fraction, seed, by, bucket_hex=bucket_hex)
    g = F.col(by) if by else F.lit(0)
    left = df.withColumn(_G, g).withColumn(_H, row_hash(key, seed))
    j = _attach(left, th, by, "left")
    is_test = F.coalesce(
        (F.col(_H) < F.col("_th"))
        | ((F.col(_H) == F.col("_th")) & (F.col(key) <= F.col("_tk"))),
        F.lit(False))
    return (j.withColumn(split_col, F.when(is_test, "test").otherwise("train"))
             .drop(_H, "_th", "_tk", _G))


def stratified_split(df: DataFrame, class_col: str, key: str,
                     test_fraction: float = 0.2, seed=7):
    """(train, test), exact per-class quota, repeatable."""
    s = with_split(df, key, test_fraction, seed, by=class_col, split_col="_split")
    return (s.where(F.col("_split") == "train").drop("_split"),
            s.where(F.col("_split") == "test").drop("_split"))


def random_split_exact(df: DataFrame, key: str, test_fraction: float = 0.2,
                       seed=7):
    """T3, repeatable: exact global quota, no class stratification."""
    s = with_split(df, key, test_fraction, seed, by=None, split_col="_split")
    return (s.where(F.col("_split") == "train").drop("_split"),
            s.where(F.col("_split") == "test").drop("_split"))


def random_split(df: DataFrame, test_fraction: float = 0.2, seed=7):
    """T3, the library form: `randomSplit` (Bernoulli per row; depends on
    the partitioning of `df`)."""
    train, test = df.randomSplit([1.0 - test_fraction, test_fraction], seed)
    return train, test


def hash_threshold_split(df: DataFrame, key: str, test_fraction: float = 0.2,
                         seed=7, split_col: str = "split") -> DataFrame:
    """Cheapest repeatable split: test iff the row's hash unit < fraction.

    No shuffle at all; class shares are right in expectation only."""
    return df.withColumn(split_col, F.when(hash_unit(key, seed) < test_fraction,
                                           "test").otherwise("train"))


def sample_by_split(df: DataFrame, class_col: str, key: str,
                    test_fraction: float = 0.2, seed=7):
    """T1, the reference's form: a Bernoulli draw per row with the same train
    fraction for every class, as `sampleBy` does; test = the other rows.

    Each row is tagged once and both sides read the tagged table: drawn again
    for each side, a second scan in another order would tear them apart.

    Bernoulli per row: sizes are approximate and change with partitioning.
    """
    tagged = materialize(df.withColumn("_train", (F.rand(seed) >= test_fraction) & F.col(class_col).isNotNull()), "tagged")
    return tagged.where("_train").drop("_train"), tagged.where("not _train").drop("_train")


def anti_join(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of `df` whose key is not in `other` (null keys stay)."""
    return df.join(other.select(key), on=key, how="left_anti")


def with_folds(df: DataFrame, key: str, k: int, seed=7,
               fold_col: str = "fold") -> DataFrame:
    """T5: fold number 0..k-1 from the row hash (no position, no window)."""
    return df.withColumn(fold_col, hash_fold(key, k, seed))


def split_sizes(df_with_split: DataFrame, class_col: str,
                split_col: str = "split") -> DataFrame:
    """T4: rows per (split, class)."""
    return (df_with_split.groupBy(split_col, class_col)
            .agg(F.count(F.lit(1)).alias("count")))
