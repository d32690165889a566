"""Training-table preparation: duplicate bags (A10) and class weights.

Duplicate bags are dropped with an aggregate, not a window: the smallest key
per digest of the sorted bag, partially aggregated, so a hot bag (say a third
of the table) folds inside each task and only digests and keys are shuffled;
the rows are then kept by key. They stay where they are as long as the kept keys
or the others can be broadcast; beyond that they are shuffled by key. Class weights come from a class table (one row per class,
size-checked) broadcast to the rows, so no row is ever shuffled by class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.operators.joins import MAX_BROADCAST_ROWS, bounded_table, join_small
from bagwise.session import materialize

MAX_KEYS = 1 << 20   # keys that are broadcast


def dedup_bags(df: DataFrame, key: str, bag_col: str = "tokens",
               class_col: str | None = None, max_keys: int = MAX_KEYS) -> DataFrame:
    """A10: one row per distinct bag (as a multiset), the smallest key wins.

    Two bags are equal when their sorted token lists are equal (repeats
    count). With ``class_col`` the class is part of the identity, so equal
    bags of different classes both stay; without it (the reference's
    behaviour) they collapse to the row with the smallest key.

    The keys are written: the kept ones, and those of all other rows if the
    kept ones are more than `max_keys`. The fewer of them decide each row
    where it is, without an exchange of the bags.
    """
    bag = F.unhex(F.sha2(F.to_json(F.sort_array(bag_col)), 256))  # 32 bytes, null for a null bag
    same = [bag.alias("_bag")] + ([F.col(class_col).alias("_class")] if class_col else [])
    kept = materialize(df.groupBy(*same).agg(F.min(key).alias(key)).select(key), "kept")
    if kept.count() <= max_keys:
        return df.join(F.broadcast(kept), key, "left_semi")
    others = materialize(df.select(key).join(kept, key, "left_anti").where(F.col(key).isNotNull()).distinct(), "others")
    if others.count() <= max_keys:
        return df.where(F.col(key).isNotNull()).join(F.broadcast(others), key, "left_anti")
    return df.join(kept, key, "left_semi")


def class_weight_table(df: DataFrame, class_col: str, total=None,
                       n_classes: int | None = None,
                       max_classes: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per class with its weight.

    ``weight = (total / class_count) / n_classes``. ``total`` defaults to the
    row count of `df`; pass the pre-dedup row count for the reference's
    numbers (it counted rows before dropping duplicates). ``n_classes``
    defaults to the number of classes found. Null classes are rejected: they
    have no meaningful weight.
    """
    counts = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("class_count"))
    counts = bounded_table(counts, max_classes).df  # a local relation up to max_classes, else the lazy table
    n_found, found, nulls = counts.agg(F.count(F.lit(1)), F.sum("class_count"),
                                       F.count(F.when(F.col(class_col).isNull(), 1))).first()
    if nulls:
        raise ValueError(f"null values in class column {class_col!r}")
    n = n_classes if n_classes is not None else n_found
    tot = total if total is not None else (found or 0)
    return (counts
            .withColumn("total", F.lit(int(tot)).cast("bigint"))
            .withColumn("weight", (F.col("total") / F.col("class_count"))
                        / F.lit(float(n))))


def with_class_weights(df: DataFrame, class_col: str, total=None,
                       n_classes: int | None = None,
                       weight_col: str = "weight") -> DataFrame:
    """Every row gets its class weight (broadcast class table)."""
    t = class_weight_table(df, class_col, total, n_classes)
    return join_small(df, t.select(class_col, F.col("weight").alias(weight_col)), class_col)
