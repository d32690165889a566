"""Joins with small, bounded tables.

A class table (one row per class) is small by nature, but "small" is checked,
not assumed: `bounded_table` takes at most `max_rows + 1` rows; when the
table fits, it is re-created as a local relation and broadcast, so the big
side is never shuffled by a (possibly hot) class key. When it does not fit,
the lazy table comes back un-hinted and the join goes through the shuffle
path, where AQE's skew-join handling splits hot partitions.

`join_hot` joins a large table with a table of one row for each key, where a few
keys may hold much of the large table. Those keys are found by mergeable
frequent-item summaries in one pass without a shuffle, their rows of the other
table are broadcast (a bounded number by construction), and the remaining rows
are shuffled, none of whose keys is hot. It doesn't rest on AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound on rows of a table that may be pulled to the driver and
# broadcast (class tables, per-class thresholds, label lists).
MAX_BROADCAST_ROWS = 100_000


class BoundedTable:
    """A table that was proven to hold at most `max_rows` rows (or not)."""

    def __init__(self, df: DataFrame, rows, bounded: bool):
        self.df = df
        self.rows = rows
        self.bounded = bounded

    def hinted(self) -> DataFrame:
        return F.broadcast(self.df) if self.bounded else self.df


def bounded_table(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> BoundedTable:
    """Evaluate a small table once, keep it local when it has <= max_rows rows."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        local = df.sparkSession.createDataFrame(rows, df.schema)
        return BoundedTable(local, rows, True)
    return BoundedTable(df, None, False)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join `big` with a table expected to be small (size checked first)."""
    t = bounded_table(small, max_rows)
    return big.join(t.hinted(), on, how)


#: Keys with more than one in so many rows are hot.
HOT_SHARE = 1000


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> list:
    """All keys that more than one in `share` rows have, and perhaps others; at most about `share` of them.

    Each task keeps `share` counters (Misra and Gries) and merges them with the
    others': no key is shuffled or counted in full.
    """
    row = df.where(F.col(key).isNotNull()).select(key).stat.freqItems([key], 1.0 / share).first()
    return sorted(row[0] or []) if row else []


def counted_hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> list:
    """All keys that more than one in `share` rows have, counted: for tables of so few columns that a grouped count
    costs less than the summaries."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    rows = df.count()
    return sorted(r[0] for r in sizes.where(F.col("_size") * share > rows).where(F.col(key).isNotNull()).select(key).collect())


def join_hot(big: DataFrame, table: DataFrame, key: str, how: str = "inner", share: int = HOT_SHARE,
             hot: list | None = None) -> DataFrame:
    """`big` joined with `table`, which has one row for each key (inner or left).

    `big` is read three times: pass a written table or a cheap scan. `hot`: the
    keys above the share where they are known already (about `share` at most).
    """
    hot = hot_keys(big, key, share) if hot is None else hot
    if not hot:
        return big.join(table, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return (big.where(is_hot).join(F.broadcast(table.where(is_hot)), key, how)
            .unionByName(big.where(~is_hot).join(table.where(~is_hot), key, how)))
