"""Deterministic per-row hash columns for splits and folds.

The hash of a row is md5 over its key and a seed, so it depends on nothing
but the row: the same split comes out for any partitioning, any cluster size
and any engine with md5 (the DuckDB oracles use the same text).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(key, seed) -> Column:
    """32 lowercase hex characters: md5('<key>:<seed>')."""
    return F.md5(F.concat_ws(":", _col(key).cast("string"), F.lit(str(seed))))


def hash_prefix_int(h, n_hex: int = 8) -> Column:
    """First `n_hex` hex characters of a hash as a non-negative bigint."""
    return F.conv(F.substring(_col(h), 1, n_hex), 16, 10).cast("bigint")


def hash_fold(key, k: int, seed) -> Column:
    """Fold number 0..k-1 of a row (T5)."""
    return F.pmod(hash_prefix_int(row_hash(key, seed)), F.lit(k)).cast("int")


def hash_unit(key, seed) -> Column:
    """A number in [0, 1) from the row hash (32 bits)."""
    return hash_prefix_int(row_hash(key, seed)) / F.lit(float(2 ** 32))
