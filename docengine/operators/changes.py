"""Row changes between two states of a table, and applying them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def row_hash(cols: Sequence[str]) -> Column:
    """64-bit hash of a row; NULL flags first, as the hash skips NULL values.

    Two hashes meet only for the same key, so the chance of missing a change
    is 2**-64 per changed row whatever the size of the table.
    """
    return F.xxhash64(*[F.col(c).isNull() for c in cols], *cols)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  compare: Sequence[str] | None = None) -> DataFrame:
    """Keys that were inserted, updated or deleted, with ``change_type``.

    Only keys and one hash per row are shuffled, never the payload.
    """
    compare = [c for c in (compare or new.columns) if c not in keys]
    o = old.select(*[F.col(k).alias(f"o_{k}") for k in keys], row_hash(compare).alias("o_hash"))
    n = new.select(*[F.col(k).alias(f"n_{k}") for k in keys], row_hash(compare).alias("n_hash"))
    on = reduce(and_, [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in keys])
    change = (
        F.when(F.col("o_hash").isNull(), INSERT)
        .when(F.col("n_hash").isNull(), DELETE)
        .when(F.col("o_hash") != F.col("n_hash"), UPDATE)
    )
    key_of = [
        F.when(F.col("n_hash").isNotNull(), F.col(f"n_{k}")).otherwise(F.col(f"o_{k}")).alias(k)
        for k in keys
    ]
    return (
        o.join(n, on, "full_outer")
        .select(*key_of, change.alias("change_type"))
        .filter("change_type IS NOT NULL")
    )


def changed_rows(new: DataFrame, diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full rows of the inserted and updated keys."""
    touched = diff.filter(F.col("change_type") != DELETE)
    return _by_keys(new, touched, keys, "left_semi")


def apply_changes(current: DataFrame, diff: DataFrame, upserts: DataFrame,
                  keys: Sequence[str]) -> DataFrame:
    """``current`` without the changed keys, plus their new rows."""
    return _by_keys(current, diff, keys, "left_anti").unionByName(upserts)


def _by_keys(df: DataFrame, keyed: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    other = keyed.select(*[F.col(k).alias(f"k_{k}") for k in keys])
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys])
    return df.join(other, on, how)
