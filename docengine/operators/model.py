"""Dimension and fact building: best rows, current flags, upsert, keys, facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docengine.functions.text import as_col
from docengine.runtime import materialize


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys; Spark plans it as an ordinary equi join."""
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def _prefixed(df: DataFrame, prefix: str, cols: Sequence[str] | None = None) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in (cols or df.columns)])


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in ``order``; NULL keys form a group of their own.

    ``row_number() = 1`` is planned with a partial group limit before the
    shuffle, so a hot key sends one row per map task, not all its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def current_flag(
    df: DataFrame,
    id_col: str,
    date_col: str,
    out: str = "is_current_version",
    strict: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """TRUE on the newest row of an id; a NULL date is FALSE.

    All rows that tie on the newest date are current, or with ``strict`` only
    the one with the greatest ``tie_break``.

    The newest date is a map-side combined aggregate joined back by id.  A
    window over the id would sort all rows of a hot id in one task; the join
    is split by the adaptive skew handling.
    """
    rank = F.struct(date_col, *tie_break) if strict else F.col(date_col)
    newest = (
        df.filter(F.col(date_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(rank).alias("_newest"))
    )
    flag = F.coalesce(F.col(date_col).isNotNull() & (rank == F.col("_newest")), F.lit(False))
    return (
        df.join(newest, F.col(id_col).eqNullSafe(F.col("_id")), "left")
        .withColumn(out, flag)
        .drop("_id", "_newest")
    )


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise when a key repeats; one aggregate job, one example row at the driver."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{what} is not unique on {list(keys)}: {repeated[0].asDict()}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Mapping[str, str] | Sequence[str],
    insert_cols: Mapping[str, str] | Sequence[str] | None = None,
    check_source: bool = True,
) -> DataFrame:
    """Target after a merge: matched rows updated, new rows inserted, the rest kept.

    Column lists may map a target column to a source column.  Keys compare
    null-safe and have to be unique in both inputs (``check_source`` tests the
    source first), so the full outer join has no skewed key.
    """
    if check_source:
        assert_unique(source, keys)
    updates = dict(update_cols) if isinstance(update_cols, Mapping) else {c: c for c in update_cols}
    if insert_cols is None:
        inserts = updates
    else:
        inserts = dict(insert_cols) if isinstance(insert_cols, Mapping) else {c: c for c in insert_cols}
    used = list(dict.fromkeys([*keys, *updates.values(), *inserts.values()]))
    t = _prefixed(target, "t_").withColumn("t_here", F.lit(True))
    s = _prefixed(source, "s_", used).withColumn("s_here", F.lit(True))
    on = reduce(and_, [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in keys])
    matched = F.col("t_here").isNotNull() & F.col("s_here").isNotNull()
    in_target = F.col("t_here").isNotNull()

    def value(field) -> Column:
        c = field.name
        old = F.col(f"t_{c}")
        if c in keys:
            out = F.when(in_target, old).otherwise(F.col(f"s_{c}"))
        else:
            out = F.when(matched, F.col(f"s_{updates[c]}")) if c in updates else F.when(matched, old)
            out = out.when(in_target, old)
            if c in inserts:
                out = out.otherwise(F.col(f"s_{inserts[c]}"))
        return out.cast(field.dataType).alias(c)

    return t.join(s, on, "full_outer").select(*[value(f) for f in target.schema.fields])


def key_bucket(keys: Sequence[str], digits: int = 3) -> Column:
    """Hash bucket of a business key: ``16 ** digits`` buckets of equal size, 65,536 at most."""
    if not 1 <= digits <= 4:
        raise ValueError("between 1 and 4 digits")
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys]
    return F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, digits)


def assign_keys(
    df: DataFrame,
    keys: Sequence[str],
    out: str,
    start: Column | int = 0,
    digits: int = 3,
) -> DataFrame:
    """Number rows ``start + 1, start + 2, ..`` in order of (hash bucket, key).

    Keys have to be unique.  The number is a function of the set of keys, so a
    recomputed task gives the same one.  Rows are numbered per bucket in
    parallel; the running total is taken over the at most ``16 ** digits``
    bucket counts, which also bounds the broadcast.
    """
    start = F.lit(start) if isinstance(start, int) else start
    bucketed = df.withColumn("_bucket", key_bucket(keys, digits))
    counts = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("_bucket").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    return (
        bucketed.withColumn("_rn", F.row_number().over(within))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(out, (start + F.col("_before") + F.col("_rn")).cast("bigint"))
        .drop("_bucket", "_before", "_rn")
    )


def refresh_dim(
    source: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, str],
    order: Sequence[Column],
    sk_col: str = "drug_sk",
    id_col: str = "set_id",
    date_col: str = "effective_date",
    flag_col: str = "is_current_version",
    time_col: str = "created_at",
    as_of: Column | None = None,
    strict: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Next state of a dimension: best source row per key, merged, keyed, flagged.

    ``columns`` maps dimension columns to source columns.  Existing surrogate
    keys stay; new keys continue after the greatest one.  Flags are recomputed
    over the merged rows, so that rows which left the source do not stay
    current.

    The merged rows are written once to the shared folder: numbering and flags
    need two passes each, over the dimension instead of over the source.
    """
    best = best_row(source.filter(F.col(id_col).isNotNull()), keys, order).select(
        *keys, *[F.col(src).alias(c) for c, src in columns.items() if c not in keys]
    )
    loaded = (F.current_timestamp() if as_of is None else as_of).cast("timestamp")
    refreshed = [c for c in columns if c not in keys] + [time_col]
    merged = materialize(upsert(dim, best.withColumn(time_col, loaded), keys, refreshed), "dim")
    greatest = merged.agg(F.coalesce(F.max(sk_col), F.lit(0)).cast("bigint")).scalar()
    known = merged.filter(F.col(sk_col).isNotNull())
    fresh = assign_keys(merged.filter(F.col(sk_col).isNull()).drop(sk_col), keys, sk_col, greatest)
    return current_flag(
        known.unionByName(fresh).drop(flag_col), id_col, date_col, flag_col,
        strict=strict, tie_break=tie_break,
    ).select(*dim.columns)


def build_fact(
    source: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    array_col: str,
    item_col: str = "adverse_event",
    sk_col: str = "drug_sk",
    keep: Sequence[str] = ("effective_date",),
    order: Sequence[Column] | None = None,
    as_of: Column | None = None,
    time_col: str = "created_at",
) -> DataFrame:
    """One row per dimension member and distinct, trimmed, non-blank array item.

    With ``order`` the best source row per key is used and items are distinct
    inside it: that is the grain of the fact, without a shuffle of exploded
    rows.  Without ``order`` every source row and every repeated item counts.
    The surrogate key is attached before the array is exploded.
    """
    rows = source if order is None else best_row(source, keys, order)
    items = F.filter(
        F.transform(F.coalesce(array_col, F.array()), lambda a: F.trim(a)),
        lambda a: a.isNotNull() & (a != ""),
    )
    if order is not None:
        items = F.array_distinct(items)
    rows = rows.select(*keys, *keep, items.alias("_items"))
    members = dim.select(F.col(sk_col), *[F.col(k).alias(f"d_{k}") for k in keys]).filter(
        F.col(sk_col).isNotNull()
    )
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"d_{k}")) for k in keys])
    # Outer, then filtered: see the chunker.
    out = (
        rows.join(members, on)
        .select(sk_col, *keys, *keep, F.explode_outer("_items").alias(item_col))
        .filter(F.col(item_col).isNotNull())
    )
    if as_of is not None:
        out = out.withColumn(time_col, as_of.cast("timestamp"))
    return out


def facts_per_entity(dim: DataFrame, fact: DataFrame, sk_col: str, name_col: str, n: int = 20,
                     out: str = "n_adverse_events") -> DataFrame:
    """Members with the most facts, counted per key before the join with the names."""
    counted = fact.groupBy(sk_col).agg(F.count("*").alias("_n"))
    return (
        counted.join(dim.select(sk_col, name_col), sk_col)
        .groupBy(name_col)
        .agg(F.sum("_n").alias(out))
        .orderBy(F.desc(out), name_col)
        .limit(n)
    )


def dim_preview(dim: DataFrame, cols: Sequence[str], order: Sequence[str], text_col: str | None = None,
                n: int = 20, chars: int = 100) -> DataFrame:
    picked = [as_col(c) for c in cols]
    if text_col:
        picked.append(F.substring(text_col, 1, chars).alias(f"{text_col}_preview"))
    return dim.select(*picked).orderBy(*order).limit(n)
