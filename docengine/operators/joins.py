"""Joins: pending rows, orphans, lookups, child counts and effective dates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docengine.runtime import materialize

# Bytes of a period list that may be sent to every task.
BROADCAST_BYTES = 32 << 20


def _on(keys: Sequence[str], prefix: str) -> Column:
    return reduce(and_, [F.col(k) == F.col(f"{prefix}{k}") for k in keys])


# Bytes of keys that may be sent to every task, and what a key is taken for.
BROADCAST_KEY_BYTES, KEY_BYTES = 32 << 20, 256


def pending(src: DataFrame, *done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``src`` whose key is in none of the ``done`` tables.

    The done keys of all tables are made distinct together, so there is one
    join, and a key that was processed many times crosses the network once
    per map task.
    """
    if not done:
        return src
    keys = union_all([table.select(*[F.col(k).alias(f"d_{k}") for k in on]) for table in done]).distinct()
    return src.join(keys, _on(on, "d_"), "left_anti")


def pending_capped(src: DataFrame, *done: DataFrame, on: Sequence[str], order: Sequence[str],
                   limit: int | None) -> DataFrame:
    """Pending rows; with a ``limit`` at most so many, in a fixed order.

    The anti join and the cap see only the key columns.  Without a cap the
    chosen keys are written and counted.  While they are small, the wide rows
    are found by a scan and not shuffled.
    """
    cols = list(dict.fromkeys([*on, *order]))
    chosen = pending(src.select(*cols), *done, on=on)
    if limit is not None:
        chosen = chosen.orderBy(*order).limit(limit)
    picked = chosen.select(*[F.col(c).alias(f"p_{c}") for c in cols]).distinct()
    if limit is None:
        picked = materialize(picked, "pending")
    if (picked.count() if limit is None else limit) * KEY_BYTES <= BROADCAST_KEY_BYTES:
        picked = F.broadcast(picked)
    match = reduce(and_, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in cols])
    return src.join(picked, match, "left_semi")


def cap(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Work cap in a fixed order, so that a rerun takes the same rows."""
    return df.orderBy(*order).limit(n)


def fk_orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows of ``fact`` whose key has no row in ``dim``; a NULL key is an orphan."""
    keys = dim.select(F.col(dim_key or key).alias("_k")).distinct()
    return fact.join(keys, F.col(key) == F.col("_k"), "left_anti")


def with_dim(fact: DataFrame, dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Inner join with a dimension; Spark broadcasts it when its size allows."""
    return fact.join(dim.select(key, *cols), key)


def with_lookup(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    return df.join(lookup, key)


def with_child_count(parent: DataFrame, child: DataFrame, key: str, out: str = "n_children") -> DataFrame:
    """Number of child rows of every parent, 0 when there are none."""
    counts = child.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
    return (
        parent.join(counts, F.col(key) == F.col("_k"), "left")
        .withColumn(out, F.coalesce("_n", F.lit(0)))
        .drop("_k", "_n")
    )


def side_by_side(spark, **scalars: DataFrame) -> DataFrame:
    """One row of independent one-value queries, as scalar subqueries."""
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in scalars.items()])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def held_bytes(df: DataFrame) -> int:
    """Size of the rows as text, a few bytes per field added; one aggregate."""
    width = reduce(add, [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns])
    return df.agg(F.sum(width)).first()[0] or 0


def interval_join(
    facts: DataFrame,
    periods: DataFrame,
    on: Sequence[str],
    ts: str,
    start: str,
    end: str,
    bucket_seconds: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows joined with the periods in force at ``ts``: ``start <= ts < end``.

    A NULL ``end`` is open.  Keys are often few and hot, so the facts should
    not be shuffled by key: periods of up to ``broadcast_bytes``, measured first,
    are sent out; more are joined by sort-merge, where the adaptive skew
    handling splits the facts of a hot key.

    When one key has many periods, give the length of a bucket: each period
    is listed under every bucket it touches (inside the time span of the
    facts) and a row meets the periods of its own bucket only.
    """
    p = periods.select(*[F.col(c).alias(f"p_{c}") if c in on else F.col(c) for c in periods.columns])
    at, begins, ends = F.col(ts), F.col(start), F.col(end)
    match = _on(on, "p_") & (begins <= at) & (ends.isNull() | (at < ends))
    if bucket_seconds is not None:
        def bucket(c: Column) -> Column:
            return F.floor(F.unix_seconds(c.cast("timestamp")) / bucket_seconds)

        low, high = facts.agg(F.min(bucket(at)), F.max(bucket(at))).first()
        first = F.greatest(bucket(begins), F.lit(low).cast("bigint"))
        last = F.least(F.coalesce(bucket(ends), F.lit(high).cast("bigint")), F.lit(high).cast("bigint"))
        touched = F.when(first <= last, F.sequence(first, last))
        p = p.withColumn("_bucket", F.explode(touched))
        facts = facts.withColumn("_b", bucket(at))
        match = match & (F.col("_b") == F.col("_bucket"))
    p = materialize(p, "periods")
    if held_bytes(p) <= broadcast_bytes:
        p = F.broadcast(p)
    return facts.join(p, match).drop("_b", "_bucket", *[f"p_{k}" for k in on])


def no_overlap_violations(
    periods: DataFrame, on: Sequence[str], start: str, end: str, bucket_seconds: int = 86400
) -> DataFrame:
    """Periods that begin before an earlier one of the same key has ended.

    A running maximum of the ends seen so far, no pairs.  It is taken in two
    steps, so that a key with a large share of the rows is not one task: over
    the buckets of a key (one aggregated row per bucket of ``start``), and
    over the rows inside a bucket.
    """
    forever = F.lit("9999-12-31").cast("timestamp")
    rows = periods.withColumns(
        {
            "_start": F.col(start).cast("timestamp"),
            "_end": F.coalesce(F.col(end).cast("timestamp"), forever),
            "_bucket": F.floor(F.unix_seconds(F.col(start).cast("timestamp")) / bucket_seconds),
        }
    )
    before = Window.partitionBy(*on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        rows.groupBy(*on, "_bucket")
        .agg(F.max("_end").alias("_last"))
        .select(
            *[F.col(k).alias(f"e_{k}") for k in on],
            F.col("_bucket").alias("e_bucket"),
            F.max("_last").over(before).alias("_reached"),
        )
    )
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"e_{k}")) for k in on])
    inside = (
        Window.partitionBy(*on, "_bucket").orderBy("_start", "_end").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("_here", F.max("_end").over(inside))
        .join(earlier, match & (F.col("_bucket") == F.col("e_bucket")))
        .filter(F.greatest("_reached", "_here") > F.col("_start"))
        .select(*periods.columns)
    )


def asof_join(
    facts: DataFrame,
    periods: DataFrame,
    on: Sequence[str],
    ts: str,
    start: str,
    end: str,
    bucket_seconds: int = 86400,
    shards: int = 8,
) -> DataFrame:
    """Rows with the period of their key that began last, if it is still in force at ``ts``.

    The same rows as ``interval_join`` where periods of a key do not overlap
    (``no_overlap_violations`` lists those that do; of overlapping ones the
    last to begin counts, of two that begin together the last to end).  It
    compares no row with more than one period and sends nothing to all tasks:

    - Inside a bucket of time, periods and rows of a key are put in order and
      the last period is carried on.  The rows of a hot key are dealt over its
      buckets, and those of a bucket over ``shards``; a period stands in the
      bucket that it begins in, once for each shard, however long it lasts.
    - Over buckets, one row per key and bucket carries the last period on to
      the buckets after it; a row takes that if its own bucket has none before it.

    Rows or periods with a NULL key or time meet nothing.
    """
    def bucket(c: Column) -> Column:
        return F.floor(F.unix_seconds(c.cast("timestamp")) / bucket_seconds)

    usable = lambda *cols: reduce(and_, [F.col(c).isNotNull() for c in cols])
    kept = [c for c in periods.columns if c not in on]
    # Compared field by field: the last to begin, then the last to end.
    when = F.struct(F.col(start).alias("at"), F.coalesce(F.col(end).cast("timestamp"),
                                                         F.lit("9999-12-31").cast("timestamp")).alias("to"))
    begun = periods.filter(usable(*on, start)).select(
        *on, bucket(F.col(start)).alias("_bucket"), F.col(start).cast("timestamp").alias("_at"), when.alias("_when"),
        F.struct(*kept).alias("_period"))
    rows = facts.filter(usable(*on, ts)).select(
        *on, bucket(F.col(ts)).alias("_bucket"), F.col(ts).cast("timestamp").alias("_at"),
        F.pmod(F.xxhash64(*facts.columns), F.lit(shards)).cast("int").alias("_shard"), F.struct(*facts.columns).alias("_fact"))
    dealt = begun.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = rows.unionByName(dealt, allowMissingColumns=True)
    in_order = (Window.partitionBy(*on, "_bucket", "_shard").orderBy("_at", F.col("_fact").isNotNull(), "_when")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = both.withColumn("_own", F.last("_period", ignorenulls=True).over(in_order)).filter(
        F.col("_fact").isNotNull()).select(*on, "_bucket", "_fact", "_own")

    marks = rows.select(*on, "_bucket").unionByName(begun.select(*on, "_bucket", "_when", "_period"), True).groupBy(
        *on, "_bucket").agg(F.max_by("_period", "_when").alias("_last"))
    over = Window.partitionBy(*on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = marks.select(*[F.col(k).alias(f"b_{k}") for k in on], F.col("_bucket").alias("b_bucket"),
                          F.last("_last", ignorenulls=True).over(over).alias("_before")).filter("_before IS NOT NULL")
    match = _on(on, "b_") & (F.col("_bucket") == F.col("b_bucket"))
    period = F.coalesce("_own", "_before")
    met = carried.join(before, match, "left").select("_fact", period.alias("_period"))
    until = F.col(f"_period.{end}")
    in_force = F.col("_period").isNotNull() & (until.isNull() | (F.col(f"_fact.{ts}") < until))
    return met.filter(in_force).select("_fact.*", *[F.col(f"_period.{c}").alias(c) for c in kept])
