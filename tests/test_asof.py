"""The as-of join against a look at every period."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from docengine.operators.joins import asof_join, interval_join

DAY = dt.datetime(2024, 1, 1)
FACTS, PERIODS = "id long, sku string, at timestamp, price double", "sku string, price double, begins timestamp, ends timestamp"


def tables(seed, n=400):
    rng = random.Random(seed)
    time = lambda days: DAY + dt.timedelta(hours=rng.randrange(24 * days))
    periods = []
    for sku in ("hot", "b", "c", "open", "rare"):
        cuts = sorted({time(40) for _ in range(12)})
        for k, (a, z) in enumerate(zip(cuts, [*cuts[1:], None])):
            if rng.random() < 0.8:  # gaps without a price
                periods.append((sku, float(k), a, z if rng.random() < 0.9 or z is None else a + (z - a) / 2))
    periods.append(("open", 99.0, DAY - dt.timedelta(days=4000), min(p[2] for p in periods if p[0] == "open")))
    facts = [(i, "hot" if i % 3 == 0 else rng.choice(["b", "c", "open", "none"]), time(60), None) for i in range(n)]
    facts += [(n + i, "hot", DAY + dt.timedelta(days=9), None) for i in range(n // 2)]  # one key, one time
    facts += [(n + i, p[0], p[2], None) for i, p in enumerate(periods, n)]  # as a period begins
    facts += [(9000, None, DAY, None), (9001, "hot", None, None)]
    return [f[:3] + (0.0,) for f in facts], periods + [(None, 1.0, DAY, None), ("b", 2.0, None, None)]


def brute(facts, periods):
    return sorted((i, p) for i, sku, at, _ in facts for s, p, a, z in periods
                  if sku is not None and sku == s and at and a and a <= at and (z is None or at < z))


@pytest.mark.parametrize("seed, bucket, shards", [(1, 86400, 8), (2, 3600, 1), (3, 10 ** 9, 3)])
def test_rows_of_the_periods_in_force(spark, seed, bucket, shards):
    facts, periods = tables(seed)
    f = spark.createDataFrame(facts, FACTS).drop("price").repartition(4)
    p = spark.createDataFrame(periods, PERIODS).repartition(3)
    got = asof_join(f, p, ["sku"], "at", "begins", "ends", bucket, shards)
    assert got.columns == ["id", "sku", "at", "price", "begins", "ends"]
    pairs = sorted((r["id"], r["price"]) for r in got.collect())
    assert pairs == brute(facts, periods)
    other = interval_join(f, p.filter("sku IS NOT NULL"), ["sku"], "at", "begins", "ends")
    assert pairs == sorted((r["id"], r["price"]) for r in other.collect())


def test_overlapping_periods_give_the_last_to_begin_then_to_end(spark):
    at = [DAY + dt.timedelta(days=k) for k in range(9)]
    p = spark.createDataFrame([("a", 1.0, at[0], None), ("a", 2.0, at[2], at[4]), ("a", 3.0, at[2], at[6])], PERIODS)
    f = spark.createDataFrame([(k, "a", at[k] + dt.timedelta(hours=1)) for k in range(8)], "id long, sku string, at timestamp")
    got = asof_join(f, p, ["sku"], "at", "begins", "ends")
    assert {r["id"]: r["price"] for r in got.collect()} == {0: 1.0, 1: 1.0, 2: 3.0, 3: 3.0, 4: 3.0, 5: 3.0}


def test_empty_sides(spark):
    f, p = spark.createDataFrame([], FACTS).drop("price"), spark.createDataFrame([("a", 1.0, DAY, None)], PERIODS)
    assert asof_join(f, p, ["sku"], "at", "begins", "ends").count() == 0
    one = spark.createDataFrame([(1, "a", DAY)], "id long, sku string, at timestamp")
    assert asof_join(one, p.limit(0), ["sku"], "at", "begins", "ends").count() == 0


def test_nothing_is_sent_to_all_tasks(spark):
    facts, periods = tables(4)
    f = spark.createDataFrame(facts, FACTS).drop("price")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = asof_join(f, spark.createDataFrame(periods, PERIODS), ["sku"], "at", "begins", "ends")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and "NestedLoop" not in text
