"""Best rows, flags, merge, keys, facts, changes, joins."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docengine.operators import changes, joins, model
from docengine.operators.similarity import centroids
from conftest import plan_of, rows

D = dt.date


def test_best_row_breaks_ties_by_time_and_groups_nulls(spark):
    df = spark.createDataFrame(
        [("a", "1", 0.7, 1), ("a", "1", 0.7, 2), ("a", None, 0.9, 1), ("a", None, 0.8, 9), ("b", None, 0.1, 1)],
        "set_id STRING, v STRING, score DOUBLE, at INT",
    )
    best = model.best_row(df, ["set_id", "v"], [F.desc("score"), F.desc("at")])
    assert rows(best) == [("a", "1", 0.7, 2), ("a", None, 0.9, 1), ("b", None, 0.1, 1)]
    # Rows beyond the best are dropped before the shuffle.
    assert plan_of(best).count("WindowGroupLimit") >= 2


FLAGS = [("a", D(2024, 1, 1), 1), ("a", D(2024, 2, 1), 2), ("a", D(2024, 2, 1), 3), ("a", None, 4),
         ("b", None, 5), (None, D(2024, 1, 1), 6)]


@pytest.mark.parametrize("strict, current", [(False, {2, 3, 6}), (True, {3, 6})])
def test_current_flag(spark, strict, current):
    df = spark.createDataFrame(FLAGS, "set_id STRING, d DATE, n INT")
    out = model.current_flag(df, "set_id", "d", strict=strict, tie_break=["n"] if strict else ())
    assert {r.n for r in out.collect() if r.is_current_version} == current
    assert out.count() == len(FLAGS) and out.filter("is_current_version IS NULL").count() == 0


def test_hot_id_is_split_by_the_skew_join(spark):
    """One id with most rows: the flag join splits its partition instead of sorting it in one task."""
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.range(0, 200000, 1, 16).select(
            F.when(F.col("id") < 150000, "hot").otherwise(F.col("id").cast("string")).alias("set_id"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("d"), "id",
        )
        out = model.current_flag(df, "set_id", "d").filter("is_current_version").select("set_id", "id")
        # 166 of the hot rows carry its newest date.
        assert len(out.collect()) == 50000 + 166
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SCHEMA = "id STRING, v STRING, name STRING, n INT, sk BIGINT"


def test_upsert_rules(spark):
    target = spark.createDataFrame([("a", None, "old", 1, 7), ("b", "1", "kept", 2, 8)], SCHEMA)
    source = spark.createDataFrame(
        [("a", None, "new", 10), ("c", "1", "in", 30)], "id STRING, v STRING, title STRING, n INT"
    )
    merged = model.upsert(target, source, ["id", "v"], {"name": "title"}, {"name": "title", "n": "n"})
    assert rows(merged) == [("a", None, "new", 1, 7), ("b", "1", "kept", 2, 8), ("c", "1", "in", 30, None)]
    assert merged.dtypes == target.dtypes
    with pytest.raises(ValueError):
        model.upsert(target, source.union(source), ["id", "v"], [], check_source=True)


keyed = st.dictionaries(st.tuples(st.sampled_from("abc"), st.sampled_from([None, "1", "2"])),
                        st.integers(0, 3), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(keyed, keyed)
def test_upsert_is_a_dictionary_update_and_idempotent(spark, old, new):
    def frame(d):
        return spark.createDataFrame([(*k, v) for k, v in d.items()], "id STRING, v STRING, n INT")

    once = model.upsert(frame(old), frame(new), ["id", "v"], ["n"])
    assert {(r.id, r.v): r.n for r in once.collect()} == {**old, **new}
    assert rows(model.upsert(once, frame(new), ["id", "v"], ["n"])) == rows(once)


def test_keys_are_dense_stable_and_continue(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(None).cast("string").alias("v"))
    one = model.assign_keys(df, ["k", "v"], "sk", 50)
    two = model.assign_keys(df.repartition(13), ["k", "v"], "sk", 50)
    assert sorted(r.sk for r in one.collect()) == list(range(51, 1051))
    assert rows(one) == rows(two)


def dim_source(spark, data):
    return spark.createDataFrame(
        data, "set_id STRING, label_version STRING, drug_name STRING, effective_date DATE, score DOUBLE"
    )


def refresh(source, dim):
    return model.refresh_dim(source, dim, ["set_id", "label_version"],
                             {"drug_name": "drug_name", "effective_date": "effective_date"},
                             [F.desc("score"), F.asc("drug_name")], as_of=F.lit("2024-01-01 00:00:00"))


def test_refresh_keeps_keys_and_moves_the_current_flag(spark):
    empty = spark.createDataFrame([], "drug_sk BIGINT, set_id STRING, label_version STRING, drug_name STRING, "
                                      "effective_date DATE, is_current_version BOOLEAN, created_at TIMESTAMP")
    first = refresh(dim_source(spark, [("a", "1", "x", D(2024, 1, 1), .9), ("a", "1", "y", D(2024, 1, 1), .7),
                                       ("b", None, "z", None, .9), (None, "1", "q", None, .9)]), empty)
    assert sorted((r.set_id, r.drug_name, r.is_current_version) for r in first.collect()) == [
        ("a", "x", True), ("b", "z", False)]
    # Version 1 of a has left the source: its key stays, its flag moves on.
    second = refresh(dim_source(spark, [("a", "2", "n", D(2024, 3, 1), .8), ("b", None, "z2", None, .9)]), first)
    old = {(r.set_id, r.label_version): r.drug_sk for r in first.collect()}
    new = {(r.set_id, r.label_version): r for r in second.collect()}
    assert {k: new[k].drug_sk for k in old} == old
    assert new[("a", "2")].drug_sk == 3
    assert not new[("a", "1")].is_current_version and new[("a", "2")].is_current_version
    assert new[("b", None)].drug_name == "z2"
    assert rows(refresh(dim_source(spark, [("b", None, "z2", None, .9)]), second)) == rows(second)


def test_fact_rules(spark):
    silver = spark.createDataFrame(
        [("a", None, [" a ", "", None, "a"], 1), ("a", None, ["a", "b"], 2), ("b", "1", None, 1), ("x", "1", ["q"], 1)],
        "set_id STRING, label_version STRING, ae ARRAY<STRING>, score INT",
    )
    dim = spark.createDataFrame([(1, "a", None), (2, "b", "1")], "drug_sk BIGINT, set_id STRING, label_version STRING")
    keys = ["set_id", "label_version"]
    every = model.build_fact(silver, dim, keys, "ae", keep=[])
    assert sorted(r.adverse_event for r in every.collect()) == ["a", "a", "a", "b"]
    best = model.build_fact(silver, dim, keys, "ae", keep=[], order=[F.desc("score")])
    assert sorted((r.drug_sk, r.adverse_event) for r in best.collect()) == [(1, "a"), (1, "b")]


def test_diff_and_apply(spark):
    schema = "k STRING, a STRING, n INT"
    old = spark.createDataFrame([("1", "x", 1), ("2", None, 1), ("3", "z", 1), ("4", "s", None)], schema)
    new = spark.createDataFrame([("1", "x", 1), ("2", "y", 1), ("4", None, 5), ("5", None, None)], schema)
    diff = changes.snapshot_diff(old, new, ["k"])
    assert rows(diff) == [("2", "update"), ("3", "delete"), ("4", "update"), ("5", "insert")]
    fresh = changes.changed_rows(new, diff, ["k"])
    assert rows(changes.apply_changes(old, diff, fresh, ["k"])) == rows(new)


def test_hash_tells_which_column_is_null(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x STRING, y STRING")
    assert df.select(changes.row_hash(["x", "y"])).distinct().count() == 2


def test_pending_and_orphans(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n INT, k STRING")
    done = spark.createDataFrame([("a",), ("a",)], "k STRING")
    assert rows(joins.pending(src, done, on=["k"])) == [(2, "b"), (3, None)]
    assert rows(joins.pending_capped(src, done, on=["k"], order=["n"], limit=1)) == [(2, "b")]
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    assert joins.fk_orphans(fact, spark.createDataFrame([(1,)], "k INT"), "k").count() == 2


def test_pending_joins_keys_not_payload(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    plan = plan_of(joins.pending_capped(docs, labels, on=["doc_id"], order=["source", "doc_id"], limit=5))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


PRICES = [("s", 1.0, "2024-01-01", "2024-01-05"), ("s", 2.0, "2024-01-05", None), ("t", 9.0, "2024-01-02", "2024-01-03")]
USES = [("s", "2024-01-01"), ("s", "2024-01-04"), ("s", "2024-01-05"), ("s", "2030-01-01"),
        ("t", "2024-01-03"), ("t", "2024-01-02"), ("u", "2024-01-02"), ("s", "2023-12-31")]


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("bucket", [None, 86400, 7 * 86400, 3600 * 24 * 400])
def test_effective_dates(spark, bucket, limit):
    prices = spark.createDataFrame(PRICES, "k STRING, p DOUBLE, a STRING, b STRING").select(
        "k", "p", F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    uses = spark.createDataFrame(USES, "k STRING, t STRING").select("k", F.col("t").cast("timestamp").alias("t"))
    got = joins.interval_join(uses, prices, ["k"], "t", "a", "b", bucket, limit)
    assert ("BroadcastHashJoin" in plan_of(got)) or limit == 0
    assert sorted((r.k, str(r.t.date()), r.p) for r in got.collect()) == [
        ("s", "2024-01-01", 1.0), ("s", "2024-01-04", 1.0), ("s", "2024-01-05", 2.0),
        ("s", "2030-01-01", 2.0), ("t", "2024-01-02", 9.0)]


def test_overlaps(spark):
    df = spark.createDataFrame(PRICES + [("t", 1.0, "2024-01-02", "2024-01-04"), ("s", 3.0, "2024-02-01", None)],
                               "k STRING, p DOUBLE, a STRING, b STRING")
    assert sorted(r.p for r in joins.no_overlap_violations(df, ["k"], "a", "b").collect()) == [1.0, 3.0]


def test_child_counts_keep_childless_parents(spark):
    parents = spark.range(3).withColumnRenamed("id", "k")
    children = spark.createDataFrame([(0,), (0,), (2,)], "k BIGINT")
    assert rows(joins.with_child_count(parents, children, "k")) == [(0, 2), (1, 0), (2, 1)]


def test_centroids(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [5.0, 5.0])], "g STRING, v ARRAY<FLOAT>")
    assert dict(centroids(df, ["g"], "v").collect()) == {"a": [2.0, 4.0], "b": [5.0, 5.0]}
