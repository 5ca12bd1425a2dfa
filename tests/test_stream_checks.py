import pytest

from conftest import rows
from docengine.operators import expectations as ex
from docengine.streaming.checks import StreamStopped, checked_append, unlogged, violation_rows

SCHEMA = "k INT, s STRING"


def deliver(spark, where, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(where)


def arrived(spark, where, per_batch=None):
    reader = spark.readStream.schema(SCHEMA)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(where)


def paths(tmp_path):
    return [str(tmp_path / x) for x in ("in", "table", "checkpoint", "log")]


def test_counts_of_every_batch(spark, tmp_path):
    source, table, checkpoint, log = paths(tmp_path)
    checks = [ex.expect_not_null("k", "t", "k", severity="warn"), ex.expect_not_blank("s", "t", "s")]
    deliver(spark, source, [(1, "a"), (None, "b")])
    first = checked_append(arrived(spark, source), table, checkpoint, checks, log, "r1")
    assert rows(first.select("batch_id", "check_id", "violation_count", "row_count_total")) == [(0, "k", 1, 2), (0, "s", 0, 2)]
    # Nothing new: no batch, no rows.
    assert checked_append(arrived(spark, source), table, checkpoint, checks, log, "r2").count() == 2
    deliver(spark, source, [(None, "a"), (None, "b"), (3, "c")])
    both = checked_append(arrived(spark, source), table, checkpoint, checks, log, "r3")
    assert rows(violation_rows(both).select("run_id", "check_id", "message")) == [
        ("r1-0", "k", "1 of 2 rows violated this assertion"), ("r3-1", "k", "2 of 3 rows violated this assertion")]
    assert spark.read.parquet(table).count() == 5
    committed = spark.createDataFrame([(0,), (1,), (2,)], "batch_id BIGINT")
    assert rows(unlogged(both, committed)) == [(2,)]
    assert rows(unlogged(both.filter("NOT (batch_id = 1 AND check_id = 's')"), committed)) == [(1,), (2,)]


def test_error_stops_the_stream(spark, tmp_path):
    """Five deliveries, one a batch and started slowly: after the second, which fails, the stream ends."""
    source, table, checkpoint, log = paths(tmp_path)
    checks = [ex.expect_not_null("k", "t", "k")]
    for i in range(5):
        deliver(spark, source, [(None if i == 1 else i, "a")])
    with pytest.raises(StreamStopped, match="k in batch 1"):
        checked_append(arrived(spark, source, 1), table, checkpoint, checks, log, "r1", processingTime="3 seconds")
    kept = spark.read.parquet(table).count()
    assert 2 <= kept <= 3
    # The next start goes on behind it; by then the checks pass.
    done = checked_append(arrived(spark, source, 1), table, checkpoint, checks, log, "r2")
    assert spark.read.parquet(table).count() == 5
    assert rows(done.filter("violation_count > 0").select("run_id", "batch_id")) == [("r1", 1)]
    assert rows(done.select("batch_id").distinct()) == [(i,) for i in range(5)]


def test_refuses_checks_of_groups(spark, tmp_path):
    source, table, checkpoint, log = paths(tmp_path)
    deliver(spark, source, [(1, "a")])
    for check in (ex.expect_unique("u", "t", "k"), ex.expect_row_count("n", "t", 3), ex.expect_completeness("c", "t", "k")):
        with pytest.raises(ValueError, match="single rows"):
            checked_append(arrived(spark, source), table, checkpoint, [check], log, "r1")


def test_failure_of_the_stream_is_raised(spark, tmp_path):
    source, table, checkpoint, log = paths(tmp_path)
    deliver(spark, source, [(1, "a")])
    broken = arrived(spark, source).selectExpr("k", "raise_error('broken') AS s")
    with pytest.raises(Exception, match="broken"):
        checked_append(broken, table, checkpoint, [ex.expect_not_null("k", "t", "k")], log, "r1")
