"""Data-quality checks on a running stream, and its stop by severity."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.operators.expectations import ERROR, Check, observe_checks
from docengine.schemas import INT, LONG, TABLES, TEXT, TIME, layout
from docengine.sources.tables import read_or_empty
from docengine.streaming.ingest import append_stream

# One row per batch and check, violated or not.
LOG = layout(
    ("run_id", "batch_id", "check_id"),
    run_id=TEXT, batch_id=LONG, check_id=TEXT, target_table=TEXT, layer=TEXT, severity=TEXT, violation_count=LONG,
    row_count_total=LONG, n_checks=INT, checked_at=TIME,
)


class StreamStopped(AssertionError):
    """A batch failed a check of severity ``error``."""


def batch_results(progress, name: str, checks: Sequence[Check], run_id: str) -> list[tuple]:
    """Log rows of one progress event; none for a batch without rows or counts."""
    counts = (progress.observedMetrics or {}).get(name)
    if counts is None or not counts["row_count_total"]:
        return []
    total = counts["row_count_total"]
    at = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    return [(run_id, progress.batchId, c.check_id, c.target_table, c.layer, c.severity, counts[c.check_id], total,
             len(checks), at) for c in checks]


def checked_append(df: DataFrame, path: str, checkpoint: str, checks: Sequence[Check], log: str, run_id: str,
                   partition_by: Sequence[str] = (), poll_seconds: float = 0.2, **trigger) -> DataFrame:
    """Append a stream to a Parquet table and count violations of row-level checks per batch.

    The counts come with the write of the batch (``observe``), so that rows
    are read once and nothing is shuffled.  Every batch adds one row per check
    to ``log``.  A batch that fails a check of severity ``error`` stops the
    query and raises ``StreamStopped``: that batch is in the table, as are
    its counts in the log, and later ones wait for the next start.  (One that
    was already running when the counts came may be finished too.)
    Checks with a tolerance or of groups have no meaning row by row and are
    refused.  Counts are those of the run that committed a batch; a driver
    lost between commit and log leaves the batch without log rows, which
    ``unlogged`` finds.  Returns the whole log.
    """
    spark = df.sparkSession
    odd = [c.check_id for c in checks if c.bad is None or c.adjust is not None]
    if odd:
        raise ValueError(f"not checks of single rows: {', '.join(odd)}")
    name = f"checks of {run_id}"
    query = append_stream(observe_checks(df, name, checks), path, checkpoint, tuple(partition_by), wait=False, **trigger)
    seen, failed = set(), []

    def take() -> None:
        """Log what has been finished since; at most the recent events that Spark keeps."""
        rows = []
        for event in query.recentProgress:
            if event.batchId not in seen:
                found = batch_results(event, name, checks, run_id)
                if found:
                    seen.add(event.batchId)
                rows += found
        if rows:
            spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(log)
        failed.extend((r[1], r[2]) for r in rows if r[5] == ERROR and r[6])

    try:
        while query.isActive and not failed:
            take()
            time.sleep(poll_seconds)
    finally:
        query.stop()
    take()
    if query.exception() is not None:
        raise query.exception()
    if failed:
        what = ", ".join(f"{check} in batch {b}" for b, check in sorted(failed))
        raise StreamStopped(f"stream stopped by checks of severity {ERROR!r}: {what}")
    return read_or_empty(spark, log, LOG)


def violation_rows(log: DataFrame) -> DataFrame:
    """The violation log layout of what the batches of a stream failed."""
    failed = log.filter("violation_count > 0")
    message = F.format_string("%d of %d rows violated this assertion", "violation_count", "row_count_total")
    run = F.concat_ws("-", "run_id", F.col("batch_id").cast("string"))
    return failed.withColumns({"message": message, "run_id": run}).select(*TABLES["violations"].names)


def unlogged(log: DataFrame, committed: DataFrame) -> DataFrame:
    """Batches in ``committed`` (batch_id) that the log lacks, or has not all checks of."""
    full = log.groupBy("batch_id", "run_id").agg(F.count("*").alias("n"), F.max("n_checks").alias("of")).filter("n >= of")
    return committed.select("batch_id").distinct().join(full, "batch_id", "left_anti")
