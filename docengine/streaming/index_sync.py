"""Similarity index kept in step with its source by micro-batches.

The index is a log of changes: every micro-batch writes the vectors of its
changed keys under ``batch=<n>``, with the value that orders the changes of a
key.  Readers take the row of each key that is last in that order, whichever
batch brought it; ``compact`` folds the log into one base.  A deleted key
stays as a row without vector, so that a change from before its deletion does
not bring it back.  A batch that is retried overwrites its own folder, so each
change counts once, and nothing but the changed rows is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docengine.operators.changes import DELETE
from docengine.operators.model import best_row
from docengine.runtime import delete_path, list_dirs, path_exists

Encoder = Callable[[DataFrame], DataFrame]


ORDER = "changed_at"


def write_changes(changes: DataFrame, encoder: Encoder, path: str, batch: int, key: str = "chunk_id",
                  *, order: str, cols: Sequence[str] = (), op_col: str | None = None) -> None:
    """Encode the changed rows of one batch and write them as ``batch=<n>``.

    Several changes of a key inside the batch: the last by ``order`` counts.
    Deleted rows are written without passing the encoder, which may drop rows
    that have no text.
    """
    gone = F.coalesce(F.col(op_col) == DELETE, F.lit(False)) if op_col else F.lit(False)
    rows = best_row(changes.withColumn("deleted", gone), [key], [F.desc(order), F.desc("deleted")])
    shown = [key, *[c for c in cols if c != key]]
    kept = encoder(rows.filter(~F.col("deleted"))).select(*shown, "embedding", F.col(order).alias(ORDER), "deleted")
    vector = kept.schema["embedding"].dataType
    deleted = rows.filter("deleted").select(
        *shown, F.lit(None).cast(vector).alias("embedding"), F.col(order).alias(ORDER), "deleted")
    out = kept.unionByName(deleted).withColumn("batch_no", F.lit(batch).cast("bigint"))
    out.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def _committed(spark: SparkSession, path: str, kind: str) -> list[int]:
    found = [int(d.split("=")[1]) for d in list_dirs(spark, path) if d.startswith(f"{kind}=")]
    return sorted(n for n in found if path_exists(spark, f"{path}/{kind}={n}/_SUCCESS"))


def _newest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Last row of every key by its order, deleted ones included.

    The base holds each key once; its rows are compared with the log for the
    keys that changed since, and the vectors of the others are not shuffled
    while those keys are few.
    """
    bases = _committed(spark, path, "base")
    since = [n for n in _committed(spark, path, "batch") if not bases or n > bases[-1]]
    if not bases and not since:
        raise FileNotFoundError(f"no committed batch under {path}")
    base = spark.read.parquet(f"{path}/base={bases[-1]}") if bases else None
    if not since:
        return base
    # One scan, however many batches there are.
    log = spark.read.parquet(*[f"{path}/batch={n}" for n in since])
    last = [F.desc(ORDER), F.desc("batch_no")]
    if base is None:
        return best_row(log, [key], last)
    changed = log.select(F.col(key).alias("_changed")).distinct()
    same = F.col(key) == F.col("_changed")
    touched = best_row(log.unionByName(base.join(changed, same, "left_semi")), [key], last)
    return touched.unionByName(base.join(changed, same, "left_anti"))


def current_index(spark: SparkSession, path: str, key: str = "chunk_id") -> DataFrame:
    """Newest row of every key that has not been deleted."""
    return _newest(spark, path, key).filter(~F.col("deleted")).drop("batch_no", "deleted", ORDER)


def compact(spark: SparkSession, path: str, key: str = "chunk_id", forget_before=None) -> int:
    """Fold the log into ``base=<n>``, which stands for all batches up to n.

    The folded copy is committed before anything is removed, and readers pass
    from the batches to the base in one step.  Deleted keys stay in the base;
    those whose order lies before ``forget_before``, from when on no late
    change is expected, leave it.
    """
    bases, known = _committed(spark, path, "base"), _committed(spark, path, "batch")
    newest = max([*bases, *known])
    if newest not in bases:
        folded = _newest(spark, path, key)
        if forget_before is not None:
            folded = folded.filter(~F.col("deleted") | (F.col(ORDER) >= F.lit(forget_before)))
        folded.write.mode("overwrite").parquet(f"{path}/base={newest}")
    for kind, numbers in (("batch", known), ("base", bases)):
        for n in numbers:
            if n < newest or (kind == "batch" and n == newest):
                delete_path(spark, f"{path}/{kind}={n}")
    return newest


def sync_index_stream(source: DataFrame, encoder: Encoder, path: str, checkpoint: str,
                      key: str = "chunk_id", *, order: str, cols: Sequence[str] = (),
                      op_col: str | None = None, continuous: bool = False,
                      interval: str = "1 minute", wait: bool = True) -> StreamingQuery:
    """Keep the index in step with a stream of changed rows.

    Triggered: take what is pending and stop.  Continuous: a micro-batch every
    ``interval``.
    """

    def apply(batch: DataFrame, n: int) -> None:
        write_changes(batch, encoder, path, n, key, order=order, cols=cols, op_col=op_col)

    trigger = {"processingTime": interval} if continuous else {"availableNow": True}
    query = (
        source.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    if wait and not continuous:
        query.awaitTermination()
    return query
