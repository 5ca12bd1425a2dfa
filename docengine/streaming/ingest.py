"""Incremental ingest: new files -> raw table, each file exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docengine.operators.ingest import to_raw
from docengine.sources.files import stream_files


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (),
                  wait: bool = True, **trigger) -> StreamingQuery:
    """Append a stream to a Parquet table.

    By default takes all that is pending and stops; pass for example
    ``processingTime="1 minute"`` to keep running.  The checkpoint records the
    files taken and the sink the batches committed, so a rerun adds nothing.
    """
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
    if wait:
        query.awaitTermination()
    return query


def ingest_files(spark, source: str, table: str, checkpoint: str, batch_id: str, glob: str = "*.xml",
                 max_files: int | None = None, **trigger) -> StreamingQuery:
    """Run-to-completion ingest of a folder.

    ``ingest_date`` partitions the table, so that a daily job reads its own
    day; the raw bytes are a column no later join carries.
    """
    raw = to_raw(stream_files(spark, source, glob, max_files=max_files), batch_id)
    dated = raw.withColumn("ingest_date", F.to_date("ingest_timestamp"))
    return append_stream(dated, table, checkpoint, partition_by=("ingest_date",), **trigger)
