"""Raw files -> raw table rows, and the ingest summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.text import base_name, extract_id


def to_raw(
    df: DataFrame,
    batch_id: str,
    file_type: str = "xml",
    as_of: Column | None = None,
    id_patterns: tuple[str, ...] | None = None,
) -> DataFrame:
    """File rows (path, modificationTime, length, content) in the raw layout.

    Works on a batch and on a stream.  The content hash lets later stages
    notice a changed file without reading the bytes again.
    """
    path = F.col("file_path")
    return (
        df.withColumnsRenamed(
            {
                "path": "file_path",
                "content": "raw_bytes",
                "length": "file_size_bytes",
                "modificationTime": "file_modified_time",
            }
        )
        .withColumns(
            {
                "file_name": base_name(path),
                "file_type": F.lit(file_type),
                "source_url": F.lit(None).cast("string"),
                "set_id": extract_id(path, id_patterns) if id_patterns else extract_id(path),
                "ingest_timestamp": F.current_timestamp() if as_of is None else as_of.cast("timestamp"),
                "source_batch_id": F.lit(batch_id),
                "content_hash": F.sha2("raw_bytes", 256),
            }
        )
        .select(
            "file_path",
            "file_name",
            "file_type",
            "source_url",
            "set_id",
            "raw_bytes",
            "file_size_bytes",
            "file_modified_time",
            "ingest_timestamp",
            "source_batch_id",
            "content_hash",
        )
    )


def of_type(df: DataFrame, kind: str, type_col: str = "file_type", id_col: str = "set_id") -> DataFrame:
    return df.filter((F.col(type_col) == kind) & F.col(id_col).isNotNull())


def in_batch(df: DataFrame, batch_id: str, col: str = "source_batch_id") -> DataFrame:
    return df.filter(F.col(col) == batch_id)


def _distinct(col: str, approx: bool) -> Column:
    return F.approx_count_distinct(col) if approx else F.countDistinct(col)


def ingest_summary(
    raw: DataFrame,
    batch_id: str | None = None,
    batch_col: str = "source_batch_id",
    type_col: str = "file_type",
    size_col: str = "file_size_bytes",
    id_col: str = "set_id",
    time_col: str = "ingest_timestamp",
    approx: bool = False,
) -> DataFrame:
    """Files, megabytes, distinct ids and first / last time by batch and type."""
    rows = raw if batch_id is None else in_batch(raw, batch_id, batch_col)
    return rows.groupBy(batch_col, type_col).agg(
        F.count("*").alias("files_ingested"),
        F.round(F.sum(size_col) / 1e6, 2).alias("total_mb"),
        _distinct(id_col, approx).alias("unique_labels"),
        F.min(time_col).alias("first_file"),
        F.max(time_col).alias("last_file"),
    )


def daily_health(
    raw: DataFrame,
    type_col: str = "file_type",
    size_col: str = "file_size_bytes",
    id_col: str = "set_id",
    time_col: str = "ingest_timestamp",
    approx: bool = False,
) -> DataFrame:
    """The same by day and type, newest day first."""
    return (
        raw.groupBy(F.to_date(time_col).alias("ingest_date"), type_col)
        .agg(
            F.count("*").alias("files"),
            F.round(F.sum(size_col) / 1e6, 1).alias("total_mb"),
            _distinct(id_col, approx).alias("unique_labels"),
        )
        .orderBy(F.desc("ingest_date"), type_col)
    )


def last_loaded(df: DataFrame, time_col: str) -> DataFrame:
    """Newest load time, NULL for an empty table."""
    return df.agg(F.max(F.col(time_col).cast("timestamp")).alias("last_loaded_at"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()
