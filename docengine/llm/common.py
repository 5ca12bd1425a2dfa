"""Inputs and intermediate tables shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.runtime import apply_settings, delete_path, hadoop_path, work_dir

BATCH_SETTINGS = {
    # Texts have no length limit: bound what one Arrow batch holds in bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16MB",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def prepare(spark: SparkSession) -> SparkSession:
    apply_settings(spark)
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): the two columns the operators read; a null text is an empty one.

    Other columns of ``docs`` may have any name: they are left behind here.
    """
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, or one made from it that no column of ``docs`` has in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


_opened: ContextVar[list | None] = ContextVar("opened", default=None)


@contextmanager
def scratch_closed() -> Iterator[None]:
    """Drop the tables of every ``Scratch`` opened inside, at the end: for work whose result has been written by then."""
    token = _opened.set([])
    try:
        yield
    finally:
        for scratch in _opened.get():
            scratch.close()
        _opened.reset(token)


class Scratch:
    """Intermediate tables in the folder that all executors share.

    A written table outlives lost executors, cuts the lineage, and is read
    column by column.  Tables are dropped with ``drop``; what is still there
    when the driver's JVM ends is removed by it.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root = spark, f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
        fs, path = hadoop_path(spark, self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        if _opened.get() is not None:
            _opened.get().append(self)

    def close(self) -> None:
        delete_path(self.spark, self.root)

    def write(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.root}/{name}"
        (df.write.mode("errorifexists").option("compression", "zstd")
         .partitionBy(*partition_by).parquet(path))
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, name: str, column: str, parts: int) -> DataFrame:
        """A table bucketed by ``column``: what is joined to it by that column comes to it."""
        label = f"{name}_{uuid.uuid4().hex}"
        (df.write.option("compression", "zstd").option("parquet.block.size", 32 << 20)
         .option("path", f"{self.root}/{name}").bucketBy(parts, column).saveAsTable(label))
        return self.spark.table(label)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, f"{self.root}/{name}")


def shards(spark: SparkSession) -> int:
    """Parts of a key that may be hot: as many as the cluster has shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit integers (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def ascending(x: np.ndarray) -> np.ndarray:
    """Distinct values in ascending order, by a plain sort."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def text_column(record: pa.RecordBatch, name: str = "text") -> list:
    return record.column(record.schema.get_field_index(name)).to_pylist()


def small_side(df: DataFrame, row_bytes: int, limit: int = 16 << 20) -> DataFrame:
    """``df``, to be sent to every task if its counted rows fit ``limit``; else joined by a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished work go: Spark drops them once both sides have forgotten its plans."""
    gc.collect()
    spark._jvm.System.gc()


def sorted_ranges(values: np.ndarray, shift: int) -> Iterator[tuple[int, int, int]]:
    """(range, first, last) of ascending 64-bit values by their bits from ``shift`` on."""
    ranges = values >> np.uint64(shift) if shift < 64 else np.zeros(len(values), np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]])) if len(ranges) else np.zeros(0, int)
    for a, z in zip(starts, [*starts[1:], len(ranges)]):
        yield int(ranges[a]), int(a), int(z)
