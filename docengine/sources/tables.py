"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docengine.runtime import hadoop_path, list_dirs, path_exists
from docengine.schemas import empty, ensure_schema


def read_table(spark: SparkSession, where: str, name: str | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Parquet table by path or folder + name; anything without a slash is a catalog table.

    A declared ``schema`` saves the job that would infer it.
    """
    if name is None and "/" not in where:
        return spark.table(where)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(where if name is None else f"{where.rstrip('/')}/{name}.parquet")


def lookup_df(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Small in-memory relation with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def append_table(df: DataFrame, path: str, schema: T.StructType | None = None,
                 partition_by: Sequence[str] = ()) -> None:
    """Add rows; conform to ``schema`` first when one is declared."""
    out = ensure_schema(df, schema) if schema is not None else df
    out.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Declared-schema read that is empty before the first write.

    Files written under an older, narrower schema read as NULL in the new
    columns.
    """
    if not path_exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path)


class Snapshots:
    """A table kept as whole versions ``v=1, v=2, ..`` under one folder.

    A new version is written beside the one being read, never over it, and
    counts once its write has been committed; a failed write leaves the
    readers on the version before.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _dir(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = [int(d[2:]) for d in list_dirs(self.spark, self.path) if d.startswith("v=") and d[2:].isdigit()]
        return sorted(v for v in found if path_exists(self.spark, f"{self._dir(v)}/_SUCCESS"))

    def read(self, version: int | None = None) -> DataFrame:
        known = self.versions()
        if version is None and not known:
            return empty(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(self._dir(version or known[-1]))

    def write(self, df: DataFrame) -> int:
        """Replace the table's rows (and its columns, when the schema has changed)."""
        known = self.versions()
        version = known[-1] + 1 if known else 1
        # Overwrite clears what a failed attempt may have left in this version.
        ensure_schema(df, self.schema).write.mode("overwrite").parquet(self._dir(version))
        return version

    def keep_last(self, n: int) -> None:
        """Drop all but the newest ``n`` committed versions."""
        for version in self.versions()[:-n]:
            fs, path = hadoop_path(self.spark, self._dir(version))
            fs.delete(path, True)
