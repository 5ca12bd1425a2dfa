"""Streams whose columns and types grow from run to run, in one Parquet table."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docengine.runtime import path_exists
from docengine.schemas import empty
from docengine.streaming.ingest import append_stream

# Types that Spark's Parquet reader reads as a wider one, narrow to wide.
WIDER: tuple[tuple[T.DataType, ...], ...] = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()),
    (T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType()),
)


class CannotWiden(ValueError):
    """Two types that no reader can bring together without loss."""


def wider_type(a: T.DataType, b: T.DataType, where: str = "") -> T.DataType:
    """The type that holds all values of both."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return wider_schema(a, b, where)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider_type(a.elementType, b.elementType, f"{where}[]"), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider_type(a.keyType, b.keyType, f"{where}.key"),
                         wider_type(a.valueType, b.valueType, f"{where}.value"), a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    for chain in WIDER:
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    raise CannotWiden(f"{where or 'column'}: {a.simpleString()} and {b.simpleString()}")


def wider_schema(a: T.StructType, b: T.StructType, where: str = "") -> T.StructType:
    """All columns of both, those of ``a`` first, all nullable; names as in ``a`` (their case does not matter)."""
    new = {f.name.lower(): f for f in b.fields}
    out = []
    for f in a.fields:
        other = new.pop(f.name.lower(), None)
        kind = f.dataType if other is None else wider_type(f.dataType, other.dataType, f"{where}.{f.name}".lstrip("."))
        out.append(T.StructField(f.name, kind, True))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in new.values()])


def _declared(path: str) -> str:
    return f"{path.rstrip('/')}.schemas"


def widened_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """What all writers of the table so far have declared together; None before the first."""
    # One row per start of a stream with new columns, in the order of their starts.
    rows = _declarations(spark, path)
    known = [T.StructType.fromJson(json.loads(r.declared)) for r in sorted(rows)]
    return reduce(wider_schema, known) if known else None


def _declarations(spark: SparkSession, path: str) -> list:
    if not path_exists(spark, _declared(path)):
        return []
    return spark.read.schema("number LONG, declared STRING, checkpoint STRING").json(_declared(path)).distinct().collect()


def append_widening(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), **options):
    """Append a stream whose schema may be narrower or wider than what the table holds.

    Files keep the types they are written with; nothing is rewritten.  Before
    the stream starts, its schema is added to the declared ones beside the
    table, unless they hold it already; types that cannot be brought together
    raise ``CannotWiden`` and write nothing.  A table belongs to one
    checkpoint, since the sink knows finished batches by their number alone
    and would pass over those of a second one; another is refused.
    """
    spark = df.sparkSession
    others = {r.checkpoint for r in _declarations(spark, path)} - {checkpoint}
    if others:
        raise ValueError(f"{path} is written by the stream of {', '.join(sorted(others))}")
    before = widened_schema(spark, path)
    after = df.schema if before is None else wider_schema(before, df.schema)
    if before is None or after != before:
        spark.createDataFrame([(0 if before is None else len(after.fields), after.json(), checkpoint)],
                              "number LONG, declared STRING, checkpoint STRING").coalesce(1).write.mode("append").json(_declared(path))
    return append_stream(df, path, checkpoint, tuple(partition_by), **options)


def read_widened(spark: SparkSession, path: str) -> DataFrame:
    """The table in its widest schema: older files give NULL for columns they lack, narrow types are widened by the scan.

    Filters and column lists reach the scan as for any Parquet table.  A table
    that was declared but not written yet is empty.
    """
    schema = widened_schema(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no declared schema beside {path}")
    if not path_exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path)
