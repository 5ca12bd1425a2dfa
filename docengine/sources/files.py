"""Raw file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the columns of Spark's binary file source.
FILE_DDL = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_files(spark: SparkSession, path: str, glob: str = "*.xml", recursive: bool = True,
                 max_files: int | None = None) -> DataFrame:
    """Unbounded rows, one per file that matches, existing files first."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_DDL)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_files(spark: SparkSession, path: str, glob: str = "*.xml", recursive: bool = True) -> DataFrame:
    """The same rows as a batch."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )


def stream_table(spark: SparkSession, where: str, name: str, schema=None,
                 max_files: int | None = None) -> DataFrame:
    """A Parquet table as a stream, whether it is one file or a folder of files."""
    path = f"{where.rstrip('/')}/{name}.parquet"
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A glob, as the stream source does not take the path of a single file.
    return reader.parquet(path[:-1] + "[t]")
