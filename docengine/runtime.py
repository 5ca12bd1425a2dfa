"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that change results (time zone) or that the operators rely on at
# scale (adaptive re-planning, splitting of skewed join partitions).  Sizing
# such as spark.sql.shuffle.partitions belongs to the cluster, not here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join followed by an aggregate on the same key may still split its
    # skewed partitions, at the price of one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Documents and vectors are large rows: bound an Arrow batch in bytes too.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
}
# Read when a session starts: no call-site capture for every Column in Python.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def session(app: str = "docengine", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **START_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the engine's settings to a session made by somebody else."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per Spark context.

    Functions that run there are pickled by reference, so executors that have
    no installed copy need the modules.
    """
    context = spark.sparkContext
    if getattr(context, "_docengine_shipped", False):
        return
    package = Path(__file__).resolve().parent
    if package.is_dir():  # not when the package itself was imported from an archive
        # Local executors read the archive from where it was added, so it stays until the process ends.
        folder = tempfile.mkdtemp(prefix=f"{package.name}-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = f"{folder}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*")):
                if f.is_file() and "__pycache__" not in f.parts:
                    z.write(f, f.relative_to(package.parent))
        context.addPyFile(archive)
    context._docengine_shipped = True


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's checkpoint folder.

    A session without one uses a folder under its warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    # The warehouse is shared too, wherever tables can be saved at all.
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder; what is written there goes when the driver's JVM ends."""
    folder = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    fs, path = hadoop_path(spark, folder)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/data"


def materialize(df: DataFrame, label: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cached block the Parquet copy outlives lost executors, and later
    branches read only the columns and row groups they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialized(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """``materialize`` whose copy is dropped when the block ends."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_path(df.sparkSession, path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) pair for any store Spark can reach."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_path(spark, path)
    fs.delete(jpath, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())
