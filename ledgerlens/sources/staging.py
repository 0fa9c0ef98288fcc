"""Written intermediate tables and size-checked broadcasts.

A staged table cuts lineage with files that outlive a lost executor, and it is computed once
however often the plan above it reads it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024


def checkpoint_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only local sessions may do without: they get one below
    the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    spark.sparkContext.setCheckpointDir(f"{warehouse}/staging")
    return spark.sparkContext.getCheckpointDir()


def staging_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark)}/ledgerlens/{app}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what this application has staged. Tables that still read it are lost, so call it
    when a job's results are written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{checkpoint_root(spark)}/ledgerlens/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query are dropped as soon as it has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unstaged(table: DataFrame) -> None:
    """Delete the staged tables that a table reads, which must not be read again. Files that this
    application has not staged are left alone."""
    spark = table.sparkSession
    own = f"/ledgerlens/{spark.sparkContext.applicationId}/"
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        if own in folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame):
    """Column expression: a generous estimate of a row's size in memory."""
    size = F.lit(32 + 16 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif not isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType)):
            text = F.to_json(F.struct(F.col(f"`{field.name}`")))
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
    return size


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a table that is cheap to read (staged, or a small file) before broadcasting it."""
    size = table.agg(F.sum(row_bytes(table).cast("long")).alias("bytes")).first()["bytes"]
    return (size or 0) <= limit


def checked_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the measured size allows it; else the plain table for a shuffled join."""
    return F.broadcast(table) if fits_broadcast(table, limit) else table
