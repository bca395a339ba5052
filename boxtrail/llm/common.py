"""What the operators share: tables, Arrow batches, scratch tables."""

from __future__ import annotations

import ctypes
import os
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxtrail.session import scratch_path

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Name of the packed copy of a row's own columns while an operator adds its own.
ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose executors lack that folder, pass the package with --py-files.
    Unless set otherwise, Arrow batches get fewer rows, as texts are large.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and all."""
    return df[f"`{name}`"]


def texts(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Columns `doc_id` and `text` alone; a null text is empty."""
    return df.select(
        column(df, id_column).alias("doc_id"),
        F.coalesce(column(df, text_column).cast("string"), F.lit("")).alias("text"),
    )


def packed(df: DataFrame) -> Column:
    """All columns as one, so that no name of theirs clashes with an operator's."""
    return F.struct(*[column(df, c).alias(c) for c in df.columns]).alias(ROW)


def unpacked(df: DataFrame, like: DataFrame, **new: Column) -> DataFrame:
    """The columns of `like` from their packed copy; `new` replaces some of them."""
    row = F.col(ROW)
    return df.select(
        *[(new[c] if c in new else row.getField(c)).alias(c) for c in like.columns]
    )


def release() -> None:
    """Give memory that this Python worker has freed back to the system.

    Workers serve many stages; what the largest of them took would stay with them.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries lack it
    if trim:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several jobs read to the shared folder, and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

