"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "boxtrail", master: str | None = None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="boxtrail-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, visible to every executor.

    The folder is the one named in ``spark.checkpoint.dir``. Only a local
    session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_scratch()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df, name: str):
    """Write a frame that several consumers read, and read it back.

    This cuts the lineage with a table that survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
