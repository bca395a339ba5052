"""A file lake: tables by path under one root, in CSV, Parquet or JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from boxtrail.schemas import LAKE_FORMATS, LAKE_PARTITIONS
from boxtrail.sources.json_files import FILE, list_files
from boxtrail.sources.listing import partition_folders

_DEFAULTS = {"csv": {"header": True}, "parquet": {}, "json": {}}


def lake_path(root: str, relative: str) -> str:
    return f"{root.rstrip('/')}/{relative.lstrip('/')}"


def _format(fmt: str) -> str:
    fmt = fmt.lower()
    if fmt not in LAKE_FORMATS:
        raise ValueError(f"format {fmt!r} is not supported; use one of {LAKE_FORMATS}")
    return fmt


def lake_read(
    spark: SparkSession,
    root: str,
    relative: str,
    fmt: str = "parquet",
    *,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Read a table; ``columns`` prunes the scan. CSV has a header by default."""
    fmt = _format(fmt)
    reader = spark.read.format(fmt).options(**{**_DEFAULTS[fmt], **options})
    if schema is not None:
        reader = reader.schema(schema)
    path = lake_path(root, relative)
    try:
        df = reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    return df.select(*columns) if columns else df


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything under a path."""
    try:
        spark.read.schema("x int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def lake_write(
    df: DataFrame, root: str, relative: str, fmt: str = "csv", mode: str = "overwrite", **options
) -> str:
    fmt = _format(fmt)
    path = lake_path(root, relative)
    df.write.format(fmt).options(**{**_DEFAULTS[fmt], **options}).mode(mode).save(path)
    return path


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = LAKE_PARTITIONS,
    fmt: str = "parquet",
    mode: str = "append",
    dynamic: bool = False,
) -> None:
    """Write a hive-style layout.

    The rebalance hint groups rows by partition for few files each, and lets
    the runtime cut a partition that is too large over several tasks.
    Mode overwrite replaces the whole table, or with ``dynamic`` only the
    partitions the rows fall in, whatever the session's setting.
    """
    writer = df.hint("rebalance", *[F.col(c) for c in partitions]).write
    writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.format(_format(fmt)).mode(mode).partitionBy(*partitions).save(path)


def by_day(df: DataFrame, day: str) -> DataFrame:
    """Add the year, month and day partition columns of a date column."""
    return df.withColumns({
        "ano": F.year(day), "mes": F.month(day), "dia": F.dayofmonth(day),
    })


def list_partitions(
    spark: SparkSession, path: str, partitions: Sequence[str] = LAKE_PARTITIONS, kind: str = "int"
) -> DataFrame:
    """The partitions of a table by folder name; its files are not looked at."""
    return partition_folders(spark, path, dict.fromkeys(partitions, kind))


def file_inventory(
    spark: SparkSession, root: str, prefix: str = "", search: str | None = None
) -> DataFrame:
    """Files under a prefix, at any depth; ``search`` is a part of the path
    below the root."""
    base = lake_path(root, "")
    files = list_files(spark, lake_path(root, prefix), recursive=True)
    below = F.element_at(F.split(F.col(FILE), F.lit(_literal(base)), 2), -1)
    files = files.withColumn("caminho", below)
    return files if search is None else files.filter(F.col("caminho").contains(search))


def _literal(text: str) -> str:
    """The text as a regular expression that matches only itself."""
    return r"\Q" + text + r"\E"
