"""Relational tables over JDBC, and one switch between JDBC and the lake.

Connection options (url, user, password, driver) come from the caller; none
are kept here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from boxtrail.sources.lake import lake_path, lake_read

WRITE_MODES = ("append", "overwrite", "ignore", "error")
BATCH_ROWS = 1000
FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Split:
    """How to cut a table into ranges that tasks read side by side."""

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def table_name(table: str, schema: str = "public") -> str:
    return table if schema == "public" else f"{schema}.{table}"


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    schema: str = "public",
    *,
    split: Split | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A whole table. Give a split, or one predicate per task where no numeric
    or date column cuts it evenly; without either one task reads it all."""
    name = table_name(table, schema)
    if predicates:
        options = dict(connection)
        url = options.pop("url")
        return spark.read.jdbc(
            url, name, predicates=list(predicates),
            properties={**options, "fetchsize": str(FETCH_ROWS)},
        )
    reader = spark.read.format("jdbc").options(**connection).option("fetchsize", FETCH_ROWS)
    if split:
        reader = reader.options(**split.options())
    return reader.option("dbtable", name).load()


def read_query(
    spark: SparkSession,
    connection: Mapping[str, str],
    query: str,
    *,
    split: Split | None = None,
) -> DataFrame:
    """The result of SQL text run in the database."""
    reader = spark.read.format("jdbc").options(**connection).option("fetchsize", FETCH_ROWS)
    if split is None:
        return reader.option("query", query).load()
    # Spark accepts a split only over a table expression
    return reader.options(**split.options()).option("dbtable", f"({query}) AS q").load()


def write_table(
    df: DataFrame,
    connection: Mapping[str, str],
    table: str,
    mode: str = "append",
    schema: str = "public",
    *,
    connections: int | None = None,
) -> None:
    """Write in batches; ``connections`` caps the number of parallel writers.
    Mode overwrite replaces the table rather than truncating it."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode {mode!r} is not one of {WRITE_MODES}")
    writer = (
        df.write.format("jdbc")
        .options(**connection)
        .option("dbtable", table_name(table, schema))
        .option("batchsize", BATCH_ROWS)
        .option("truncate", "false")
    )
    if connections:
        writer = writer.option("numPartitions", connections)
    writer.mode(mode).save()


def bound_query(
    spark: SparkSession, query: str, args: Mapping[str, object], **tables: DataFrame
) -> DataFrame:
    """SQL over frames, with named parameters bound and never pasted in.

    ``{name}`` in the text stands for a frame, ``:name`` for a parameter.
    """
    return spark.sql(query, args=dict(args), **tables)


@dataclass(frozen=True)
class Store:
    """Where named tables live: a lake root, or a database connection."""

    root: str | None = None
    connection: Mapping[str, str] | None = None

    def read(self, spark: SparkSession, table: str, **options) -> DataFrame:
        if self.connection is not None:
            return read_table(spark, self.connection, table, **options)
        return lake_read(spark, self._root(), table, **options)

    def append(self, df: DataFrame, table: str) -> None:
        if self.connection is not None:
            write_table(df, self.connection, table)
        else:
            df.write.mode("append").parquet(lake_path(self._root(), table))

    def _root(self) -> str:
        if self.root is None:
            raise ValueError("a store needs a root or a connection")
        return self.root
