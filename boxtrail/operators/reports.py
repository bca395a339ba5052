"""Status, distribution and profile reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from boxtrail.functions.flags import all_true
from boxtrail.operators.filters import in_scope
from boxtrail.schemas import (
    LABEL_COMPLETE,
    LABEL_LINKED_ONLY,
    LABEL_OTHER,
    LABEL_UNLINKED,
)


def _traceable_counts() -> list[Column]:
    flag = F.col("flag_rastreavel")
    return [
        F.count(F.lit(1)).alias("total_caixas"),
        F.count_if(flag).alias("caixas_rastreaveis"),
        F.count_if(~flag).alias("caixas_nao_rastreaveis"),
        F.count_if(flag.isNull()).alias("caixas_flag_null"),
    ]


def flag_status(boxes: DataFrame, token: str | None = None) -> DataFrame:
    return boxes.filter(in_scope(token)).groupBy("token_cliente").agg(*_traceable_counts())


def completeness_status(boxes: DataFrame, token: str | None = None) -> DataFrame:
    return (
        boxes.filter(in_scope(token))
        .groupBy("token_cliente")
        .agg(
            F.count(F.lit(1)).alias("total_caixas"),
            F.count_if(all_true()).alias("caixas_completas"),
            F.count_if(F.col("flag_rastreavel")).alias("caixas_rastreaveis"),
        )
    )


def flag_label() -> Column:
    """The first label that holds; a NULL test counts as not holding."""
    linked, prop, animal = (
        F.col(c) for c in ("flag_desossa", "flag_propriedades", "flag_animais")
    )
    return (
        F.when(linked & prop & animal, LABEL_COMPLETE)
        .when(linked & (~prop | ~animal), LABEL_LINKED_ONLY)
        .when(~linked, LABEL_UNLINKED)
        .otherwise(LABEL_OTHER)
    )


def flag_relationship(boxes: DataFrame, token: str | None = None) -> DataFrame:
    return (
        boxes.filter(in_scope(token))
        .groupBy(flag_label().alias("status_flags"))
        .agg(*_traceable_counts())
        .orderBy("status_flags")
    )


def value_distribution(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; equal counts by value."""
    counts = (
        df.groupBy(F.col(column).alias("valor"))
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.col("total").desc(), F.col("valor").asc_nulls_last())
    )
    return counts if top is None else counts.limit(top)


def top_n(df: DataFrame, by: str, n: int) -> DataFrame:
    """The n largest rows by a column; ties by the other columns."""
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c != by]
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table and column: type, rows and NULLs. Each table is read once, whatever
    its width; `distinct_counts` adds the different values."""
    parts = []
    for name, df in tables.items():
        entries = []
        for field in df.schema:
            column = F.col(f"`{field.name}`")
            values = [
                F.lit(field.name).alias("coluna"),
                F.lit(field.dataType.simpleString()).alias("tipo"),
                F.count_if(column.isNull()).alias("n_nulos"),
            ]
            entries.append(F.struct(*values))
        one = df.agg(F.count(F.lit(1)).alias("n_linhas"), F.array(*entries).alias("colunas"))
        parts.append(
            one.select(F.lit(name).alias("tabela"), "n_linhas", F.inline("colunas"))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def table_ranking(tables: Mapping[str, DataFrame], top: int = 5) -> DataFrame:
    """The tables with the most rows."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_linhas")).select(
            F.lit(name).alias("tabela"), "n_linhas"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return top_n(out, "n_linhas", top)


def table_sample(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The n rows with the smallest hashes of their keys: any row is as likely, and the
    same ones are taken every time. Each task keeps n rows before they meet."""
    key = F.concat_ws("-", *[F.col(k).cast("string") for k in keys])
    hashed = df.withColumn("_h", F.sha2(key, 256))
    return hashed.orderBy("_h", *keys).limit(n).drop("_h")


#: Registers of a distinct count sketch, as a power of two; the error is 0.4%.
SKETCH_BITS = 16


def _sketched(kind: T.DataType, column: Column) -> Column:
    """A value that a sketch can take and that is equal for equal values."""
    if isinstance(kind, (T.StringType, T.IntegerType, T.LongType, T.BinaryType)):
        return column
    return F.when(column.isNotNull(), F.to_json(F.struct(column)))


def distinct_sketches(tables: Mapping[str, DataFrame], bits: int = SKETCH_BITS) -> DataFrame:
    """Per table and column a sketch of its values. Each table is read once. Sketches
    of parts of a table, kept from earlier runs, can be merged."""
    parts = []
    for name, df in tables.items():
        entries = [
            F.struct(
                F.lit(f.name).alias("coluna"),
                F.hll_sketch_agg(_sketched(f.dataType, F.col(f"`{f.name}`")), bits).alias("esboco"),
            )
            for f in df.schema
        ]
        one = df.agg(F.array(*entries).alias("colunas"))
        parts.append(one.select(F.lit(name).alias("tabela"), F.inline("colunas")))
    return reduce(DataFrame.unionByName, parts)


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """About how many different values each column has, over all sketches of it."""
    merged = F.hll_union_agg("esboco")
    return sketches.groupBy("tabela", "coluna").agg(
        F.hll_sketch_estimate(merged).alias("n_distintos_aprox")
    )


def log_metrics(log: DataFrame) -> DataFrame:
    return log.groupBy("tipo_payload", "camada", "status").agg(
        F.count(F.lit(1)).alias("execucoes"),
        F.sum("duracao_ms").alias("duracao_total_ms"),
        F.avg("duracao_ms").alias("duracao_media_ms"),
        F.sum("registros_processados").alias("registros_processados"),
        F.sum("registros_invalidos").alias("registros_invalidos"),
    )


def latest_log_rows(log: DataFrame, n: int = 10) -> DataFrame:
    return log.orderBy(F.col("data_hora").desc_nulls_last(), F.col("id").desc()).limit(n)
