"""State changes as column rewrites: a table in, the whole table out.

Nothing is updated in place. The caller writes the result back, replacing
the tenant and month partitions it covers.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from boxtrail.functions.flags import all_true, any_pending, is_pending
from boxtrail.functions.rewrite import now_or, set_where
from boxtrail.operators.filters import in_scope
from boxtrail.operators.lookups import left_lookup
from boxtrail.schemas import STAGE_FLAGS


def mark_for_processing(boxes, token, start, end, now=None) -> DataFrame:
    """Open every box of the period that still lacks a link."""
    return set_where(
        boxes,
        in_scope(token, start, end) & any_pending(),
        {"flag_processamento": F.lit(False), "updated_at": now_or(now)},
    )


def reset_flags(boxes, token, start=None, end=None, now=None) -> DataFrame:
    """Start over: four flags false. The traceable flag is left alone."""
    values = {f: F.lit(False) for f in ("flag_processamento", *STAGE_FLAGS)}
    return set_where(boxes, in_scope(token, start, end), {**values, "updated_at": now_or(now)})


def mark_processed(boxes, ids: DataFrame, flags: Mapping[str, bool], now=None) -> DataFrame:
    """Close the boxes whose id is listed and set the given flags on them.

    ``ids`` is a frame with an ``id`` column, never a list on the driver.
    ``flag_processamento`` becomes true whatever the caller passes for it.
    """
    listed = ids.select("id").distinct().withColumn("_listed", F.lit(True))
    values = {f: F.lit(v) for f, v in flags.items() if f != "flag_processamento"}
    values |= {"flag_processamento": F.lit(True), "updated_at": now_or(now)}
    joined = left_lookup(boxes, listed, {"id": F.col("id")}, ["_listed"])
    return set_where(joined, F.col("_listed").isNotNull(), values).drop("_listed")


def touch_period(boxes, token, start, end, now=None) -> DataFrame:
    return set_where(boxes, in_scope(token, start, end), {"updated_at": now_or(now)})


def traceable_now(token: str | None) -> Column:
    return in_scope(token) & all_true() & is_pending("flag_rastreavel")


def set_traceable(boxes, token, now=None) -> DataFrame:
    """Complete boxes become traceable. The flag is never taken back."""
    return set_where(
        boxes, traceable_now(token), {"flag_rastreavel": F.lit(True), "updated_at": now_or(now)}
    )


def mark_sales_processed(sales, sale_ids: DataFrame, now=None, stamp: bool = True) -> DataFrame:
    """Close the sales whose id is listed (column ``registro_id``)."""
    listed = sale_ids.select(F.col("registro_id").alias("id")).distinct()
    listed = listed.withColumn("_listed", F.lit(True))
    values = {"flag_processada": F.lit(True)}
    if stamp:
        values["data_hora_processada"] = now_or(now)
    joined = left_lookup(sales, listed, {"id": F.col("id")}, ["_listed"])
    return set_where(joined, F.col("_listed").isNotNull(), values).drop("_listed")


def mark_sales_by_tenant(sales, token, limit: int, now=None) -> DataFrame:
    """Close up to ``limit`` open sales of a tenant, oldest first."""
    open_sales = (F.col("token_cliente") == F.lit(token)) & (
        F.col("flag_processada") == F.lit(False)
    )
    chosen = (
        sales.filter(open_sales)
        .orderBy(F.col("created_at").asc_nulls_last(), F.col("id"))
        .limit(limit)
        .select(F.col("id").alias("_chosen"))
    )
    hit = F.col("_chosen").isNotNull()
    joined = sales.join(chosen, sales["id"] == F.col("_chosen"), "left")
    values = {"flag_processada": F.lit(True), "data_hora_processada": now_or(now)}
    return set_where(joined, hit, values).drop("_chosen")


# --- generic row operations -------------------------------------------------


def equals(condition: Mapping[str, object]) -> Column:
    """All columns equal to the given values; NULL never matches."""
    if not condition:
        raise ValueError("a condition needs at least one column")
    match = F.lit(True)
    for name, value in condition.items():
        match = match & (F.col(name) == F.lit(value))
    return F.coalesce(match, F.lit(False))


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(rows, allowMissingColumns=True)


def update_where(table, condition: Mapping[str, object], data: Mapping[str, object]) -> DataFrame:
    types = {f.name: f.dataType for f in table.schema}
    return set_where(
        table, equals(condition), {c: F.lit(v).cast(types[c]) for c, v in data.items()}
    )


def delete_where(table, condition: Mapping[str, object]) -> DataFrame:
    return table.filter(~equals(condition))


def affected(table, condition: Mapping[str, object]) -> DataFrame:
    """One row: how many rows an update or delete with this condition reaches."""
    return table.agg(F.count_if(equals(condition)).alias("n_linhas"))
