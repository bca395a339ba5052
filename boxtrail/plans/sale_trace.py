"""Sale traceability: open sales to result tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from boxtrail.operators.sales import (
    explode_sale_boxes,
    oldest_unprocessed,
    proc_animal,
    proc_projection,
    proc_property,
    proc_sale_header,
    proc_sale_property,
    sale_lineage,
    traced_sales,
)
from boxtrail.operators.transitions import mark_sales_processed


class SaleTrace(NamedTuple):
    rows: DataFrame
    headers: DataFrame
    properties: DataFrame
    animals: DataFrame
    sale_properties: DataFrame
    sales: DataFrame


def sale_rows(
    sales, boxes, deboning, properties, animals,
    grupo_id=None, token=None, limit: int | None = None, now: Column | None = None,
    tenant_scoped: bool = False,
) -> DataFrame:
    """One row per box sold in the chosen sales, with its lineage."""
    if grupo_id is None and token is None:
        raise ValueError("give a group or a tenant")
    chosen = oldest_unprocessed(sales, grupo_id, token, limit)
    lineage = sale_lineage(
        explode_sale_boxes(chosen), boxes, deboning, properties, animals, tenant_scoped
    )
    return proc_projection(lineage, now)


def sale_trace(
    sales, boxes, deboning, properties, animals,
    grupo_id=None, token=None, limit: int | None = None, now: Column | None = None,
    materialise=lambda rows: rows, tenant_scoped: bool = False,
) -> SaleTrace:
    """All result frames of one run.

    They all read ``rows``. A job passes ``materialise`` to write it once as a
    table; without it each frame computes the lineage again.
    """
    rows = materialise(
        sale_rows(
            sales, boxes, deboning, properties, animals, grupo_id, token, limit, now, tenant_scoped
        )
    )
    return SaleTrace(
        rows=rows,
        headers=proc_sale_header(rows, now),
        properties=proc_property(rows),
        animals=proc_animal(rows, now),
        sale_properties=proc_sale_property(rows),
        sales=mark_sales_processed(sales, traced_sales(rows), now),
    )
