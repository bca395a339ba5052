"""Box traceability: the link stages in sequence, as one plan over the boxes.

Each function takes the boxes and returns all of them in their new state.
Rows a stage does not touch keep their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxtrail.functions.flags import any_pending, is_true
from boxtrail.functions.rewrite import now_or, set_where
from boxtrail.operators.filters import (
    in_scope,
    lacks_deboning,
    lacks_origin,
    linked_boxes,
    require_period,
)
from boxtrail.operators.link import link_deboning, link_origin
from boxtrail.operators.merge import dedup_by_id, schema_align, upsert
from boxtrail.operators.transitions import (
    mark_for_processing,
    reset_flags,
    set_traceable,
)

MODES = ("completo", "desossa", "propriedades", "proc-caixas")


def _split(boxes: DataFrame, chosen: Column) -> tuple[DataFrame, DataFrame]:
    """Rows the predicate holds for, and the rest. It must not be NULL."""
    chosen = F.coalesce(chosen, F.lit(False))
    return boxes.filter(chosen), boxes.filter(~chosen)


def trace_deboning(
    boxes, deboning, token, start=None, end=None, *, tenant_scoped=None, now=None
) -> DataFrame:
    """Stage 1: link the boxes that have no deboning order yet."""
    work, rest = _split(boxes, in_scope(token, start, end) & lacks_deboning())
    linked = link_deboning(work, deboning, tenant_scoped=tenant_scoped, now=now)
    return linked.unionByName(rest)


def trace_origin(
    boxes, schedule, animals, token, start=None, end=None, *, tenant_scoped=None, now=None
) -> DataFrame:
    """Stage 2: link boxes with a deboning order to schedule and animals."""
    work, rest = _split(boxes, in_scope(token, start, end) & lacks_origin())
    linked = link_origin(work, schedule, animals, tenant_scoped=tenant_scoped, now=now)
    return linked.unionByName(rest)


def close_linked(boxes, token, start=None, end=None, *, now=None) -> DataFrame:
    """Stage 3, box side: boxes with a deboning order are done."""
    return set_where(
        boxes,
        in_scope(token, start, end) & is_true("flag_desossa"),
        {"flag_processamento": F.lit(True), "updated_at": now_or(now)},
    )


def proc_boxes(boxes: DataFrame, now: Column | None = None) -> DataFrame:
    """Stage 3, result side: rows for the result table, one per box id."""
    return schema_align(dedup_by_id(boxes), now=now)


def merge_proc(target: DataFrame, rows: DataFrame, boxes_columns: list[str]) -> DataFrame:
    """Merge result rows; a creation time we made up does not replace a stored one."""
    insert_only = () if "created_at" in boxes_columns else ("created_at",)
    return upsert(target, rows, insert_only=insert_only)


def trace_all(
    boxes,
    deboning,
    schedule,
    animals,
    token,
    *,
    reset: bool = False,
    update_traceable: bool = True,
    tenant_scoped: bool | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Every period of a tenant: both links, closing, and the traceable flag.

    Boxes with all three links settled skip both joins. The others pass
    through them once: a stage that does not concern a row joins it on a NULL
    key, so neither the boxes nor the first join are computed twice.
    """
    if reset:
        boxes = reset_flags(boxes, token, now=now)
    # after a reset every box of the tenant is open
    chosen = in_scope(token) if reset else in_scope(token) & any_pending()
    whole = reset and token is None
    work, rest = (boxes, None) if whole else _split(boxes, chosen)
    work = link_deboning(
        work, deboning, where=lacks_deboning(), tenant_scoped=tenant_scoped, now=now
    )
    work = link_origin(
        work, schedule, animals, where=lacks_origin(), tenant_scoped=tenant_scoped, now=now
    )
    out = close_linked(work if whole else work.unionByName(rest), token, now=now)
    return set_traceable(out, token, now=now) if update_traceable else out


def trace_period(
    boxes,
    deboning,
    schedule,
    animals,
    token,
    start,
    end,
    *,
    reset: bool = False,
    tenant_scoped: bool | None = None,
    now: Column | None = None,
) -> DataFrame:
    """One period of a tenant: open, link everything open, close."""
    if not require_period(start, end):
        raise ValueError("trace_period needs a period")
    if reset:
        boxes = reset_flags(boxes, token, start, end, now=now)
    marked = mark_for_processing(boxes, token, start, end, now=now)
    chosen = in_scope(token, start, end) & (F.col("flag_processamento") == F.lit(False))
    work, rest = _split(marked, chosen)
    work = link_deboning(work, deboning, tenant_scoped=tenant_scoped, now=now)
    work = link_origin(work, schedule, animals, tenant_scoped=tenant_scoped, now=now)
    return work.withColumn("flag_processamento", F.lit(True)).unionByName(rest)


def worked_on(boxes: DataFrame, clock: Column) -> DataFrame:
    """The boxes a run touched: it stamped them with its clock."""
    return boxes.filter(F.col("updated_at") == clock)


def trace_stage(
    mode: str,
    boxes,
    deboning,
    schedule,
    animals,
    token,
    start=None,
    end=None,
    *,
    every_period: bool = False,
    reset: bool = False,
    update_traceable: bool = True,
    tenant_scoped: bool | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Run one mode and return the boxes in their new state."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; choose one of {MODES}")
    bounded = require_period(start, end)
    if mode == "completo" and bounded and not every_period:
        return trace_period(
            boxes, deboning, schedule, animals, token, start, end,
            reset=reset, tenant_scoped=tenant_scoped, now=now,
        )
    if mode == "completo":
        return trace_all(
            boxes, deboning, schedule, animals, token, reset=reset,
            update_traceable=update_traceable, tenant_scoped=tenant_scoped, now=now,
        )
    if mode == "desossa":
        return trace_deboning(
            boxes, deboning, token, start, end, tenant_scoped=tenant_scoped, now=now
        )
    if mode == "propriedades":
        return trace_origin(
            boxes, schedule, animals, token, start, end, tenant_scoped=tenant_scoped, now=now
        )
    return close_linked(boxes, token, start, end, now=now)


def proc_candidates(boxes, token, start=None, end=None) -> DataFrame:
    """Boxes that belong in the result table after a full or final stage."""
    return linked_boxes(boxes, token, start, end)
