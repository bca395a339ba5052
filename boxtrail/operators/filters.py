"""Selections over boxes and payload rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from boxtrail.functions.flags import any_pending, is_pending, is_true

Day = dt.date | str


def require_period(start: Day | None, end: Day | None) -> bool:
    """True with both ends, False with none; one end alone is an error."""
    if (start is None) != (end is None):
        raise ValueError("a period needs both its start and its end")
    return start is not None


def in_scope(token: str | None, start: Day | None = None, end: Day | None = None) -> Column:
    """Tenant and, if given, production period with both ends included."""
    parts = [F.lit(True)]
    if token is not None:
        parts.append(F.col("token_cliente") == F.lit(token))
    if require_period(start, end):
        first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
        parts.append(F.col("dt_producao").between(first, last))
    return reduce(and_, parts)


def tenant_period(boxes: DataFrame, token, start=None, end=None) -> DataFrame:
    return boxes.filter(in_scope(token, start, end))


def pending_boxes(boxes, token, start, end, reprocess: bool = False) -> DataFrame:
    """Boxes set to be processed that still lack a link; a NULL
    ``flag_processamento`` is not selected. ``reprocess`` drops the link test."""
    chosen = in_scope(token, start, end) & (F.col("flag_processamento") == F.lit(False))
    if not reprocess:
        chosen = chosen & any_pending()
    return boxes.filter(chosen)


def pending_by_flags(boxes, token, start, end, flags: Iterable[str] = ()) -> DataFrame:
    """Boxes set to be processed, with any of the chosen flags still open."""
    chosen = in_scope(token, start, end) & (F.col("flag_processamento") == F.lit(False))
    flags = list(flags)
    if flags:
        chosen = chosen & any_pending(flags)
    return boxes.filter(chosen)


def lacks_deboning() -> Column:
    return is_pending("flag_desossa")


def lacks_origin() -> Column:
    return is_true("flag_desossa") & any_pending(("flag_propriedades", "flag_animais"))


def needs_deboning(boxes, token, start=None, end=None) -> DataFrame:
    return boxes.filter(in_scope(token, start, end) & lacks_deboning())


def needs_origin(boxes, token, start=None, end=None) -> DataFrame:
    return boxes.filter(in_scope(token, start, end) & lacks_origin())


def linked_boxes(boxes, token, start=None, end=None) -> DataFrame:
    return boxes.filter(in_scope(token, start, end) & is_true("flag_desossa"))


def with_required(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Rows in which every required column is present."""
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in required]))
