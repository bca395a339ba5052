"""Predicates over three-valued flags: true, false, or NULL (not processed yet)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F

from boxtrail.schemas import STAGE_FLAGS


def is_pending(flag: str) -> Column:
    """False or NULL. Written so that the file scan can apply it."""
    return F.col(flag).isNull() | (F.col(flag) == F.lit(False))


def is_true(flag: str) -> Column:
    """True only; never NULL, so it is safe inside NOT."""
    return F.col(flag).isNotNull() & F.col(flag)


def any_pending(flags: Iterable[str] = STAGE_FLAGS) -> Column:
    return reduce(or_, [is_pending(f) for f in flags])


def all_true(flags: Iterable[str] = STAGE_FLAGS) -> Column:
    return reduce(and_, [is_true(f) for f in flags])
