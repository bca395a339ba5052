"""Rewriting columns in some of the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def now_or(now: Column | None) -> Column:
    """The caller's clock, or the time of the query."""
    return F.current_timestamp() if now is None else now


def set_where(df: DataFrame, where: Column | None, values: Mapping[str, Column]) -> DataFrame:
    """Give columns new values in the rows the predicate holds for.

    No predicate means every row. All values are taken from the old row.
    """
    if where is None:
        return df.withColumns(dict(values))
    return df.withColumns(
        {c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()}
    )
