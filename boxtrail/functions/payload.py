"""Column functions for JSON text and lenient parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)


def iso_timestamp(text: Column) -> Column:
    """ISO date or date-time to timestamp; empty or bad text gives NULL."""
    return F.when(text.rlike(_ISO), F.try_to_timestamp(text))


def variant_json(value: Column) -> Column:
    """A variant as JSON text; absent or JSON null gives an empty object."""
    absent = value.isNull() | F.is_variant_null(value)
    return F.when(absent, F.lit("{}")).otherwise(F.to_json(value))


def json_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("{}"))


def row_json(columns: list[str]) -> Column:
    """The named columns as one JSON object."""
    return F.to_json(F.struct(*columns))


def json_id(text: Column) -> Column:
    return F.get_json_object(text, "$.id")


def trimmed_id(text: Column) -> Column:
    """Trimmed id; empty becomes NULL, so it never matches in a join."""
    return F.nullif(F.trim(text), F.lit(""))
