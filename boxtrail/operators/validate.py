"""Row validation: every row is kept, with the list of rules it breaks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from boxtrail.operators.lookups import left_lookup

ERRORS = "_errors"


def required_rules(columns: Iterable[str]) -> dict[str, Column]:
    return {f"{c} ausente": F.col(c).isNull() for c in columns}


def type_rules(types: Mapping[str, str]) -> dict[str, Column]:
    """Text columns that must cast to the given type where present."""
    return {
        f"{c} invalido": F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()
        for c, kind in types.items()
    }


def validate_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the names of the broken rules. A rule holds for the rows it is
    true for; NULL counts as not broken."""
    broken = [F.when(bad, F.lit(name)) for name, bad in rules.items()]
    found = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn(ERRORS, found)


def is_valid() -> Column:
    return F.size(ERRORS) == 0


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(is_valid()).drop(ERRORS)


def invalid_rows(df: DataFrame) -> DataFrame:
    return df.filter(~is_valid())


def validation_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(is_valid()).alias("validos"), F.count_if(~is_valid()).alias("invalidos")
    )


def reject_files(df: DataFrame, file: str) -> DataFrame:
    """Strict mode: drop every row of a file that has an invalid row."""
    bad = df.filter(~is_valid()).select(file).distinct()
    return left_lookup(df, bad, {file: F.col(file)}, how="left_anti")
