"""Payload ingest: files to typed rows, rejected rows and a file ledger."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from boxtrail.operators.ledger import ingest_route, ingest_stats, not_loaded
from boxtrail.operators.payloads import (
    SCHEDULE_KEYS,
    SCHEDULE_PART,
    animal_projection,
    animal_rules,
    audit_stamp,
    corrupt_rule,
    default_json,
    field_mapping,
    processed_stamp,
    schedule_rows,
)
from boxtrail.operators.validate import (
    ERRORS,
    is_valid,
    reject_files,
    required_rules,
    validate_rows,
)
from boxtrail.schemas import (
    ANIMAL_RAW,
    RAW_ANIMAL,
    RAW_ANIMAL_REQUIRED,
    SCHEDULE,
    SIMPLE_ANIMAL,
    SIMPLE_ANIMAL_REQUIRED,
    SLAUGHTER,
)
from boxtrail.sources.json_files import (
    FILE,
    JSON_GLOB,
    envelope,
    every_file,
    open_envelope,
    pending_files,
    scan_json,
)


class Payload(NamedTuple):
    """One kind of payload: how to read, check and type it."""

    name: str
    table: str
    schema: T.StructType  # of a document
    rows: Callable[[DataFrame], DataFrame]  # documents, as scanned, to rows
    rules: Callable[[], dict[str, Column]]  # what makes a row invalid
    typed: Callable[[DataFrame], DataFrame]  # valid rows to table rows
    tenant: str | None = None  # whose rows these are, where files do not say
    split_by: tuple[str, ...] = ()  # columns that become folders of the table

    def check(self, docs: DataFrame) -> DataFrame:
        return validate_rows(self.rows(docs), self.rules())


def _as_is(df: DataFrame) -> DataFrame:
    return df


def animals() -> Payload:
    """Animal envelopes to the 33-column table."""
    return Payload(
        "animais", "bt_animais", envelope(ANIMAL_RAW),
        lambda docs: open_envelope(docs, ANIMAL_RAW), animal_rules, animal_projection,
    )


def slaughter_records(token: str, now: Column | None = None) -> Payload:
    """Slaughter records to the 31-column table of one tenant."""
    return Payload(
        "abates", "bt_abates", SLAUGHTER, _as_is, corrupt_rule,
        lambda df: field_mapping(default_json(audit_stamp(df, token, now))),
        tenant=token,
    )


def schedules(token: str, now: Column | None = None) -> Payload:
    """Slaughter schedules of one tenant: headers, trucks, permits, invoices and items
    as tagged rows of one table, from one parse."""
    return Payload(
        "escalas", "escalas", SCHEDULE, _as_is,
        lambda: {**corrupt_rule(), **required_rules(SCHEDULE_KEYS)},
        lambda df: audit_stamp(schedule_rows(df), token, now),
        tenant=token, split_by=(SCHEDULE_PART,),
    )


def simple_animals(now: Column | None = None) -> Payload:
    """Ten-field animals that have the required fields, with a time stamp."""
    return Payload(
        "animais_simples", "animais", SIMPLE_ANIMAL, _as_is,
        lambda: {**corrupt_rule(), **required_rules(SIMPLE_ANIMAL_REQUIRED)},
        lambda df: processed_stamp(df.select(*SIMPLE_ANIMAL.fieldNames()), now),
    )


def raw_animals() -> Payload:
    """Flat animal objects to the raw table, nested data as JSON text."""
    return Payload(
        "animais_raw", "raw_animais", RAW_ANIMAL, _as_is,
        lambda: {**corrupt_rule(), **required_rules(RAW_ANIMAL_REQUIRED)},
        lambda df: df.withColumn("dados_adicionais", F.to_json("dados_adicionais")).select(
            *RAW_ANIMAL.fieldNames()
        ),
    )


class Ingest(NamedTuple):
    rows: DataFrame  # typed, for the table
    rejected: DataFrame  # as read, with the broken rules
    ledger: DataFrame  # one status row per file
    stats: DataFrame  # files in total, loaded, failed


def ingest(
    spark: SparkSession,
    path: str | list[str],
    payload: Payload,
    *,
    multi_line: bool = True,
    strict: bool = False,
    loaded: DataFrame | None = None,
    note_empty: bool = True,
    glob: str = JSON_GLOB,
    materialise: Callable[[DataFrame], DataFrame] = _as_is,
) -> Ingest:
    """Read every pending file once and split its rows.

    ``loaded`` is an earlier ledger, whose files are left out. ``strict``
    drops all rows of a file that has an invalid one. ``note_empty`` puts files
    without a byte on the ledger, as failed. ``glob`` names the files. ``materialise`` writes
    the checked rows as a table, so that the four results share one parse.
    """
    docs = scan_json(
        spark, path, payload.schema, multi_line=multi_line, diagnostics=True, glob=glob
    )
    files = (every_file if note_empty else pending_files)(spark, path, glob).select(FILE)
    if loaded is not None:
        docs, files = not_loaded(docs, loaded), not_loaded(files, loaded)
    staged = materialise(payload.check(docs))
    kept = reject_files(staged, FILE) if strict else staged
    ledger = ingest_route(staged, files, strict=strict)
    return Ingest(
        rows=payload.typed(kept.filter(is_valid()).drop(ERRORS)),
        rejected=staged.filter(~is_valid()),
        ledger=ledger,
        stats=ingest_stats(ledger),
    )
