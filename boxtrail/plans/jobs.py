"""Runs over the tables of a lake: read, trace, write back.

Box, sale and result tables are partitioned by tenant and month, and a run
replaces the partitions it covers. Before that its result is written to the
scratch folder, so a run never overwrites what it is still reading, and one
that fails can be repeated: results are merged by key, and a box or sale is
marked done only after its results are stored.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from boxtrail.operators.filters import require_period
from boxtrail.operators.ledger import (
    end_log,
    failure_log,
    file_log,
    run_log_append,
    silent_files,
    start_log,
)
from boxtrail.operators.link import ORIGIN_KEYS
from boxtrail.operators.lookups import left_lookup, one_per_key
from boxtrail.operators.merge import new_rows
from boxtrail.operators.payloads import schedule_origin, slaughtered_animals
from boxtrail.operators.sales import traced_sales
from boxtrail.operators.transitions import mark_sales_processed
from boxtrail.plans import trace
from boxtrail.plans.ingest import Payload
from boxtrail.plans.sale_trace import sale_trace
from boxtrail.schemas import BOX, PROC_BOX
from boxtrail.session import materialise
from boxtrail.sources import jdbc
from boxtrail.sources.json_files import FILE, every_file
from boxtrail.sources.lake import lake_path, lake_read, table_exists, write_partitioned
from boxtrail.sources.listing import qualified
from boxtrail.streaming.ingest_stream import (
    BATCH,
    RUN,
    read_ledger,
    read_pending,
    start_ingest_stream,
)

MONTH = "ano_mes"
STATE_PARTITIONS = ("token_cliente", MONTH)


def month_of(day: str):
    """The month partition of a row; rows without a day share one of their own."""
    return F.coalesce(F.date_format(day, "yyyyMM"), F.lit("000000"))


def with_month(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn(MONTH, month_of(day))


def _schema(fields: T.StructType) -> T.StructType:
    return T.StructType([*fields.fields, T.StructField(MONTH, T.StringType())])


def read_state(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored table with all its columns. Tenant and month are folder names
    and must stay text: read as numbers they would lose leading zeros."""
    found = lake_read(spark, root, table).schema
    text = {*STATE_PARTITIONS}
    fields = [
        T.StructField(f.name, T.StringType() if f.name in text else f.dataType) for f in found
    ]
    return lake_read(spark, root, table, schema=T.StructType(fields))


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of a schema that are absent, as typed NULLs."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def read_or_empty(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows where it has not been written yet."""
    try:
        return lake_read(spark, root, table, schema=schema)
    except FileNotFoundError:
        return spark.createDataFrame([], schema)


def replace_partitions(df: DataFrame, path: str, partitions=STATE_PARTITIONS) -> None:
    write_partitioned(df, path, partitions, mode="overwrite", dynamic=True)


def write_boxes(boxes: DataFrame, root: str) -> None:
    replace_partitions(with_month(boxes, "dt_producao"), lake_path(root, "bt_caixas"))


def write_sales(sales: DataFrame, root: str) -> None:
    replace_partitions(with_month(sales, "created_at"), lake_path(root, "bt_registro_venda"))


def _of_tenant(lookup: DataFrame, token: str) -> DataFrame:
    """Links compare tenants where a lookup has them: read only this one's rows."""
    if "token_cliente" not in lookup.columns:
        return lookup
    return lookup.filter(F.col("token_cliente") == F.lit(token))


def _origins(
    spark: SparkSession, root: str, table: str, loaded: str, derive: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """A lookup of slaughter keys: the stored table, where it has the keys, and what
    ingest has loaded elsewhere."""
    found = []
    if table_exists(spark, lake_path(root, table)):
        rows = read_state(spark, root, table)
        if set(ORIGIN_KEYS) <= set(rows.columns):
            found.append(rows)
    if table_exists(spark, lake_path(root, loaded)):
        found.append(derive(read_state(spark, root, loaded)))
    if not found:
        raise FileNotFoundError(lake_path(root, table))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def read_schedule(spark: SparkSession, root: str) -> DataFrame:
    """Schedules, imported ones and those loaded from payload files."""
    def headers(rows: DataFrame) -> DataFrame:
        return schedule_origin(rows, "token_cliente")

    return _origins(spark, root, "bt_escala", "escalas", headers)


def read_animals(spark: SparkSession, root: str) -> DataFrame:
    """Animals, imported ones and those of loaded slaughter records."""
    return _origins(spark, root, "bt_animais", "bt_abates", slaughtered_animals)


def _period(df: DataFrame, start, end) -> DataFrame:
    """Whole months that cover a period, so that other partitions are not read."""
    if start is None:
        return df
    first, last = (str(day)[:7].replace("-", "") for day in (start, end))
    return df.filter(F.col(MONTH).between(first, last))


def _clock(clock: dt.datetime | None):
    """One time for the whole run."""
    return F.lit(clock or dt.datetime.now(dt.timezone.utc)).cast("timestamp")


def _months(rows: DataFrame) -> set[str]:
    """Months as values, so that a scan's own filter leaves the other folders out. One
    row per month folder comes to the driver, which lists these folders anyway."""
    return {month for (month,) in rows.select(MONTH).distinct().collect()}


def _empty_folders(rows: DataFrame) -> None:
    """Replace the folders of a table's rows by ones without rows, which a dynamic
    overwrite cannot do."""
    file = F.col("_metadata.file_path")
    folders = rows.select(F.regexp_replace(file, "/[^/]*$", "").alias("f")).distinct()
    none = rows.drop(*STATE_PARTITIONS).limit(0)
    for (folder,) in folders.collect():  # one row per month folder
        none.write.mode("overwrite").parquet(unquote(folder))


def store_proc_boxes(spark: SparkSession, root: str, rows: DataFrame, token: str, columns) -> None:
    """Merge rows into the result table, where an id has one row.

    A box whose production day has moved to another month moves too. Read and replaced
    are the months the rows fall in and those that hold one of their ids; to find these,
    only the ids of the tenant's other months are read. The new place is written before
    the old one is given up, so a run that fails in between can be repeated.
    """
    source = materialise(with_month(rows, "dt_producao"), "proc_novas")
    target = read_or_empty(spark, root, "proc_caixas", _schema(PROC_BOX)).filter(
        F.col("token_cliente") == F.lit(token)
    )
    months = _months(source)
    elsewhere = target.filter(~F.col(MONTH).isin(*months)).select("id", MONTH)
    months |= _months(elsewhere.join(source.select("id"), "id", "left_semi"))
    touched = target.filter(F.col(MONTH).isin(*months))
    known = one_per_key(touched, ["id"], newest="updated_at")
    merged = materialise(trace.merge_proc(known, source, columns), "proc_caixas")
    replace_partitions(merged, lake_path(root, "proc_caixas"))
    emptied = months - _months(merged)
    if emptied:
        _empty_folders(touched.filter(F.col(MONTH).isin(*emptied)))


def run_trace(
    spark: SparkSession,
    root: str,
    token: str,
    mode: str = "completo",
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    *,
    every_period: bool = False,
    reset: bool = False,
    update_traceable: bool = True,
    clock: dt.datetime | None = None,
) -> None:
    """Trace a tenant's boxes and store boxes and results."""
    bounded = require_period(start, end) and not every_period
    if not bounded:
        start = end = None
    now = _clock(clock)
    boxes = with_columns_of(read_state(spark, root, "bt_caixas"), BOX)
    boxes = _period(boxes.filter(F.col("token_cliente") == F.lit(token)), start, end)
    lookups = [
        _of_tenant(rows, token)
        for rows in (
            read_state(spark, root, "bt_desossa"),
            read_schedule(spark, root),
            read_animals(spark, root),
        )
    ]
    traced = materialise(
        trace.trace_stage(
            mode, boxes, *lookups, token, start, end,
            reset=reset, update_traceable=update_traceable, now=now,
        ),
        "bt_caixas",
    )
    if mode in ("completo", "proc-caixas"):
        done = (
            trace.worked_on(traced, now)
            if mode == "completo" and bounded
            else trace.proc_candidates(traced, token, start, end)
        )
        rows = trace.proc_boxes(done.drop(MONTH), now)
        store_proc_boxes(spark, root, rows, token, traced.columns)
    replace_partitions(traced, lake_path(root, "bt_caixas"))


def _partitions_of(sales: DataFrame, ids: DataFrame) -> DataFrame:
    """The sales in the partitions that hold a listed one; others stay unread
    where the runtime prunes folders, and are not written again."""
    held = left_lookup(sales, ids, {"registro_id": F.col("id")}, how="left_semi")
    held = held.select(*STATE_PARTITIONS).distinct()
    # a sale may lack its tenant, which is a partition like any other
    same = reduce(and_, [sales[c].eqNullSafe(held[c]) for c in STATE_PARTITIONS])
    return sales.join(held, same, "left_semi")


def _append_new(spark: SparkSession, root: str, table: str, rows: DataFrame) -> None:
    """Append the rows the table does not hold, compared on every column."""
    stored = read_or_empty(spark, root, table, rows.schema).select(*rows.columns)
    rows.subtract(stored).write.mode("append").parquet(lake_path(root, table))


def run_sales(
    spark: SparkSession,
    root: str,
    grupo_id: int | None = None,
    token: str | None = None,
    limit: int | None = None,
    clock: dt.datetime | None = None,
) -> None:
    """Trace open sales, store the four result tables, then close the sales.

    A sale is traced to boxes of its own tenant. A run for a tenant reads only this
    tenant's folders.
    """
    now = _clock(clock)
    sales = read_state(spark, root, "bt_registro_venda")
    lookups = [
        read_state(spark, root, "bt_caixas"),
        read_state(spark, root, "bt_desossa"),
        read_state(spark, root, "bt_propriedades"),
        read_animals(spark, root),
    ]
    if token is not None:
        sales, *lookups = (_of_tenant(rows, token) for rows in (sales, *lookups))
    run = sale_trace(
        sales, *lookups, grupo_id, token, limit, now,
        materialise=lambda rows: materialise(rows, "proc_venda"), tenant_scoped=True,
    )
    headers = read_or_empty(spark, root, "proc_registro_venda", run.headers.schema)
    new_rows(headers, run.headers, ["id"]).write.mode("append").parquet(
        lake_path(root, "proc_registro_venda")
    )
    _append_new(spark, root, "proc_propriedades", run.properties)
    _append_new(spark, root, "proc_cx_venda_propriedade", run.sale_properties)
    animals = read_or_empty(spark, root, "proc_animais", run.animals.schema)
    new_rows(animals, run.animals, ["id", "token_cliente"]).write.mode("append").parquet(
        lake_path(root, "proc_animais")
    )
    ids = traced_sales(run.rows)
    closed = mark_sales_processed(_partitions_of(sales, ids), ids, now)
    closed = materialise(closed, "bt_registro_venda")
    replace_partitions(closed, lake_path(root, "bt_registro_venda"))


class Stream(NamedTuple):
    """Where one stream of files keeps its state: one tenant, payload and folder."""

    prefix: str
    checkpoint: str
    ledger: str


def stream_of(spark: SparkSession, root: str, payload: Payload, pending: str) -> Stream:
    source = f"{payload.tenant or ''}|{qualified(spark, pending)}"
    name = hashlib.sha256(source.encode()).hexdigest()[:12]
    return Stream(
        f"{name}-",
        lake_path(root, f"checkpoint/{payload.name}/{name}"),
        lake_path(root, f"arquivos/{payload.name}"),
    )


def _listed(spark: SparkSession, stream: Stream, pending: str) -> DataFrame:
    """The files there before a run, kept until a run has accounted for them all.

    A run that fails leaves its list to the next, as its files may be archived by then.
    """
    path = f"{stream.checkpoint}/listagem"
    files = every_file(spark, pending).select(FILE)
    if table_exists(spark, path):
        files = files.union(spark.read.schema(f"{FILE} string").parquet(path)).distinct()
    files = materialise(files, "listagem")
    files.write.mode("overwrite").parquet(path)
    return files


def _note_silent(spark: SparkSession, stream: Stream, listed: DataFrame, run: str) -> None:
    """Put listed files without any document on the ledger, then drop the list."""
    book = read_ledger(spark, stream.ledger, stream.prefix)
    silent = silent_files(listed, book).withColumn(RUN, F.lit(run))
    silent.write.mode("overwrite").parquet(f"{stream.ledger}/{BATCH}={stream.prefix}vazios-{run}")
    listed.limit(0).write.mode("overwrite").parquet(f"{stream.checkpoint}/listagem")


def run_ingest(
    spark: SparkSession,
    root: str,
    payload: Payload,
    pending: str,
    *,
    layer: str = "raw",
    archive: str | None = None,
    multi_line: bool = True,
    strict: bool = False,
    user: str | None = None,
    host: str | None = None,
    version: str | None = None,
) -> None:
    """Load what is pending, exactly once per file, and log each file.

    The log has a row before anything is read. A run that fails leaves one with the
    error, and rows of the files it has loaded, and can be repeated.
    """
    log = lake_path(root, "log_processamento")
    stream = stream_of(spark, root, payload, pending)
    run = uuid.uuid4().hex[:12]
    about = (payload.name, layer)
    who = {"user": user, "host": host, "version": version}
    one = spark.range(1)
    begin = _clock(None)
    run_log_append(start_log(one, *about, started=begin, **who), log)

    def seen() -> DataFrame:
        return read_ledger(spark, stream.ledger, stream.prefix).filter(F.col(RUN) == F.lit(run))

    try:
        listed = _listed(spark, stream, pending)
        docs = read_pending(spark, pending, payload, multi_line=multi_line, archive=archive)
        start_ingest_stream(
            docs, payload,
            table=lake_path(root, payload.table),
            quarantine=lake_path(root, f"quarentena/{payload.name}"),
            ledger=stream.ledger,
            checkpoint=stream.checkpoint,
            strict=strict, prefix=stream.prefix, run=run,
        ).awaitTermination()
        _note_silent(spark, stream, listed, run)
    except BaseException as error:
        end = _clock(None)
        failed = failure_log(one, *about, error, started=begin, finished=end, **who)
        run_log_append(failed.unionByName(file_log(seen(), *about, now=end, **who)), log)
        raise
    end = _clock(None)
    rows = end_log(seen(), *about, started=begin, finished=end, **who)
    run_log_append(rows.unionByName(file_log(seen(), *about, now=end, **who)), log)


_DAYS = {"bt_caixas": "dt_producao", "proc_caixas": "dt_producao", "bt_registro_venda": "created_at"}


def run_import(
    spark: SparkSession,
    root: str,
    connection: Mapping[str, str],
    table: str,
    *,
    schema: str = "public",
    split: jdbc.Split | None = None,
    predicates: Sequence[str] | None = None,
) -> None:
    """Replace a lake table by a database table, state tables by tenant and month."""
    rows = jdbc.read_table(
        spark, connection, table, schema, split=split, predicates=predicates
    )
    path = lake_path(root, table)
    if table in _DAYS:
        stored = with_month(rows, _DAYS[table])
        write_partitioned(stored, path, STATE_PARTITIONS, mode="overwrite")
    else:
        rows.write.mode("overwrite").parquet(path)


def run_export(
    spark: SparkSession,
    root: str,
    connection: Mapping[str, str],
    table: str,
    *,
    schema: str = "public",
    mode: str = "append",
    connections: int | None = None,
) -> None:
    """Write a lake table to a database table."""
    rows = read_state(spark, root, table).drop(MONTH)
    jdbc.write_table(rows, connection, table, mode, schema, connections=connections)
