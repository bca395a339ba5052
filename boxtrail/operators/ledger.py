"""What happened to each file: status rows, totals and the run log.

Files are not moved. The ledger says which were loaded; a later run leaves
those out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxtrail.functions.rewrite import now_or
from boxtrail.operators.lookups import left_lookup
from boxtrail.operators.validate import ERRORS, is_valid
from boxtrail.schemas import (
    RUN_LOG,
    STATUS_ERROR,
    STATUS_FINISHED,
    STATUS_OK,
    STATUS_STARTED,
)
from boxtrail.sources.json_files import FILE

NO_ROWS = "nenhum registro"


def ingest_route(
    rows: DataFrame, files: DataFrame | None = None, *, strict: bool = False, file: str = FILE
) -> DataFrame:
    """One status row per file of validated rows.

    A file fails when it has no valid row, or in strict mode any invalid one.
    ``files`` lists files that may have given no rows at all.
    """
    # counted per reason first, where hashing does; the least reason per file is
    # then found among a few rows, as a minimum of text needs a sort
    why = F.when(~is_valid(), F.array_join(ERRORS, "; "))
    reasons = rows.groupBy(file, why.alias("_why")).agg(F.count(F.lit(1)).alias("_n"))
    bad = F.when(F.col("_why").isNotNull(), F.col("_n")).otherwise(0)
    per_file = reasons.groupBy(file).agg(
        F.sum("_n").alias("n_rows"), F.sum(bad).alias("n_bad"), F.min("_why").alias("_why")
    )
    if files is not None:
        per_file = files.select(file).join(per_file, file, "left").na.fill(0, ["n_rows", "n_bad"])
    failed = F.col("n_rows") == F.col("n_bad")
    if strict:
        failed = failed | (F.col("n_bad") > 0)
    return per_file.select(
        file,
        "n_rows",
        "n_bad",
        F.when(failed, STATUS_ERROR).otherwise(STATUS_OK).alias("status"),
        F.when(failed, F.coalesce("_why", F.lit(NO_ROWS))).alias("erro"),
    )


def ingest_stats(ledger: DataFrame) -> DataFrame:
    """Files in total, loaded and failed."""
    return ledger.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == STATUS_OK).alias("success"),
        F.count_if(F.col("status") == STATUS_ERROR).alias("error"),
    )


def not_loaded(rows: DataFrame, ledger: DataFrame, file: str = FILE) -> DataFrame:
    """Rows of files that no earlier run has loaded."""
    done = ledger.filter(F.col("status") == STATUS_OK).select(file).distinct()
    return left_lookup(rows, done, {file: F.col(file)}, how="left_anti")


def silent_files(listed: DataFrame, ledger: DataFrame, file: str = FILE) -> DataFrame:
    """Ledger rows of listed files that gave no document and so are on no ledger yet."""
    absent = left_lookup(
        listed.select(file).distinct(), ledger.select(file).distinct(), {file: F.col(file)},
        how="left_anti",
    )
    none = F.lit(0).cast("long")
    return absent.select(
        file, none.alias("n_rows"), none.alias("n_bad"),
        F.lit(STATUS_ERROR).alias("status"), F.lit(NO_ROWS).alias("erro"),
    )


def _log_rows(
    df: DataFrame, payload: str, layer: str, values: dict, who: dict, now, path: Column | None = None
) -> DataFrame:
    values = {
        "data_hora": now_or(now),
        "tipo_payload": F.lit(payload),
        "camada": F.lit(layer),
        **values,
        **{k: F.lit(v) for k, v in who.items()},
    }
    typed = [
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RUN_LOG
        if f.name != "id"
    ]
    names = [f.name for f in RUN_LOG if f.name != "id"]
    rows = df.select(*typed, (F.lit(None) if path is None else path).cast("string").alias("_path"))
    # an id without a counter: the same row gets the same id on a retry, and files
    # of one name in two folders get two
    key = F.xxhash64("data_hora", "tipo_payload", "camada", "_path", "status")
    return rows.select(key.alias("id"), *names)


def _who(user: str | None, host: str | None, version: str | None) -> dict:
    return {"usuario": user, "hostname": host, "versao_script": version}


def file_log(
    ledger: DataFrame, payload: str, layer: str, *, file: str = FILE,
    user=None, host=None, version=None, now: Column | None = None,
) -> DataFrame:
    """Log rows, one per file: loaded, or failed with the reason."""
    failed = F.col("status") == STATUS_ERROR
    details = F.struct(
        F.col("n_rows").alias("registros"),
        F.col("n_bad").alias("invalidos"),
        F.when(failed, "ValidationError").alias("exception_type"),
        F.col("erro").alias("exception_message"),
    )
    return _log_rows(
        ledger, payload, layer,
        {
            "nome_arquivo": F.element_at(F.split(F.col(file), "/"), -1),
            "status": F.col("status"),
            "mensagem": F.when(failed, F.concat(F.lit("arquivo recusado: "), F.col("erro")))
            .otherwise(F.lit("arquivo carregado")),
            "detalhes": F.to_json(details),
            "registros_processados": F.col("n_rows") - F.col("n_bad"),
            "registros_invalidos": F.col("n_bad"),
        },
        _who(user, host, version), now, F.col(file),
    )


def start_log(
    one: DataFrame, payload: str, layer: str, *, started: Column,
    user=None, host=None, version=None,
) -> DataFrame:
    """A row that says a run has begun, for each row of ``one``."""
    return _log_rows(
        one, payload, layer,
        {"status": F.lit(STATUS_STARTED), "mensagem": F.lit(f"carga de {payload} iniciada")},
        _who(user, host, version), started,
    )


def _duration(started: Column, finished: Column) -> Column:
    return F.unix_millis(finished) - F.unix_millis(started)


def end_log(
    ledger: DataFrame, payload: str, layer: str, *, started: Column, finished: Column,
    user=None, host=None, version=None,
) -> DataFrame:
    """A row with the duration and totals of a run that has ended."""
    totals = ledger.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_bad"), F.lit(0)).alias("n_bad"),
    )
    return _log_rows(
        totals, payload, layer,
        {
            "status": F.lit(STATUS_FINISHED),
            "mensagem": F.lit(f"carga de {payload} finalizada"),
            "duracao_ms": _duration(started, finished),
            "registros_processados": F.col("n_rows") - F.col("n_bad"),
            "registros_invalidos": F.col("n_bad"),
        },
        _who(user, host, version), finished,
    )


def failure_log(
    one: DataFrame, payload: str, layer: str, error: BaseException, *,
    started: Column, finished: Column, user=None, host=None, version=None,
) -> DataFrame:
    """A row that says a run has stopped and why, for each row of ``one``."""
    details = F.struct(
        F.lit(type(error).__name__).alias("exception_type"),
        F.lit(str(error)).alias("exception_message"),
    )
    return _log_rows(
        one, payload, layer,
        {
            "status": F.lit(STATUS_ERROR),
            "mensagem": F.lit(f"carga de {payload} interrompida"),
            "detalhes": F.to_json(details),
            "duracao_ms": _duration(started, finished),
        },
        _who(user, host, version), finished,
    )


def run_log(
    ledger: DataFrame, payload: str, layer: str, *, started: Column, finished: Column,
    user=None, host=None, version=None,
) -> DataFrame:
    """Start and finish rows of a run, with its duration and totals."""
    names = {"user": user, "host": host, "version": version}
    one = ledger.agg(F.count(F.lit(1)).alias("_files"))
    return start_log(one, payload, layer, started=started, **names).unionByName(
        end_log(ledger, payload, layer, started=started, finished=finished, **names)
    )


def run_log_append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
