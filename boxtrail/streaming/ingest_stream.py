"""Incremental ingest: a pending folder to a table, each file exactly once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from boxtrail.operators.ledger import ingest_route, not_loaded
from boxtrail.operators.validate import ERRORS, is_valid, reject_files
from boxtrail.plans.ingest import Payload
from boxtrail.session import materialise
from boxtrail.sources.json_files import CORRUPT, FILE, JSON_GLOB, with_corrupt
from boxtrail.sources.lake import table_exists

BATCH = "lote_carga"
RUN = "execucao"
LEDGER = (
    f"{FILE} string, n_rows bigint, n_bad bigint, status string, erro string, "
    f"{RUN} string, {BATCH} string"
)


def read_pending(
    spark: SparkSession,
    path: str,
    payload: Payload,
    *,
    multi_line: bool = True,
    files_per_batch: int = 10_000,
    archive: str | None = None,
) -> DataFrame:
    """New JSON files as they arrive, with path and unreadable text. Files are
    archived once their batch is committed, if a folder is given."""
    reader = (
        spark.readStream.schema(with_corrupt(payload.schema))
        .option("multiLine", multi_line)
        .option("pathGlobFilter", JSON_GLOB)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d")  # by default a file a week older than another is skipped
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path).withColumn(FILE, F.col("_metadata.file_path"))


def generation(spark: SparkSession, checkpoint: str) -> str:
    """A name kept in the checkpoint. One that starts anew, as the old was lost, has another
    name, so that its batches, numbered from 0 again, replace nothing."""
    path = f"{checkpoint}/geracao"
    if table_exists(spark, path):
        for row in spark.read.schema("geracao string").parquet(path).take(1):
            return row.geracao
    name = uuid.uuid4().hex[:12]
    spark.createDataFrame([(name,)], "geracao string").write.mode("overwrite").parquet(path)
    return name


def read_ledger(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Ledger rows of the batches of one stream; folders of others are not read."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path).filter(F.col(BATCH).startswith(prefix))


def start_ingest_stream(
    pending: DataFrame,
    payload: Payload,
    *,
    table: str,
    quarantine: str,
    ledger: str,
    checkpoint: str,
    strict: bool = False,
    prefix: str = "",
    run: str = "",
) -> StreamingQuery:
    """Load everything pending and stop.

    Each batch writes its own folder in the three tables, replacing it when
    the batch is run again, so a crash between two writes loads nothing twice. Folders
    are named after ``prefix``, which tells streams into the same tables apart, the
    checkpoint's generation and the batch. Files that an earlier generation of this
    stream has loaded are left out. Every document's file gets a ledger row, also if the
    document has no rows; files without any document are not seen here.
    """
    spark = pending.sparkSession
    own = f"{prefix}{generation(spark, checkpoint)}-"

    def load(batch: DataFrame, batch_id: int) -> None:
        def put(df: DataFrame, path: str, split_by: tuple[str, ...] = ()) -> None:
            writer = df.write.mode("overwrite").partitionBy(*split_by)
            writer.parquet(f"{path}/{BATCH}={own}{batch_id:08d}")

        earlier = read_ledger(spark, ledger, prefix).filter(~F.col(BATCH).startswith(own))
        docs = materialise(not_loaded(batch, earlier), "documentos")
        staged = payload.check(docs)
        kept = reject_files(staged, FILE) if strict else staged
        put(payload.typed(kept.filter(is_valid()).drop(ERRORS)), table, payload.split_by)
        put(staged.filter(~is_valid()), quarantine)
        files = docs.select(FILE).distinct()
        put(ingest_route(staged, files, strict=strict).withColumn(RUN, F.lit(run)), ledger)

    return (
        pending.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
