"""Token ids in Parquet files.

A dataset is a folder with two tables. `data` has one row per document in ascending
order of id: `ids`, a list column with dictionary encoding, and `doc_id`, `n_tokens`
and `local_start` with delta encoding. Row groups and pages are small, with page
indexes, so that a reader fetches the ids of few documents without the rest, or the
counts without any ids. `parts` has one row per writing task: its ids' bounds, its
documents and tokens, and the tokens of all tasks before it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from boxtrail.llm import words
from boxtrail.llm.common import texts
from boxtrail.llm.vocabulary import default_path, token_encoder

TOKENIZER_FILE = "byte_bpe_50k.json"
END = 0
#: Bytes of a row group and of a page.
ROW_GROUP, PAGE = 16 << 20, 256 << 10

LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP),
    "parquet.page.size": str(PAGE),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true",
    **{
        f"parquet.enable.dictionary#{c}": "false"
        for c in ("doc_id", "n_tokens", "local_start")
    },
}


def _encoded(file: str, end: int):
    def run(batches):
        encoder, part, before = token_encoder(file), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in words.slices(batch, "text"):
                flat, at = encoder(piece["text"])
                flat = np.insert(flat, at[1:], end)
                at = at + np.arange(len(at))
                ids = pa.ListArray.from_arrays(
                    pa.array(at, pa.int32()), pa.array(flat.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(piece), part), pa.int32()), piece["doc_id"],
                        pa.array(np.diff(at), pa.int64()), pa.array(before + at[:-1]), ids,
                    ],
                    ["part", "doc_id", "n_tokens", "local_start", "ids"],
                )
                before += int(at[-1])

    return run


def write_tokens(
    df: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end: int = END,
    tokenizer_path: str | None = None,
) -> None:
    """Encode every text, add `end` and write the dataset to a new folder.

    Null and empty texts have the end id alone. Null ids come first, equal ids by
    text; repeated rows are written as often as they occur. Other columns are left
    out. An empty table gives a dataset without rows.
    """
    file = tokenizer_path or default_path(TOKENIZER_FILE)
    rows = texts(df, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encoded = dealt.mapInArrow(
        _encoded(file, end),
        f"part int, doc_id {kind}, n_tokens long, local_start long, ids array<int>",
    )
    encoded.write.options(**LAYOUT).parquet(f"{path}/data")
    data = df.sparkSession.read.schema(encoded.schema).parquet(f"{path}/data")
    # One row per writing task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = data.groupBy("part").agg(
        F.min("doc_id").alias("first_doc_id"),
        F.max("doc_id").alias("last_doc_id"),
        F.count("*").alias("n_docs"),
        F.sum("n_tokens").alias("n_tokens"),
    )
    parts.withColumn(
        "tokens_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    ).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """`doc_id`, `start`, `n_tokens` and, if wanted, `ids` of a dataset.

    A filter on `doc_id` reaches the row groups and pages; without ids their
    column is not read.
    """
    data = spark.read.parquet(f"{path}/data")
    parts = spark.read.parquet(f"{path}/parts").select("part", "tokens_before")
    start = (F.col("tokens_before") + F.col("local_start")).alias("start")
    return data.join(parts, "part").select(
        "doc_id", start, "n_tokens", *(["ids"] if with_ids else [])
    )


def checksums(tokens: DataFrame) -> DataFrame:
    """`doc_id`, `start`, `n_tokens` and the crc32 of the ids, little-endian, 32 bits each."""

    def run(batches):
        for batch in batches:
            ids = batch["ids"]
            at = ids.offsets.to_numpy()
            data = memoryview(ids.values.to_numpy().astype("<u4").tobytes())
            found = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("doc_id", "start", "n_tokens")), pa.array(found, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
