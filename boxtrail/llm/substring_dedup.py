"""Removal of word passages that an earlier document has.

Every window of a fixed number of words is hashed by rolling Rabin-Karp hashes.
A window that also starts in a document with a smaller id is repeated; repeated
windows that overlap or touch merge into maximal intervals, which are cut out.

Documents are grouped in blocks of consecutive ids. Each task sends each window
hash of a block once, however often it occurs there, to the hash's bucket, all hashes
for a bucket in one row with their blocks; a bucket finds the first block of each hash
and tells all others. Within a block, windows are
compared directly. A passage that a third of all documents share so costs one hash
per block. Windows are compared by 64-bit hashes: among n different windows, n**2 /
2**65 pairs are expected to be taken for equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, StringType, StructField, StructType,
)

from boxtrail.llm import words
from boxtrail.llm.common import column, release

WINDOW = 13
#: Ids in a block, as a power of two.
BLOCK_BITS = 8
#: Bytes of text whose window hashes meet in one bucket.
BUCKET_BYTES = 8 << 20
#: Hashes held by a task before they are sent.
HELD = 1 << 22

_U = np.uint64


def _window_hashes(texts: pa.Array, length: int):
    found = words.of_column(texts)
    hashes, at = words.windows(found.hashes(), found.first, length)
    owner = np.searchsorted(found.first, at, side="right") - 1
    return found, hashes, at, owner


def _sent(length: int, buckets: int):
    """Distinct window hashes by block and bucket."""

    def flush(blocks, hashes):
        block, value = np.concatenate(blocks), np.concatenate(hashes)
        order = np.lexsort((value, block, value % _U(buckets)))
        block, value = block[order], value[order]
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (block[1:] != block[:-1])
        block, value = block[new], value[new]
        place = (value % _U(buckets)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(place, prepend=-1))
        ends = np.append(cuts[1:], len(place))
        for low, high in zip(cuts.tolist(), ends.tolist(), strict=True):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place[low : low + 1], pa.int64()),
                    pa.array([block[low:high].astype("<i8").tobytes()]),
                    pa.array([value[low:high].tobytes()]),
                ],
                ["bucket", "blocks", "hashes"],
            )

    def run(batches):
        blocks, hashes, held = [], [], 0
        for batch in batches:
            for part in words.slices(batch, "text"):
                _, value, _, owner = _window_hashes(part["text"], length)
                blocks.append(part["block"].to_numpy()[owner])
                hashes.append(value)
                held += len(value)
                if held >= HELD:
                    yield from flush(blocks, hashes)
                    blocks, hashes, held = [], [], 0
        if held:
            yield from flush(blocks, hashes)
        blocks, hashes = [], []
        release()

    return run


def _later_blocks(sent: pa.Table) -> pa.Table:
    """For each block, the hashes of this bucket that an earlier block has too."""
    release()
    value = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in sent["hashes"]])
    block = np.concatenate([np.frombuffer(x.as_buffer(), dtype="<i8") for x in sent["blocks"]])
    order = np.argsort(value, kind="stable")
    value, block = value[order], block[order]
    new = np.flatnonzero(np.diff(value, prepend=~value[:1]))
    first = np.repeat(np.minimum.reduceat(block, new), np.diff(np.append(new, len(value))))
    later = block > first
    value, block = value[later], block[later]
    order = np.argsort(block, kind="stable")
    value, block = value[order], block[order]
    cuts = np.flatnonzero(np.diff(block, prepend=block[:1] - 1))
    ends = np.append(cuts[1:], len(block))[: len(cuts)]
    return pa.table(
        {
            "block": pa.array(block[cuts], pa.int64()),
            "hashes": pa.array(
                [value[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()
            ),
        }
    )


def _in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _spans(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _cut(length: int):
    """Cut the repeated windows out of the documents of one block."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        release()
        docs = docs.combine_chunks()
        texts = docs["text"].combine_chunks()
        earlier = np.unique(
            np.concatenate(
                [np.empty(0, np.uint64)]
                + [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in told["hashes"]]
            )
        )
        found, value, at, owner = _window_hashes(texts, length)
        ids = docs["id"].to_numpy()[owner]
        order = np.argsort(value, kind="stable")
        again = np.zeros(len(value), dtype=bool)
        if len(value):
            ordered = value[order]
            new = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]))
            sizes = np.diff(np.append(new, len(value)))
            again[order] = ids[order] > np.repeat(np.minimum.reduceat(ids[order], new), sizes)
        again |= _in(value, earlier)
        cover = np.zeros(len(found.starts) + 1, dtype=np.int64)
        np.add.at(cover, at[again], 1)
        np.add.at(cover, at[again] + length, -1)
        gone = np.cumsum(cover)[:-1] > 0
        counts, kept, spans, removed = found.counts, [], [], []
        data, offsets = words.text_buffer(texts)
        raw = data.tobytes()
        for k, (low, high) in enumerate(zip(found.first[:-1], found.first[1:], strict=True)):
            mark = gone[low:high]
            starts, ends = _spans(mark)
            removed.append(int(mark.sum()))
            spans.append([{"start": a, "end": b} for a, b in zip(starts, ends, strict=True)])
            begin, pieces = int(offsets[k]), []
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                pieces.append(raw[begin : found.starts[low + a]])
                begin = int(found.starts[low + b]) if low + b < high else int(offsets[k + 1])
            pieces.append(raw[begin : offsets[k + 1]])
            kept.append(b"".join(pieces).decode())
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        columns = {c: docs[c] for c in docs.schema.names if c not in ("text", "block", "id")}
        return pa.table(
            {
                **columns,
                "kept_text": pa.array(kept, pa.string()),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "removed": pa.array(spans, span),
            }
        )

    return run


def remove_repeats(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = WINDOW,
    keep: dict | None = None,
) -> DataFrame:
    """`doc_id`, `kept_text`, `n_words`, `n_removed` and `removed` of every row.

    `removed` lists the cut intervals of words, `start` inclusive and `end` exclusive.
    `keep` adds columns by name. Ids are whole numbers. A null text has no words and
    its kept text is empty. Rows with equal ids are one document as far as "earlier"
    goes, so repeated rows keep their words. Rows with a null id are neither earlier
    nor later than others: nothing is cut there. Windows are judged on the input.
    """
    extra = keep or {}
    rows = df.select(
        column(df, id_column).alias("doc_id"),
        F.coalesce(column(df, text_column).cast("string"), F.lit("")).alias("text"),
        *[value.alias(name) for name, value in extra.items()],
    )
    number = F.col("doc_id").cast("long")
    docs = rows.where("doc_id IS NOT NULL").withColumns(
        {"block": F.shiftright(number, BLOCK_BITS), "id": number}
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(-(-size // BUCKET_BYTES), 1)
    later = (
        docs.select("text", "block")
        .mapInArrow(_sent(length, buckets), "bucket long, blocks binary, hashes binary")
        .groupBy("bucket")
        .applyInArrow(_later_blocks, "block long, hashes binary")
    )
    span = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
    schema = StructType(
        [
            *[f for f in rows.schema if f.name != "text"],
            StructField("kept_text", StringType()),
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("removed", ArrayType(span)),
        ]
    )
    cut = (
        docs.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(_cut(length), schema)
    )
    split = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    no_id = rows.where("doc_id IS NULL").select(
        *[c for c in rows.columns if c != "text"],
        F.col("text").alias("kept_text"),
        F.size(split).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_removed"),
        F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("removed"),
    )
    return cut.unionByName(no_id)
