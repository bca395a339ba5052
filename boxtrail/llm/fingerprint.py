"""Quartile bucket digests of texts.

Every three bytes in a row are hashed to one of 256 buckets. A digest holds, for
each bucket, in which quartile of the text's bucket counts its count lies (two
bits), and the text's length on a logarithmic scale (one byte); it is written in
hexadecimal. Two digests differ by the sum of their bucket differences, where a
jump over all quartiles counts double, and of a bounded length difference.
Likeness is 1 for equal digests and falls to 0 at the difference that unrelated
texts have on average.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from boxtrail.llm import words
from boxtrail.llm.common import stored, texts

BUCKETS = 256
#: Of two buckets whose quartiles are 0 to 3 apart.
STEP = np.array([0, 1, 2, 6], dtype=np.int64)
#: Mean difference of two independent digests.
UNRELATED = BUCKETS * (6 * 1 + 4 * 2 + 2 * 6) / 16
LENGTH_CAP = 48

_HASH = np.uint32(0x9E3779B1)


def bucket_counts(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the triplets of each text by bucket."""
    out = np.zeros((len(offsets) - 1, BUCKETS), dtype=np.int64)
    if len(buffer) < 3:
        return out
    code = buffer[:-2].astype(np.uint32)
    code |= buffer[1:-1].astype(np.uint32) << np.uint32(8)
    code |= buffer[2:].astype(np.uint32) << np.uint32(16)
    code *= _HASH
    bucket = (code >> np.uint32(24)).astype(np.intp)
    for k, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if high - low >= 3:
            out[k] = np.bincount(bucket[low : high - 2], minlength=BUCKETS)
    return out


def digests(column: pa.Array) -> np.ndarray:
    """One row of bytes per text: its length, then quartiles of its buckets."""
    buffer, offsets = words.text_buffer(column)
    counts = bucket_counts(buffer, offsets)
    ordered = np.sort(counts, axis=1)
    quarter = BUCKETS // 4
    quartile = np.zeros(counts.shape, dtype=np.uint8)
    for k in (1, 2, 3):
        quartile += counts > ordered[:, k * quarter - 1, None]
    length = np.minimum(255, np.round(8 * np.log2(np.diff(offsets) + 1))).astype(np.uint8)
    fours = quartile.reshape(len(counts), -1, 4)
    packed = fours @ np.array([64, 16, 4, 1], dtype=np.uint8)
    return np.column_stack([length, packed.astype(np.uint8)])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the digests in the same rows; 0 to 1."""
    apart = np.zeros(len(a), dtype=np.int64)
    for shift in (0, 2, 4, 6):
        x, y = (a[:, 1:] >> shift) & 3, (b[:, 1:] >> shift) & 3
        apart += STEP[np.abs(x.astype(np.int64) - y)].sum(axis=1)
    length = np.abs(a[:, 0].astype(np.int64) - b[:, 0])
    return np.maximum(0.0, 1.0 - (apart + np.minimum(length, LENGTH_CAP)) / UNRELATED)


def written(digest: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in digest]


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id` and `fingerprint` of every row.

    A null text counts as empty. Texts under three bytes have no triplets; their
    digests differ by length only. Rows are independent: repeated rows come out
    repeated, null ids stay null, other columns are left out.
    """

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(written(digests(part["text"])))],
                    ["doc_id", "fingerprint"],
                )

    source = texts(df, id_column, text_column)
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fingerprint string"
    return source.mapInArrow(run, schema)


# --- each text beside its next one ---


def _compared(ids: list, own: list[str], following: list[str], mine: np.ndarray) -> dict:
    """Digests of texts, given as `mine`, and of their edited texts."""
    edited, sizes = [], []
    for text, after in zip(own, following, strict=True):
        cut = len(text) // 3
        edited.append(text[: len(text) - cut] + after[:cut])
        sizes.append(len(text))
    theirs = digests(pa.array(edited, pa.string()))
    return {
        "doc_id": ids,
        "n_chars": sizes,
        "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in edited],
        "fingerprint": written(mine),
        "edited_fingerprint": written(theirs),
        "near_edited": likeness(mine, theirs),
    }


_RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _arrow(found: dict, kind: pa.DataType, near_next, **more) -> pa.RecordBatch:
    columns = {**found, "near_next": near_next, **more}
    n = len(found["doc_id"])
    types = {
        "doc_id": kind, "n_chars": pa.int64(), "near_edited": pa.float64(),
        "near_next": pa.float64(), "part": pa.int32(),
    }
    names = [
        "part", "place", "doc_id", "n_chars", "edited_sha256", "fingerprint",
        "edited_fingerprint", "near_edited", "near_next", "text",
    ]
    arrays = [
        pa.array(columns.get(c, [None] * n), types.get(c, pa.string())) for c in names
    ]
    return pa.RecordBatch.from_arrays(arrays, names)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare rows with the ones after them; hand on the first and the last row."""
    part, held, first = TaskContext.get().partitionId(), None, None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for piece in words.slices(batch, "text"):
            ids, own = piece["doc_id"].to_pylist(), piece["text"].to_pylist()
            if first is None:
                first = (ids[0], own[0])
            if held is not None:
                ids.insert(0, held[0])
                own.insert(0, held[1])
            held = (ids[-1], own[-1])
            if len(ids) > 1:
                digest = digests(pa.array(own, pa.string()))
                found = _compared(ids[:-1], own[:-1], own[1:], digest[:-1])
                n = len(ids) - 1
                yield _arrow(
                    found, kind, likeness(digest[:-1], digest[1:]),
                    part=[part] * n, place=["row"] * n,
                )
    if held is not None:
        for place, (doc, text) in (("first", first), ("last", held)):
            yield _arrow({"doc_id": [doc]}, kind, [None], part=[part], place=[place], text=[text])


def _at_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, own, after = (batch[c].to_pylist() for c in ("doc_id", "text", "after"))
        mine = digests(pa.array(own, pa.string()))
        near = likeness(mine, digests(pa.array(after, pa.string())))
        yield _arrow(_compared(ids, own, after, mine), batch.schema.field("doc_id").type, near)


def edited_neighbours(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Digests of each text, of the text with its last third taken from the next one.

    The order is that of descending ids, null ids last, equal ids by text; after
    the last row comes the first. Rows are dealt by ranges of ids, so that nearly
    all neighbours meet in one task; the first and last rows of the ranges, two a
    task, are stored and matched afterwards. Null texts are empty, a single row is
    its own next one, other columns are left out.
    """
    source = texts(df, id_column, text_column)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"part int, place string, doc_id {kind}, {_RESULT}, text string"
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    dealt = source.repartitionByRange(order[0]).sortWithinPartitions(*order)
    found = stored(dealt.mapInArrow(_in_order, schema), "neighbours")
    results = [c.split()[0] for c in _RESULT.split(", ")]
    inner = found.where("place = 'row'").select("doc_id", *results)

    borders = found.where("place <> 'row'").groupBy("part").agg(
        F.max(F.when(F.col("place") == "first", F.col("text"))).alias("head"),
        F.max_by("doc_id", F.when(F.col("place") == "last", 1)).alias("doc_id"),
        F.max(F.when(F.col("place") == "last", F.col("text"))).alias("text"),
    )
    # One row for each task of the sort above.
    by_part = Window.orderBy("part")
    first = F.first("head").over(by_part.rowsBetween(Window.unboundedPreceding, 0))
    outer = (
        borders.withColumn("after", F.coalesce(F.lead("head").over(by_part), first))
        .select("doc_id", "text", "after")
        .mapInArrow(_at_borders, schema)
        .select("doc_id", *results)
    )
    return inner.unionByName(outer)
