"""Packing of documents into token sequences of one length and one mixture.

Every source is a queue of tokens, its documents in order of id. Sequences are
filled by deficit round-robin: a queue's deficit is its target share of all tokens
packed so far less the tokens it has given, and the next token comes from the queue
that falls due first, that is, whose next token has the earliest due time, where
token i of a queue of n tokens is due at (i + 1/2) / n of the run. Each sequence so
holds the target proportions up to about one token per queue, and what is short in
one sequence is made up in the next.

Due times give the tokens that each queue has provided before any sequence as a
function of that sequence's number. A task therefore works out the deficits that it
starts with instead of waiting for the task before it, and all documents are cut in
parallel, each by itself. A source with most of the rows needs no task of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from boxtrail.llm import words
from boxtrail.llm.common import column, release, stored
from boxtrail.llm.vocabulary import default_path, token_encoder

LENGTH = 2048
END = 1
TOKENIZER_FILE = "byte_bpe_50k.json"
#: Bytes of text encoded at once; the arrays made of them take some thirty times that.
PIECE = 1 << 20


@dataclass
class Mixture:
    """Which queue fills which places; `totals` has the tokens of each queue.

    Without `weights` the target is the queues' own proportions and all run dry at
    the end. With weights, a queue that runs dry leaves the rest to the others in
    their proportions, and queues of weight 0 come last: every token is packed.
    What is left after the last full sequence fills sequences whose lengths are
    powers of two, so that nothing is padded.
    """

    totals: list[int]
    weights: list[float] | None = None
    length: int = LENGTH
    _blocks: dict = field(default_factory=dict, repr=False)

    @property
    def queues(self) -> int:
        return len(self.totals)

    @cached_property
    def total(self) -> int:
        return sum(self.totals)

    @cached_property
    def phases(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """First place, tokens of each queue before it and tokens of each within it."""
        left = np.array(self.totals, dtype=np.int64)
        weights = np.array(self.weights or self.totals, dtype=float)
        place, out = 0, []
        while left.any():
            active = (left > 0) & (weights > 0)
            if not active.any():
                weights, active = left.astype(float), left > 0
            runs = np.where(active, left / np.where(active, weights, 1), np.inf)
            give = np.where(active, np.round(weights * runs.min()), 0).astype(np.int64)
            give = np.minimum(np.where(runs == runs.min(), left, give), left)
            out.append((place, np.array(self.totals, dtype=np.int64) - left, give))
            place += int(give.sum())
            left = left - give
        return out

    @cached_property
    def _tail(self) -> np.ndarray:
        """Ends of the sequences after the last full one."""
        full, rest = divmod(self.total, self.length)
        sizes = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
        return full * self.length + np.cumsum(sizes, dtype=np.int64)

    @property
    def sequences(self) -> int:
        return self.total // self.length + len(self._tail)

    def edges(self, numbers: np.ndarray) -> np.ndarray:
        """Tokens before each sequence; one more number than there are is the total."""
        full = self.total // self.length
        ends = np.concatenate([[full * self.length], self._tail])
        return np.where(
            numbers <= full, numbers * self.length, ends[np.clip(numbers - full, 0, len(ends) - 1)]
        )

    def served(self, places: np.ndarray) -> np.ndarray:
        """Tokens that each queue has given when so many places are filled."""
        out = np.zeros((len(places), self.queues), dtype=np.int64)
        for first, before, give in self.phases:
            inside = np.clip(places - first, 0, int(give.sum()))
            reached = places >= first
            out[reached] = before + _first_due(inside[reached], give)
        return out

    @property
    def block_size(self) -> int:
        return max(16, (1 << 17) // max(1, self.queues))

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens given before each sequence of a block, and offsets of the queues in each."""
        if number not in self._blocks:
            if len(self._blocks) >= 32:
                self._blocks.pop(next(iter(self._blocks)))
            low = number * self.block_size
            high = min(low + self.block_size, self.sequences)
            given = self.served(self.edges(np.arange(low, high + 1)))
            taken = np.diff(given, axis=0)
            self._blocks[number] = given, np.cumsum(taken, axis=1) - taken
        return self._blocks[number]

    def block_of(self, queue: int, position: int) -> int:
        """The block in which a queue gives a token."""
        low, high = 0, max(0, (self.sequences - 1) // self.block_size)
        while low < high:
            middle = (low + high + 1) // 2
            at = self.edges(np.array([middle * self.block_size]))
            if self.served(at)[0, queue] <= position:
                low = middle
            else:
                high = middle - 1
        return low

    def cut(self, queue: int, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Cut runs `at:end` of a queue's tokens at the sequences' edges.

        Columns of the result: the run's number, the piece's first token in the run,
        its length, its sequence and its offset there.
        """
        out = [np.zeros((0, 5), dtype=np.int64)]
        number = self.block_of(queue, int(at.min()))
        while True:
            given, offset = self.block(number)
            mine = given[:, queue]
            low, high = np.maximum(at, mine[0]), np.minimum(end, mine[-1])
            runs = np.flatnonzero(high > low)
            first = np.searchsorted(mine, low[runs], side="right") - 1
            count = np.searchsorted(mine, high[runs], side="left") - first
            run = np.repeat(runs, count)
            k = np.arange(len(run)) + np.repeat(first - np.cumsum(count) + count, count)
            begin = np.maximum(mine[k], low[run])
            length = np.minimum(mine[k + 1], high[run]) - begin
            piece = np.column_stack(
                [
                    run, begin - at[run], length, number * self.block_size + k,
                    offset[k, queue] + begin - mine[k],
                ]
            )
            out.append(piece[length > 0])
            if mine[-1] >= end.max():
                return np.concatenate(out)
            number += 1

    def deficits(self, sequence: int) -> np.ndarray:
        """Target less given tokens of each queue when a sequence begins, in one phase."""
        place = int(self.edges(np.array([sequence]))[0])
        share = np.array(self.totals) / max(1, self.total)
        return share * place - self.served(np.array([place]))[0]

    def sizes(self, sequences: np.ndarray) -> np.ndarray:
        return self.edges(sequences + 1) - self.edges(sequences)


def _first_due(places: np.ndarray, give: np.ndarray) -> np.ndarray:
    """How many of the first tokens to fall due belong to each queue."""
    total, some = int(give.sum()), give > 0
    size = np.where(some, give, 1).astype(float)
    time = places / max(1, total)
    counts = np.clip(np.ceil(time[:, None] * give - 0.5), 0, give).astype(np.int64)
    short = places - counts.sum(axis=1)
    while (rows := np.flatnonzero(short > 0)).size:
        due = np.where(counts[rows] < give, (counts[rows] + 0.5) / size, np.inf)
        counts[rows, due.argmin(axis=1)] += 1
        short[rows] -= 1
    while (rows := np.flatnonzero(short < 0)).size:
        due = np.where(counts[rows] > 0, (counts[rows] - 0.5) / size, -np.inf)
        last = due.shape[1] - 1 - due[:, ::-1].argmax(axis=1)
        counts[rows, last] -= 1
        short[rows] += 1
    return counts


def _queued(file: str, end: int):
    """Encode a task's documents; number the tokens of each queue from 0."""

    def run(batches):
        release()
        encoder, part, given = token_encoder(file), TaskContext.get().partitionId(), {}
        for batch in batches:
            for piece in words.slices(batch, "text", PIECE):
                flat, at = encoder(piece["text"])
                flat = np.insert(flat, at[1:], end)
                at = at + np.arange(len(at))
                sizes, starts = np.diff(at).tolist(), []
                for queue, size in zip(piece["queue"].to_pylist(), sizes, strict=True):
                    starts.append(given.get(queue, 0))
                    given[queue] = starts[-1] + size
                data, cuts = flat.astype("<u4").view(np.uint8).tobytes(), (4 * at).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(sizes), pa.int32()), piece["doc_id"],
                        piece["queue"], pa.array(sizes, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(
                            [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()
                        ),
                    ],
                    ["part", "doc_id", "queue", "doc_tokens", "queue_start", "ids"],
                )

    return run


def _cut_pieces(mixture: Mixture, number_of: dict):
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                queue = np.array([number_of[q] for q in part["queue"].to_pylist()])
                at = part["base"].to_numpy() + part["queue_start"].to_numpy()
                end = at + part["doc_tokens"].to_numpy()
                found = []
                for q in np.unique(queue):
                    rows = np.flatnonzero(queue == q)
                    pieces = mixture.cut(q, at[rows], end[rows])
                    pieces[:, 0] = rows[pieces[:, 0]]
                    found.append(pieces)
                row, start, length, sequence, offset = np.concatenate(found).T
                ids = part["ids"].to_pylist()
                spans = zip(row.tolist(), (4 * start).tolist(), (4 * length).tolist(), strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part["doc_id"].take(pa.array(row)),
                        "queue": part["queue"].take(pa.array(row)),
                        "start": start,
                        "length": length,
                        "ids": pa.array([ids[r][a : a + n] for r, a, n in spans], pa.binary()),
                        "doc_tokens": part["doc_tokens"].take(pa.array(row)),
                        "sequence_id": sequence,
                        "offset": offset,
                        "sequence_length": pa.array(mixture.sizes(sequence), pa.int32()),
                    }
                )

    return run


def pack(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: dict | None = None,
    length: int = LENGTH,
    end: int = END,
    path: str | None = None,
) -> DataFrame:
    """The pieces of all documents in their sequences.

    One row per piece: `doc_id`, `queue` (its source), `start` and `length` in the
    document's tokens, `ids` (little-endian unsigned 32-bit numbers), `doc_tokens`,
    `sequence_id`, `offset` in the sequence and `sequence_length`. A document's
    tokens are its text's ids and `end`, so that null and empty texts have one.
    `weights` gives sources their target shares. A null source is a queue of its
    own; null ids come first in the order of ids, equal ids by text; repeated rows
    are packed as often as they occur; other columns are left out. One row per
    source passes through the driver.
    """
    file = path or default_path(TOKENIZER_FILE)
    rows = df.select(
        column(df, id_column).alias("doc_id"),
        F.coalesce(column(df, text_column).cast("string"), F.lit("")).alias("text"),
        column(df, source_column).cast("string").alias("queue"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text", "queue")
    encoded = stored(
        dealt.mapInArrow(
            _queued(file, end),
            f"part int, doc_id {kind}, queue string, doc_tokens long, queue_start long, ids binary",
        ),
        "packing",
    )
    parts = encoded.groupBy("part", "queue").agg(F.sum("doc_tokens").alias("tokens"))
    # One row per task and queue.
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Stored, so that their size is known and the ids need not be dealt again.
    bases = parts.select(
        F.col("part").alias("base_part"),
        F.col("queue").alias("base_queue"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"),
    )
    bases = stored(bases, "packing_bases")
    totals = dict(encoded.groupBy("queue").agg(F.sum("doc_tokens")).collect())
    names = sorted(totals, key=lambda q: (q is not None, q or ""))
    target = None if weights is None else [float(weights.get(q, 0)) for q in names]
    mixture = Mixture([totals[q] for q in names], target, length)
    joined = encoded.join(
        bases,
        (F.col("part") == F.col("base_part")) & F.col("queue").eqNullSafe(F.col("base_queue")),
    ).select("doc_id", "queue", "doc_tokens", "queue_start", "base", "ids")
    return joined.mapInArrow(
        _cut_pieces(mixture, {q: k for k, q in enumerate(names)}),
        f"doc_id {kind}, queue string, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long, sequence_length int",
    )
