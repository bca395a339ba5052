"""Byte-level BPE by prefix dynamic programming.

The encoding of every prefix of a pre-token ends in exactly one token. That token
is, among all tokens that end there, the one that stays apart from the last token
of what is left of the prefix: the merges, done in order of rank, never join them.
One table per pre-token, the last token of each prefix, thus holds the encodings of
all prefixes. Bytes can be appended by continuing the table, and an edit leaves the
table before it as it is.

Texts are split by the pattern of the vocabulary; each match is encoded by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from boxtrail.llm import words
from boxtrail.llm.common import column, texts
from boxtrail.llm.units import UnitEncoder
from boxtrail.llm.vocabulary import default_path, ranks, split_pattern

RANK_FILE = "byte_bpe_50k.tiktoken"
_NEVER = 1 << 62


class PrefixEncoder:
    """Last-token tables over one vocabulary of ranks."""

    def __init__(self, rank_of: dict[bytes, int]):
        self.rank_of = rank_of
        self.bytes_of = {rank: token for token, rank in rank_of.items()}
        self.longest = max(map(len, rank_of), default=0)
        self.size_of = np.zeros(max(self.bytes_of, default=0) + 1, dtype=np.int64)
        for rank, token in self.bytes_of.items():
            self.size_of[rank] = len(token)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._apart = _PairCache(self._stay_apart)
        self._names = _TokenNames(rank_of)
        self._reachable = np.full(len(self.size_of), -1, dtype=np.int8)

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for a single byte.

        A token that merges never make has more or fewer parts; its second
        value is then -1.
        """
        if token not in self._halves:
            parts = [bytes([b]) for b in self.bytes_of[token]]
            while len(parts) > 2:
                joined = [
                    self.rank_of.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)
                ]
                best = min(joined)
                if best >= token:
                    break
                k = joined.index(best)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            if len(parts) == 1:
                found = None
            elif len(parts) == 2:
                found = (self.rank_of[parts[0]], self.rank_of[parts[1]])
            else:
                found = (-1, -1)
            self._halves[token] = found
        return self._halves[token]

    def reachable(self, token: int) -> bool:
        return self.halves(token) != (-1, -1)

    def apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are."""
        return bool(self._apart(np.array([left]), np.array([right]))[0])

    def _stay_apart(self, left: int, right: int) -> bool:
        """Run the merges at the border backwards in time.

        At each moment one token ends at the border and one begins there. A merge
        of the two would have come first if its rank is below that at which either
        was used up; among equal ranks the leftmost merge comes first.
        """
        bytes_of, rank_of = self.bytes_of, self.rank_of
        left_until = right_until = _NEVER
        while True:
            merged = rank_of.get(bytes_of[left] + bytes_of[right], _NEVER)
            if merged < left_until and merged <= right_until and merged != _NEVER:
                return False
            of_left, of_right = self.halves(left), self.halves(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and left > right):
                left_until, left = left, of_left[1]
            else:
                right_until, right = right, of_right[0]

    def extend(self, table: list[int], piece: bytes) -> list[int]:
        """Continue the table of a prefix of `piece` to all of it, in place."""
        rank_of, longest, apart = self.rank_of, self.longest, self.apart
        for end in range(len(table) + 1, len(piece) + 1):
            for size in range(min(end, longest), 0, -1):
                token = rank_of.get(piece[end - size : end])
                if token is None:
                    continue
                if self.reachable(token) and (
                    size == end or apart(table[end - size - 1], token)
                ):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            table.append(token)
        return table

    def tokens(self, table: Sequence[int]) -> list[int]:
        """The encoding that a table ends with."""
        out, end = [], len(table)
        while end:
            token = table[end - 1]
            out.append(token)
            end -= len(self.bytes_of[token])
        out.reverse()
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        return self.tokens(self.extend([], piece))

    def encode_pieces(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of many pieces: all of them, where each piece's begin, and how many.

        The tables of pieces of up to SHORT bytes grow together, one byte at a time.
        """
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        order = np.argsort(-np.where(sizes > SHORT, 0, sizes), kind="stable")
        short = order[: int((sizes <= SHORT).sum())]
        counts = np.zeros(len(pieces), dtype=np.int64)
        tables = self._tables([pieces[k] for k in short], sizes[short])
        steps, rows, at = [], np.arange(len(short)), sizes[short].copy()
        while len(rows):
            token = tables[rows, at[rows] - 1]
            steps.append((rows, token))
            at[rows] -= self.size_of[token]
            counts[short[rows]] += 1
            rows = rows[at[rows] > 0]
        long = {int(k): self.encode_piece(pieces[k]) for k in np.flatnonzero(sizes > SHORT)}
        for k, tokens in long.items():
            counts[k] = len(tokens)
        starts = np.cumsum(counts) - counts
        values = np.zeros(int(counts.sum()), dtype=np.int64)
        for step, (rows, token) in enumerate(steps):
            piece = short[rows]
            values[starts[piece] + counts[piece] - 1 - step] = token
        for k, tokens in long.items():
            values[starts[k] : starts[k] + counts[k]] = tokens
        return values, starts, counts

    def _tables(self, pieces: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Last-token tables of pieces sorted from long to short, one row each."""
        width = int(sizes[0]) if len(pieces) else 0
        tables = np.full((len(pieces), max(1, width)), -1, dtype=np.int64)
        names = self._names.prefixes(pieces, width)
        for end in range(1, width + 1):
            rows = np.arange(int(np.searchsorted(-sizes, -end, side="right")))
            for size in range(1, min(end, self.longest) + 1):
                token = self._names.find(names, rows, end - size, end)
                known = token >= 0
                known[known] = self._all_reachable(token[known])
                if size < end:
                    tried = np.flatnonzero(known)
                    before = tables[rows[tried], end - size - 1]
                    known[tried] = self._apart(before, token[tried])
                tables[rows[known], end - 1] = token[known]
                rows = rows[~known]
                if not len(rows):
                    break
            if len(rows):
                raise ValueError("the vocabulary lacks a byte")
        return tables

    def _all_reachable(self, tokens: np.ndarray) -> np.ndarray:
        found = self._reachable[tokens]
        if (found < 0).any():
            for token in np.unique(tokens[found < 0]).tolist():
                self._reachable[token] = self.reachable(token)
            found = self._reachable[tokens]
        return found.astype(bool)


#: Longest piece, in bytes, whose table is made together with others'.
SHORT = 32


class _TokenNames:
    """Tokens by 64-bit polynomials of their bytes, for many substrings at once."""

    _BASE = 0x9E3779B97F4A7C15

    def __init__(self, rank_of: dict[bytes, int]):
        short = [(token, rank) for token, rank in rank_of.items() if len(token) <= SHORT]
        short.sort(key=lambda one: -len(one[0]))
        self._power = np.full(SHORT + 1, self._BASE, dtype=np.uint64)
        self._power[0] = 1
        self._power = np.multiply.accumulate(self._power)
        sizes = np.array([len(token) for token, _ in short], dtype=np.int64)
        prefixes = self.prefixes([token for token, _ in short], int(sizes[0]) if short else 0)
        names = prefixes[np.arange(len(short)), sizes]
        order = np.argsort(names)
        self._names = names[order]
        self._ranks = np.array([rank for _, rank in short], dtype=np.int64)[order]
        if (np.diff(self._names.view(np.int64)) == 0).any():
            raise ValueError("two tokens have one name")

    def prefixes(self, pieces: list[bytes], width: int) -> np.ndarray:
        """Names of all prefixes of each piece; those past its end mean nothing."""
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
        data = data.reshape(len(pieces), width)
        out = np.zeros((len(pieces), width + 1), dtype=np.uint64)
        for k in range(width):
            out[:, k + 1] = out[:, k] * np.uint64(self._BASE) + data[:, k] + np.uint64(1)
        return out

    def find(self, prefixes: np.ndarray, rows: np.ndarray, low: int, high: int) -> np.ndarray:
        """The tokens that the bytes `low:high` of some rows are; -1 where none."""
        name = prefixes[rows, high] - prefixes[rows, low] * self._power[high - low]
        at = np.minimum(np.searchsorted(self._names, name), len(self._names) - 1)
        return np.where(self._names[at] == name, self._ranks[at], -1)


class _PairCache:
    """Answers for pairs of tokens, as many as there are slots."""

    SLOTS = 1 << 20

    def __init__(self, answer):
        self._answer = answer
        self._keys = np.full(self.SLOTS, -1, dtype=np.int64)
        self._values = np.zeros(self.SLOTS, dtype=bool)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        slot = ((key.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)).astype(
            np.int64
        )
        missing = self._keys[slot] != key
        if not missing.any():
            return self._values[slot]
        found = self._values[slot]
        new, back = np.unique(key[missing], return_inverse=True)
        answers = np.array([self._answer(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()], bool)
        found[missing] = answers[back]
        self._keys[slot[missing]] = key[missing]
        self._values[slot[missing]] = answers[back]
        return found


#: White space runs and contractions look at up to two characters after a match.
LOOKAHEAD = 2


class EncodedText:
    """A text, its pre-tokens and their tables; edits redo only what they touch."""

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.pieces: list[str] = []
        self.tables: list[list[int]] = []
        #: Bytes whose last token has been worked out, over all edits.
        self.worked = 0
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put `new` in the place of the characters `start:end`."""
        if not 0 <= start <= end <= len(self.text):
            raise ValueError("the edit lies outside the text")
        old_starts = np.cumsum([0, *map(len, self.pieces)]).tolist()
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        kept = 0
        while kept < len(self.pieces) and old_starts[kept + 1] + LOOKAHEAD <= start:
            kept += 1
        again = {old_starts[k]: k for k in range(kept, len(self.pieces)) if old_starts[k] >= end}
        pieces, tables = self.pieces[:kept], self.tables[:kept]
        at = old_starts[kept]
        matches = split_pattern().finditer(text, at)
        first = True
        while at < len(text):
            same = again.get(at - shift)
            if same is not None and at >= start + len(new):
                pieces += self.pieces[same:]
                tables += self.tables[same:]
                break
            match = next(matches)
            piece = match.group().encode()
            table: list[int] = []
            if first and kept < len(self.pieces):
                table = self.tables[kept][: _common(self.pieces[kept].encode(), piece)]
            first = False
            self.worked += len(piece) - len(table)
            pieces.append(match.group())
            tables.append(self.encoder.extend(table, piece))
            at = match.end()
        self.text, self.pieces, self.tables = text, pieces, tables

    def ids(self) -> list[int]:
        return [token for table in self.tables for token in self.encoder.tokens(table)]


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


@cache
def prefix_encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(ranks(path))


@cache
def _unit_encoder(path: str) -> UnitEncoder:
    encoder, pattern = prefix_encoder(path), split_pattern()

    def encode(units):
        pieces = [pattern.findall(unit) for unit in units]
        number = {p: k for k, p in enumerate(dict.fromkeys(p for one in pieces for p in one))}
        values, starts, counts = encoder.encode_pieces([p.encode() for p in number])
        at = np.array([number[p] for one in pieces for p in one], dtype=np.int64)
        ends = np.cumsum(counts[at])
        flat = np.repeat(starts[at] - ends + counts[at], counts[at])
        flat += np.arange(len(flat))
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, pieces)])]
        return values[flat], cuts[:-1], np.diff(cuts)

    return UnitEncoder(encode)


@cache
def _speller(path: str) -> Callable[[bytes], bytes]:
    token = prefix_encoder(path).bytes_of
    bytes_of = [token.get(k, b"") for k in range(max(token) + 1)].__getitem__
    return lambda ids: b"".join(map(bytes_of, np.frombuffer(ids, "<u4").tolist()))


def encode(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    decoded: bool = False,
) -> DataFrame:
    """`doc_id`, `n_tokens` and `ids` of every row; `decoded` adds what these decode to.

    `ids` is binary: little-endian unsigned 32-bit numbers. A null or empty text
    has no ids. Rows are independent: repeated rows come out repeated, null ids
    stay null, other columns are left out. Strings of special tokens are plain
    text. There is no shuffle.
    """
    file = path or default_path(RANK_FILE)

    def run(batches):
        encoder, spell = _unit_encoder(file), _speller(file)
        for batch in batches:
            for part in words.slices(batch, "text"):
                flat, at = encoder(part["text"])
                data = flat.astype("<u4").tobytes()
                cuts = at.tolist()
                ids = [data[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]
                columns = {
                    "doc_id": part["doc_id"],
                    "n_tokens": pa.array(np.diff(at), pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                }
                if decoded:
                    columns["decoded"] = pa.array(map(spell, ids), pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    source = texts(df, id_column, text_column)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids binary" + ", decoded binary" * decoded
    return source.mapInArrow(run, schema)


def decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """Add `decoded`, the bytes that a column `ids`, as made by `encode`, stands for.

    Null ids decode to null. Bytes need not be whole characters.
    """
    file = path or default_path(RANK_FILE)

    def run(batches):
        spell = _speller(file)
        for batch in batches:
            for part in words.slices(batch, "ids"):
                decoded = [None if x is None else spell(x) for x in part["ids"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())],
                    [*part.schema.names, "decoded"],
                )

    schema = StructType([*df.schema.fields, StructField("decoded", BinaryType())])
    return df.mapInArrow(run, schema)


def edit(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    start_column: str = "start",
    end_column: str = "end",
    new_column: str = "new",
    path: str | None = None,
) -> DataFrame:
    """Encode texts, replace characters `start:end` by `new`, and re-encode near the edit.

    Returns `doc_id`, `n_tokens` and `ids` after the edit, and `worked`, the bytes
    whose table entries the edit has redone. Null texts and insertions are empty;
    null or too large positions are the text's end, so that an edit with null
    positions appends.
    """
    file = path or default_path(RANK_FILE)

    def run(batches):
        encoder = prefix_encoder(file)
        for batch in batches:
            for part in words.slices(batch, "text"):
                counts, binary, worked = [], [], []
                for text, start, end, new in zip(
                    *(part[c].to_pylist() for c in ("text", "start", "end", "new")), strict=True
                ):
                    size = len(text)
                    low = size if start is None else min(max(start, 0), size)
                    high = size if end is None else min(max(end, low), size)
                    encoded = EncodedText(encoder, text)
                    before = encoded.worked
                    encoded.replace(low, high, new)
                    ids = encoded.ids()
                    counts.append(len(ids))
                    binary.append(np.array(ids, "<u4").tobytes())
                    worked.append(encoded.worked - before)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"], pa.array(counts, pa.int64()),
                        pa.array(binary, pa.binary()), pa.array(worked, pa.int64()),
                    ],
                    ["doc_id", "n_tokens", "ids", "worked"],
                )

    source = df.select(
        column(df, id_column).alias("doc_id"),
        F.coalesce(column(df, text_column).cast("string"), F.lit("")).alias("text"),
        column(df, start_column).cast("long").alias("start"),
        column(df, end_column).cast("long").alias("end"),
        F.coalesce(column(df, new_column).cast("string"), F.lit("")).alias("new"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, worked long")
