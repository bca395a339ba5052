"""Encodings of texts by way of a vocabulary of their space-separated units.

The split pattern of a byte-level BPE never reaches across a border between a
character that is not white space and one that is. A text can be cut at these
borders, and equal pieces (units) have equal encodings wherever they stand. A task
encodes each unit once and puts texts together from numpy arrays.

Units are known by a 64-bit hash of their bytes: among a million known units, an
unknown one is taken for another with probability 5e-14.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa

from boxtrail.llm import words

#: Units kept between batches; the seldom used half goes when there are more.
LIMIT = 700_000

#: ASCII white space, and first bytes of characters that may be other white space.
_SPACE = words.WORDS == 0
_TWO = np.zeros(256, dtype=bool)
_TWO[0xC2] = True
_THREE = np.zeros(256, dtype=bool)
_THREE[0xE1:0xE4] = True

_U = np.uint64


def unit_starts(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin: texts, and white space after a character that is none.

    Behind a character that may be white space outside ASCII none begins; longer
    units are as good.
    """
    n = len(buffer)
    space = _SPACE[buffer]
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[2:] &= ~_TWO[buffer[:-2]]
    start[3:] &= ~_THREE[buffer[:-3]]
    start[offsets[offsets < n]] = True
    return np.flatnonzero(start)


class _Table:
    """Numbers of hashes: open addressing in numpy arrays."""

    def __init__(self, bits: int):
        self._shift, self._mask = _U(64 - bits), (1 << bits) - 1
        self._keys = np.zeros(1 << bits, dtype=np.uint64)
        self._numbers = np.zeros(1 << bits, dtype=np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9FB21C651E98DF25)) >> self._shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of keys; -1 for unknown ones."""
        slots = self._slots(keys)
        seen = self._keys[slots]
        out = np.where(seen == keys, self._numbers[slots], -1).astype(np.int64)
        open_ = np.flatnonzero((seen != keys) & (seen != 0))
        slots = slots[open_]
        while len(open_):
            slots = (slots + 1) & self._mask
            seen, wanted = self._keys[slots], keys[open_]
            hit = seen == wanted
            out[open_[hit]] = self._numbers[slots[hit]]
            go = ~hit & (seen != 0)
            open_, slots = open_[go], slots[go]
        return out

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Put in distinct keys that are not there."""
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self._keys[slots] == 0)
            self._keys[slots[free]] = keys[free]
            done = self._keys[slots] == keys
            self._numbers[slots[done]] = numbers[done]
            keys, numbers = keys[~done], numbers[~done]
            slots = (slots[~done] + 1) & self._mask


class UnitEncoder:
    """Encodes texts through `encode`, which gets lists of unseen units.

    `encode` returns an array of numbers, and for each unit where its numbers begin
    in it and how many they are.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]],
        dtype=np.uint32,
        limit: int = LIMIT,
    ):
        self._encode, self._limit = encode, limit
        self._bits = (2 * limit).bit_length()
        self._table = _Table(self._bits)
        self._values = np.empty(0, dtype=dtype)
        self._start, self._length, self._uses = np.zeros((3, 0), dtype=np.int64)
        self._names = np.zeros(0, dtype=np.uint64)
        self._known = self._size = 0

    def __call__(self, texts: pa.Array | Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All numbers of all texts, and where each text's begin (one more at the end)."""
        if not isinstance(texts, (pa.Array, pa.ChunkedArray)):
            texts = pa.array(texts, pa.string())
        buffer, offsets = words.text_buffer(texts)
        starts = unit_starts(buffer, offsets)
        first = np.searchsorted(starts, offsets)
        ends = np.append(starts[1:], len(buffer))[: len(starts)]
        names = words.Words(buffer, starts, ends, first).hashes() | _U(1)
        at = self._table.find(names)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new, place, back = np.unique(names[unknown], return_index=True, return_inverse=True)
            place = unknown[place]
            raw = buffer.tobytes()
            spans = zip(starts[place].tolist(), ends[place].tolist(), strict=True)
            at[unknown] = self._known + back
            self._learn(new, [raw[a:b].decode() for a, b in spans])
        np.add.at(self._uses, at, 1)
        lengths = self._length[at]
        sums = np.zeros(len(at) + 1, dtype=np.int64)
        np.cumsum(lengths, out=sums[1:])
        flat = np.repeat(self._start[at] - sums[:-1], lengths)
        flat += np.arange(len(flat))
        out = self._values[flat], sums[first]
        if self._known > self._limit:
            self._forget()
        return out

    def _learn(self, names: np.ndarray, units: list[str]) -> None:
        values, starts, lengths = self._encode(units)
        count, total = self._known, self._known + len(units)
        size = self._size + len(values)
        if total > self._limit * 3 // 2:  # a very large batch
            bits = max(self._bits, (2 * total).bit_length())
            table = _Table(bits)
            table.add(self._names[:count], np.arange(count, dtype=np.int32))
            self._table = table
        self._values = _grown(self._values, size)
        self._start, self._length, self._uses, self._names = (
            _grown(x, total) for x in (self._start, self._length, self._uses, self._names)
        )
        self._values[self._size : size] = values
        self._start[count:total] = self._size + starts
        self._length[count:total] = lengths
        self._uses[count:total] = 0
        self._names[count:total] = names
        self._table.add(names, np.arange(count, total, dtype=np.int32))
        self._known, self._size = total, size

    def _forget(self) -> None:
        """Keep the more often used units, half the limit."""
        kept = np.sort(
            np.argsort(-self._uses[: self._known], kind="stable")[: self._limit // 2]
        )
        lengths = self._length[kept]
        starts = np.cumsum(lengths) - lengths
        flat = np.repeat(self._start[kept] - starts, lengths) + np.arange(int(lengths.sum()))
        self._values, self._size = self._values[flat], len(flat)
        self._start, self._length = starts, lengths
        self._uses, self._names = self._uses[kept] >> 1, self._names[kept]
        self._known = len(kept)
        self._table = _Table(self._bits)
        self._table.add(self._names, np.arange(len(kept), dtype=np.int32))


def _grown(x: np.ndarray, size: int) -> np.ndarray:
    if size <= len(x):
        return x
    out = np.zeros(max(size, 2 * len(x)), dtype=x.dtype)
    out[: len(x)] = x
    return out
