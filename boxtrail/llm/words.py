"""Words of texts and their hashes, for whole Arrow columns at a time.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. Texts are UTF-8; a null text has no words. Hashes are
64 bits wide and depend on the bytes alone, so every task of every run agrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of text hashed at once.
BLOCK = 1 << 20
#: Bytes of text taken from an Arrow batch at once; a longer text comes alone.
SLICE = 4 << 20

_U = np.uint64
#: Kinds of bytes: space or not; space, letters and the like, or punctuation.
WORDS = np.ones(256, dtype=np.uint8)
WORDS[list(SPACES)] = 0
WORDS_AND_MARKS = WORDS.copy()
WORDS_AND_MARKS[[c for c in range(33, 128) if not chr(c).isalnum()]] = 2


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits; one to one."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, BLOCK + 1)
_INV = _powers(pow(_BASE, -1, 1 << 64), BLOCK + 1)


@dataclass
class Words:
    """The words of some texts; `first[d]:first[d + 1]` are those of text d."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One hash per word; `lower` takes A-Z as a-z."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(out):
            low = int(self.starts[at])
            to = max(at + 1, int(np.searchsorted(self.ends, low + BLOCK, side="right")))
            high = int(self.ends[to - 1])
            out[at:to] = _polynomial(
                self.buffer[low:high], self.starts[at:to] - low, self.ends[at:to] - low, lower
            )
            at = to
        return out


def _polynomial(buffer, starts, ends, lower: bool) -> np.ndarray:
    n = len(buffer)
    power, inverse = _POW, _INV
    if n > BLOCK:  # one very long word
        power, inverse = _powers(_BASE, n + 1), _INV
        starts = np.zeros_like(starts)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[buffer] * power[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_string(texts.type) and not pa.types.is_binary(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    low = int(offsets[0]) if len(offsets) else 0
    high = int(offsets[-1]) if len(offsets) else 0
    return data[low:high], (offsets - low).astype(np.int64)


def split(buffer: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = WORDS) -> Words:
    """Runs of bytes of one kind, each within one text; kind 0 lies between words."""
    n = len(buffer)
    kind = kinds[buffer]
    change = np.ones(n + 1, dtype=bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets[offsets < n]] = True
    starts = np.flatnonzero(change[:-1] & (kind != 0))
    ends = np.flatnonzero(change[1:] & (kind != 0)) + 1
    return Words(buffer, starts, ends, np.searchsorted(starts, offsets))


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Runs of rows with up to `size` bytes of text, one row at least."""
    if batch.num_rows == 0:
        return
    _, offsets = text_buffer(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def of_column(texts: pa.Array, kinds: np.ndarray = WORDS) -> Words:
    return split(*text_buffer(texts), kinds)


def windows(hashes: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all runs of `length` words of one text.

    Returns the hashes and the index of each window's first word.
    """
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    m = n - length + 1
    rolled = hashes[:m].copy()
    for k in range(1, length):
        rolled *= _U(_BASE)
        rolled += hashes[k : k + m]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:m] == text[length - 1 :])
    return mix(rolled[at]), at


def sequence(hashes: np.ndarray) -> int:
    """Hash of a whole run of words, for runs shorter than a window."""
    value = 0
    for x in hashes.tolist():
        value = (value * _BASE + x) & _MASK
    return int(mix(np.array([value ^ (len(hashes) << 56)], dtype=np.uint64))[0])
