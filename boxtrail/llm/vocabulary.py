"""Public vocabulary files, opened once per Python worker."""

from __future__ import annotations

import base64
import os
from functools import cache

import numpy as np

from boxtrail.llm.units import UnitEncoder

#: Units encoded as one text.
CHAIN = 500


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def split_pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


@cache
def tokenizer(path: str):
    """A tokenizer file; strings of special tokens in a text are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


def _joined(units: list[str]) -> tuple[np.ndarray, list[str]]:
    """Units put together to fewer texts, and their numbers in the order of these.

    Units that begin with white space and do not end with it can follow each other
    without changing each other's encoding.
    """
    chain = np.array([u[0] in " \n" and not u[-1].isspace() for u in units], dtype=bool)
    chained, alone = np.flatnonzero(chain), np.flatnonzero(~chain)
    texts = [
        "".join([units[j] for j in chained[k : k + CHAIN].tolist()])
        for k in range(0, len(chained), CHAIN)
    ]
    return np.concatenate([chained, alone]), texts + [units[j] for j in alone.tolist()]


def _placed(order: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths by unit from the ends of units in another order."""
    starts, lengths = np.empty((2, len(order)), dtype=np.int64)
    lengths[order] = np.diff(ends, prepend=0)
    starts[order] = ends - lengths[order]
    return starts, lengths


def _bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


@cache
def _token_sizes(path: str) -> np.ndarray:
    """Bytes of each token; one character of its name stands for one byte."""
    names = tokenizer(path).get_vocab()
    size = np.zeros(max(names.values()) + 1, dtype=np.int64)
    for name, number in names.items():
        size[number] = len(name)
    return size


def _encoded(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and the bytes up to the end of each."""
    found = tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)
    ids = np.concatenate(
        [np.empty(0, np.int64), *(np.array(one.ids, dtype=np.int64) for one in found)]
    )
    return ids, np.cumsum(_token_sizes(path)[ids])


@cache
def token_encoder(path: str) -> UnitEncoder:
    """Texts to ids by a tokenizer file."""

    def encode(units):
        order, texts = _joined(units)
        ids, reached = _encoded(path, texts)
        ends = np.cumsum([_bytes(units[k]) for k in order.tolist()])
        return ids, *_placed(order, np.searchsorted(reached, ends) + 1)

    return UnitEncoder(encode)


@cache
def token_counts(path: str) -> UnitEncoder:
    """Texts to their pre-tokens: characters * 2**32 + tokens of each."""
    pattern = split_pattern()

    def encode(units):
        order, texts = _joined(units)
        _, reached = _encoded(path, texts)
        pieces = [piece for text in texts for piece in pattern.findall(text)]
        chars = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        size = np.fromiter(map(_bytes, pieces), dtype=np.int64, count=len(pieces))
        tokens = np.diff(np.searchsorted(reached, np.cumsum(size), side="right"), prepend=0)
        ends = np.cumsum([len(units[k]) for k in order.tolist()])
        cuts = np.searchsorted(np.cumsum(chars), ends) + 1
        return (chars << 32) + tokens, *_placed(order, cuts)

    return UnitEncoder(encode, np.int64)


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
