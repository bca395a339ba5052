"""Token counts that follow edits.

Each text keeps a segment tree over its pre-tokens: a leaf holds the characters and
tokens of one pre-token, an inner node the sums of its two children. An edit finds
the leaves it touches by their characters, splits and encodes only these and the
few around them that the split pattern may look at, stores the result in their
leaves and adds up the sums on the way to the root.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from boxtrail.llm import words
from boxtrail.llm.common import column
from boxtrail.llm.vocabulary import default_path, split_pattern, token_counts

TOKENIZER_FILE = "byte_bpe_50k.json"
#: White space runs and contractions look at up to two characters after a match.
LOOKAHEAD = 2
_LOW = (1 << 32) - 1


class CountTree:
    """Sums of characters and tokens over the pre-tokens of one text.

    A leaf may come to hold several pre-tokens, or none: the tree keeps its shape.
    Leaves always begin where a pre-token begins.
    """

    def __init__(self, leaves: np.ndarray):
        """`leaves` has characters * 2**32 + tokens of each pre-token."""
        self.width = max(1, 1 << max(0, len(leaves) - 1).bit_length())
        self.sums = np.zeros(2 * self.width, dtype=np.int64)
        self.sums[self.width : self.width + len(leaves)] = leaves
        low = self.width
        while low > 1:
            level = self.sums[low : 2 * low]
            self.sums[low // 2 : low] = level[::2] + level[1::2]
            low //= 2

    @classmethod
    def from_bytes(cls, data: bytes) -> CountTree:
        """Read back what `to_bytes` wrote."""
        tree = cls.__new__(cls)
        tree.sums = np.frombuffer(data, dtype="<i8").copy()
        tree.width = len(tree.sums) // 2
        return tree

    def to_bytes(self) -> bytes:
        return self.sums.astype("<i8").tobytes()

    @property
    def n_chars(self) -> int:
        return int(self.sums[1]) >> 32

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1]) & _LOW

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and the leaf's first character.

        A position at or after the end gives the last leaf that is not empty.
        """
        position = min(position, self.n_chars - 1)
        node, start = 1, 0
        while node < self.width:
            node *= 2
            chars = int(self.sums[node]) >> 32
            if position - start >= chars:
                start += chars
                node += 1
        return node - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.width
        change = (chars << 32) + tokens - int(self.sums[node])
        while node:
            self.sums[node] += change
            node //= 2

    def replace(
        self, text: str, start: int, end: int, new: str, count: Callable[[list[str]], int]
    ) -> tuple[str, int]:
        """Replace characters `start:end` of `text`, whose tree this is.

        `count` gives the tokens of some pre-tokens. Returns the new text and the
        characters counted again.
        """
        if not 0 <= start <= end <= len(text):
            raise ValueError("the edit lies outside the text")
        after = text[:start] + new + text[end:]
        shift = len(new) - (end - start)
        if not text:
            self.put(0, len(after), count(split_pattern().findall(after)))
            return after, len(after)
        # From a leaf after which the unchanged text goes on beyond the lookahead.
        leaf, low = self.leaf_at(max(0, start - LOOKAHEAD))
        last, at = self.leaf_at(end)
        high = at + (int(self.sums[last + self.width]) >> 32)
        if end >= len(text):
            last, high = self.width - 1, len(text)
        pieces, tail = [], low
        # Split on until a border falls on a border of the old leaves.
        for match in split_pattern().finditer(after, low):
            pieces.append(match.group())
            tail = match.end()
            while last < self.width - 1 and high + shift < tail:
                last += 1
                high += int(self.sums[last + self.width]) >> 32
            if tail >= start + len(new) and tail == high + shift:
                break
        for k in range(leaf + 1, last + 1):
            if self.sums[k + self.width]:
                self.put(k, 0, 0)
        self.put(leaf, tail - low, count(pieces))
        return after, tail - low


def _counter(path: str) -> Callable[[list[str]], int]:
    encoder = token_counts(path)
    return lambda pieces: int((encoder(pieces)[0] & _LOW).sum())


def trees(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    keep: dict | None = None,
) -> DataFrame:
    """`doc_id`, `text`, `n_tokens` and `tree`, the stored tree, of every row.

    `keep` adds columns by name. A null text is empty and has no tokens. Rows are
    independent: repeated rows come out repeated, null ids stay null, other columns
    are left out.
    """
    file, extra = path or default_path(TOKENIZER_FILE), list(keep or {})

    def run(batches):
        encoder = token_counts(file)
        for batch in batches:
            for part in words.slices(batch, "text"):
                leaves, at = encoder(part["text"].to_pylist())
                found = [CountTree(leaves[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"], part["text"],
                        pa.array([t.n_tokens for t in found], pa.int64()),
                        pa.array([t.to_bytes() for t in found], pa.binary()),
                        *[part[c] for c in extra],
                    ],
                    ["doc_id", "text", "n_tokens", "tree", *extra],
                )

    source = df.select(
        column(df, id_column).alias("doc_id"),
        F.coalesce(column(df, text_column).cast("string"), F.lit("")).alias("text"),
        *[value.alias(name) for name, value in (keep or {}).items()],
    )
    schema = StructType(
        [
            source.schema["doc_id"], source.schema["text"],
            StructField("n_tokens", LongType()), StructField("tree", BinaryType()),
            *[source.schema[c] for c in extra],
        ]
    )
    return source.mapInArrow(run, schema)


def _edited(rows, count) -> dict:
    """Apply an edit to each of (text, tree, start, end, new); columns of the outcome."""
    texts, tokens, stored, again, before = [], [], [], [], []
    for text, tree, start, end, new in rows:
        size = len(text)
        low = size if start is None else min(max(start, 0), size)
        high = size if end is None else min(max(end, low), size)
        before.append(tree.n_tokens)
        text, redone = tree.replace(text, low, high, new or "", count)
        texts.append(text)
        tokens.append(tree.n_tokens)
        stored.append(tree)
        again.append(redone)
    return {
        "text": pa.array(texts, pa.string()),
        "n_tokens": pa.array(tokens, pa.int64()),
        "n_tokens_before": pa.array(before, pa.int64()),
        "n_recounted": pa.array(again, pa.int64()),
        "tree": stored,
    }


_EDIT = ("start", "end", "new")


def apply_edits(df: DataFrame, path: str | None = None) -> DataFrame:
    """Apply one edit to each row of `trees` that has `start`, `end` and `new` added.

    Returns `doc_id`, `text`, `n_tokens`, `n_tokens_before`, `n_recounted`, the
    characters that were split and encoded again, and `tree` after the edit. Positions
    are characters; null or too large ones are the text's end, a null `new` is empty.
    """
    file = path or default_path(TOKENIZER_FILE)

    def run(batches):
        count = _counter(file)
        for batch in batches:
            for part in words.slices(batch, "text"):
                trees = [CountTree.from_bytes(x) for x in part["tree"].to_pylist()]
                edits = (part[c].to_pylist() for c in _EDIT)
                found = _edited(zip(part["text"].to_pylist(), trees, *edits, strict=True), count)
                found["tree"] = pa.array([t.to_bytes() for t in found["tree"]], pa.binary())
                yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], **found})

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", "text", "tree", *_EDIT).mapInArrow(
        run,
        f"doc_id {kind}, text string, n_tokens long, n_tokens_before long, n_recounted long, "
        "tree binary",
    )


def count_edited(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    start_column: str = "start",
    end_column: str = "end",
    new_column: str = "new",
    path: str | None = None,
) -> DataFrame:
    """`trees` and `apply_edits` in one task, without the trees in between.

    Returns the columns of `apply_edits` but `tree`. Null texts are empty, repeated
    rows come out repeated, null ids stay null, other columns are left out.
    """
    file = path or default_path(TOKENIZER_FILE)

    def run(batches):
        encoder, count = token_counts(file), _counter(file)
        for batch in batches:
            for part in words.slices(batch, "text"):
                texts = part["text"].to_pylist()
                leaves, at = encoder(texts)
                trees = (CountTree(leaves[a:b]) for a, b in zip(at[:-1], at[1:], strict=True))
                edits = (part[c].to_pylist() for c in _EDIT)
                found = _edited(zip(texts, trees, *edits, strict=True), count)
                del found["tree"]
                yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], **found})

    source = df.select(
        column(df, id_column).alias("doc_id"),
        F.coalesce(column(df, text_column).cast("string"), F.lit("")).alias("text"),
        column(df, start_column).cast("long").alias("start"),
        column(df, end_column).cast("long").alias("end"),
        column(df, new_column).cast("string").alias("new"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"doc_id {kind}, text string, n_tokens long, n_tokens_before long, n_recounted long",
    )
