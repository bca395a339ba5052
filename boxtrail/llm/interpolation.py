"""Log probabilities of texts under an n-gram model with deleted interpolation.

A text is its words and one end token. The probability of a token after a context is
mixed from the lowest order to the highest: at each order the share of the context's
occurrences that the token follows gets a weight, and what the lower orders say gets the
rest; below the single tokens there is an equal share for each known token and one for
all unknown. The weight depends on the order and on how often the context occurs, in
buckets of powers of two. An unseen context has weight 0. An end token also opens each
text, so the first token has a context.

Weights are learned by expectation-maximisation on texts that are left out of the
counts (the deleted part of the training texts); afterwards all training texts count.

N-grams are 64-bit hashes. Documents are dealt to blocks of `BLOCK_BYTES` of text by
a hash, and the n-grams of a block are sent once each, in order, with their counts
there. The range of hashes is cut into as many buckets as there are blocks. A bucket
adds up the counts of its n-grams and answers each block in the order it was asked, so
that answers need no n-grams. A block with all its answers writes the counts of each
document's n-grams. Learning and scoring read these. A hot n-gram so costs one entry per
block, whatever its occurrences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BinaryType, DoubleType, IntegerType, LongType, StructField, StructType,
)

from boxtrail.llm import words
from boxtrail.llm.common import column, release, stored

ORDER = 2
BLOCK_BYTES = 16 << 20
#: Rounds of expectation-maximisation.
ROUNDS = 8
#: Occurrences that a weight of one half is taken to rest on before any are seen.
PRIOR = 2.0
#: Buckets of context counts, by powers of two; the first is for none.
LEVELS = 64

#: What a text is to the model.
SCORED, COUNTED, DELETED = 0, 1, 2

_U = np.uint64
_END = _U(0x5851F42D4C957F2D)
_STEP = _U(0x9FB21C651E98DF25)


def _bytes_of(values: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, without those planes that are all zero."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    width = max((k + 1 for k in range(8) if planes[k].any()), default=0)
    return bytes([width]) + planes[:width].tobytes()


def _values_of(data, n: int) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    planes = np.zeros((8, n), dtype=np.uint8)
    planes[: raw[0]] = raw[1:].reshape(raw[0], n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


class _Grams:
    """The n-grams of some texts; `keys` are theirs, each once and in order.

    The lowest bit of a key is 1 for single tokens. `at[k]` are the places in `keys` of
    the n-grams of order k + 1 by token, -1 where a text has none so early.
    """

    def __init__(self, texts: pa.Array, order: int):
        found = words.of_column(texts)
        n = found.counts
        self.n_tokens = n + 1
        size = n + 2  # with an end token on either side
        start = np.cumsum(size) - size
        tokens = np.full(int(size.sum()), _END, dtype=_U)
        inside = np.arange(len(found.starts)) + np.repeat(start + 1 - found.first[:-1], n)
        tokens[inside] = found.hashes(lower=True)
        place = np.arange(len(tokens)) - np.repeat(start, size)
        real = place > 0
        grams, keys = tokens, []
        for k in range(order):
            if k:
                grams = np.concatenate([grams[:1], words.mix(grams[:-1] * _STEP + tokens[1:])])
            key = (grams << _U(1)) | _U(k == 0)
            keys.append((key[real], place[real] >= k))
        every = np.concatenate([key[there] for key, there in keys])
        self.keys, back = np.unique(every, return_inverse=True)
        self.at, low = [], 0
        for key, there in keys:
            at = np.full(len(key), -1, dtype=np.int64)
            at[there] = back[low : low + int(there.sum())]
            low += int(there.sum())
            self.at.append(at)
        self.owner = np.repeat(np.arange(len(n)), self.n_tokens)
        self.first = np.cumsum(self.n_tokens) - self.n_tokens

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """How often each n-gram occurs in the chosen texts."""
        total = np.zeros(len(self.keys), dtype=np.int64)
        mine = chosen[self.owner]
        for at in self.at:
            total += np.bincount(at[mine & (at >= 0)], minlength=len(total))
        return total


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket starts in ordered keys, and the end."""
    edge = np.array([(b << 64) // buckets for b in range(buckets)], dtype=_U)
    return np.append(np.searchsorted(keys, edge), len(keys))


def _asked(order: int, buckets: int):
    """A block's n-grams by bucket with their counts in the block."""

    def run(docs: pa.Table) -> pa.Table:
        release()
        part = docs["part"].to_numpy()
        grams = _Grams(docs["text"].combine_chunks(), order)
        trained, deleted = grams.counts(part > 0), grams.counts(part == DELETED)
        cuts = _cuts(grams.keys, buckets)
        rows = {"bucket": [], "n": [], "keys": [], "trained": [], "deleted": []}
        for b, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if high > low:
                rows["bucket"].append(b)
                rows["n"].append(high - low)
                rows["keys"].append(_bytes_of(np.diff(grams.keys[low:high], prepend=_U(0))))
                rows["trained"].append(_bytes_of(trained[low:high]))
                rows["deleted"].append(_bytes_of(deleted[low:high]))
        block = docs["block"].to_numpy()[:1].repeat(len(rows["n"]))
        return pa.table({"block": block, **rows}, schema=_ASKED)

    return run


_ASKED = pa.schema(
    [
        ("block", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()),
        ("keys", pa.binary()), ("trained", pa.binary()), ("deleted", pa.binary()),
    ]
)
_ANSWERED = pa.schema(
    [
        ("block", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()),
        ("trained", pa.binary()), ("deleted", pa.binary()), ("known", pa.int64()),
    ]
)
_ASKED_SQL = "block int, bucket int, n long, keys binary, trained binary, deleted binary"
_ANSWERED_SQL = "block int, bucket int, n long, trained binary, deleted binary, known long"


def _answered(asked: pa.Table) -> pa.Table:
    """Counts of a bucket's n-grams over all blocks, to each block in its order.

    `known` counts the known tokens of which this block is the first to tell.
    """
    release()
    sizes = asked["n"].to_pylist()

    def read(name: str) -> list[np.ndarray]:
        return [_values_of(x.as_buffer(), n) for x, n in zip(asked[name], sizes, strict=True)]

    keys = np.concatenate([np.cumsum(x, dtype=_U) for x in read("keys")])
    block = np.repeat(np.arange(len(sizes)), sizes)
    unique, at = np.unique(keys, return_inverse=True)
    total = {}
    for name in ("trained", "deleted"):
        every = np.concatenate(read(name)).astype(np.int64)
        total[name] = np.zeros(len(unique), dtype=np.int64)
        np.add.at(total[name], at, every)
    teller = np.full(len(unique), len(sizes))
    np.minimum.at(teller, at, block)
    counts = (unique & _U(1) == 1) & (total["trained"] > 0)
    known = np.bincount(teller[counts], minlength=len(sizes))
    ends = np.cumsum(sizes)
    out = {
        name: [_bytes_of(value[at[end - n : end]]) for n, end in zip(sizes, ends, strict=True)]
        for name, value in total.items()
    }
    return pa.table(
        {"block": asked["block"], "bucket": asked["bucket"], "n": asked["n"], **out, "known": known},
        schema=_ANSWERED,
    )


def _joined(order: int):
    """The counts of each document's n-grams, from the answers to its block."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        docs = docs.combine_chunks()
        grams = _Grams(docs["text"].combine_chunks(), order)
        answers = answers.sort_by("bucket")
        sizes = answers["n"].to_pylist()
        total, deleted = (
            np.concatenate(
                [np.empty(0, _U)]
                + [_values_of(x.as_buffer(), n) for x, n in zip(answers[c], sizes, strict=True)]
            ).astype(np.int64)
            for c in ("trained", "deleted")
        )
        part = docs["part"].to_numpy()
        per_order = [np.where(at >= 0, total[at], 0) for at in grams.at]
        left = [np.where(at >= 0, (total - deleted)[at], 0) for at in grams.at]
        ends = np.cumsum(grams.n_tokens)
        spans = list(zip(ends - grams.n_tokens, ends, strict=True))

        def packed(counts: list[np.ndarray], which: np.ndarray) -> pa.Array:
            return pa.array(
                [
                    _bytes_of(np.concatenate([c[low:high] for c in counts])) if some else None
                    for (low, high), some in zip(spans, which.tolist(), strict=True)
                ],
                pa.binary(),
            )

        known = np.zeros(len(part), dtype=np.int64)
        known[:1] = sum(answers["known"].to_pylist())  # the block's, told by one of its rows
        seen = per_order[0]
        new = {
            "n_tokens": pa.array(grams.n_tokens, pa.int64()),
            "n_known": pa.array(np.add.reduceat((seen > 0).astype(np.int64), grams.first)),
            "base": pa.array(np.add.reduceat(np.log10(seen + 0.1), grams.first)),
            "known_tokens": pa.array(known),
            "counts": packed(per_order, np.ones(len(part), dtype=bool)),
            "left_counts": packed(left, part == DELETED),
        }
        kept = {c: docs[c] for c in docs.schema.names if c not in ("text", "block")}
        return pa.table({**kept, **new})

    return run


_NEW = StructType(
    [
        StructField("n_tokens", LongType()), StructField("n_known", LongType()),
        StructField("base", DoubleType()), StructField("known_tokens", LongType()),
        StructField("counts", BinaryType()), StructField("left_counts", BinaryType()),
    ]
)


def gram_counts(
    df: DataFrame,
    part: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    order: int = ORDER,
    block_bytes: int = BLOCK_BYTES,
    keep: dict | None = None,
) -> DataFrame:
    """A stored table of `doc_id`, `part` and the counts of each row's n-grams.

    `part` says what a row is for: SCORED only, COUNTED, or DELETED: counted in the end,
    but left out while weights are learned. Tokens are compared with A-Z in lower case.
    """
    extra = keep or {}
    text = F.coalesce(column(df, text_column).cast("string"), F.lit(""))
    rows = df.select(
        column(df, id_column).alias("doc_id"), text.alias("text"),
        part.cast("int").alias("part"), *[value.alias(name) for name, value in extra.items()],
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    # one exchange serves the questions and the answers
    docs = rows.withColumn("block", block).repartition(blocks, "block")
    answers = (
        docs.groupBy("block").applyInArrow(_asked(order, blocks), _ASKED_SQL)
        .groupBy("bucket").applyInArrow(_answered, _ANSWERED_SQL)
    )
    schema = StructType([f for f in rows.schema if f.name != "text"] + _NEW.fields)
    joined = (
        docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_joined(order), schema)
    )
    return stored(joined, "gram_counts")


def level(counts: np.ndarray) -> np.ndarray:
    """The bucket of a context count: 0 for none, then one for each power of two."""
    return np.frexp(counts.astype(np.float64))[1].clip(0, LEVELS - 1)


class _Tokens:
    """Shares and context levels of the tokens of some rows, order by order."""

    def __init__(self, counts: pa.Array, n_tokens: np.ndarray, total: int, order: int):
        ends = np.cumsum(n_tokens)
        by_order = [np.empty(int(n_tokens.sum()), dtype=np.float64) for _ in range(order)]
        for data, n, end in zip(counts, n_tokens.tolist(), ends.tolist(), strict=True):
            own = _values_of(data.as_buffer(), n * order).reshape(order, n)
            for k in range(order):
                by_order[k][end - n : end] = own[k]
        first, last = ends - n_tokens, ends - 1
        self.share, self.level = [], []
        for k in range(order):
            if k == 0:
                context = np.full(len(by_order[0]), float(total))
            else:
                context = np.roll(by_order[k - 1], 1)
                # before the first token is an end token; longer contexts are none there
                context[first] = by_order[0][last] if k == 1 else 0.0
            self.share.append(by_order[k] / np.maximum(context, 1.0))
            self.level.append(level(context))

    def mixed(self, weights: np.ndarray, known: int) -> tuple[np.ndarray, list, list]:
        """Each token's probability; and, by order, the part of the share and the whole."""
        p = np.full(len(self.share[0]), 1.0 / (known + 1))
        parts, wholes = [], []
        for k, (share, at) in enumerate(zip(self.share, self.level, strict=True)):
            own = weights[k][at]
            parts.append(own * share)
            p = parts[-1] + (1 - own) * p
            wholes.append(p)
        return p, parts, wholes


def _expected(weights: np.ndarray, total: int, known: int):
    """For each order and level, tokens that reach it and tokens its share explains."""

    def run(batches):
        order = len(weights)
        reach, explain = np.zeros((2, order, LEVELS))
        for batch in batches:
            n = batch["n_tokens"].to_numpy()
            tokens = _Tokens(batch["left_counts"], n, total, order)
            _, parts, wholes = tokens.mixed(weights, known)
            left = np.ones(len(tokens.share[0]))
            for k in reversed(range(order)):
                mine = left * parts[k] / wholes[k]
                at = tokens.level[k]
                reach[k] += np.bincount(at, weights=left, minlength=LEVELS)
                explain[k] += np.bincount(at, weights=mine, minlength=LEVELS)
                left = left - mine
        at = np.arange(order * LEVELS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(reach.ravel()), pa.array(explain.ravel())],
            ["cell", "reach", "explain"],
        )

    return run


def learned(
    counts: DataFrame, order: int, known: int, rounds: int = ROUNDS, prior: float = PRIOR
) -> np.ndarray:
    """Weights by order and context level, from the rows of the deleted part.

    Every round is one job over their stored counts; its sums are `order` * LEVELS rows.
    Levels without tokens keep the start value of one half.
    """
    rows = counts.where(F.col("part") == DELETED)
    total = counts.where(F.col("part") == COUNTED).agg(F.sum("n_tokens")).first()[0] or 0
    weights = np.full((order, LEVELS), 0.5)
    weights[:, 0] = 0.0
    own = rows.select("n_tokens", "left_counts")
    for _ in range(rounds):
        sums = (
            own.mapInArrow(
                _expected(weights, total, known), "cell int, reach double, explain double"
            )
            .groupBy("cell").agg(F.sum("reach"), F.sum("explain")).collect()
        )
        for cell, reach, explain in sums:
            k, at = divmod(cell, LEVELS)
            if at:
                weights[k, at] = (explain + prior / 2) / (reach + prior)
        # sums of doubles depend on their order in the last digits; weights need not
        weights = np.round(weights, 6)
    return weights


def _scored(weights: np.ndarray, total: int, known: int):
    def run(batches):
        for batch in batches:
            n = batch["n_tokens"].to_numpy()
            if not len(n):
                continue
            tokens = _Tokens(batch["counts"], n, total, len(weights))
            logs = np.log10(tokens.mixed(weights, known)[0])
            names = [c for c in batch.schema.names if c != "counts"]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in names] + [pa.array(np.add.reduceat(logs, np.cumsum(n) - n))],
                [*names, "score"],
            )

    return run


def score(
    df: DataFrame,
    part: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    order: int = ORDER,
    keep: dict | None = None,
) -> DataFrame:
    """`doc_id`, `part`, `n_tokens`, `n_known`, `train_tokens`, `base_score` and `score`.

    `part` is as in `gram_counts`. `score` is the log10 probability of the text under
    the model of this module; `base_score` that under single tokens with 0.1 added to
    each count. `n_known` counts the tokens that occur in training texts. `keep` adds
    columns by name. Null and empty texts are an end token alone. Rows with a null id, or
    equal ids, are texts of their own; repeated rows count as often as they occur.
    Without training texts no token is known and all have the probability 1. An empty
    table gives an empty result.
    """
    counts = gram_counts(df, part, id_column, text_column, order, keep=keep)
    trained = F.col("part") > 0
    total, known = counts.agg(
        F.coalesce(F.sum(F.when(trained, F.col("n_tokens"))), F.lit(0)),
        F.coalesce(F.sum("known_tokens"), F.lit(0)),
    ).first()
    weights = learned(counts, order, known)
    names = [*counts.columns[: counts.columns.index("n_tokens")], "n_tokens", "n_known", "base"]
    own = counts.select(*names, "counts")
    schema = StructType([*own.select(*names).schema.fields, StructField("score", DoubleType())])
    scored = own.mapInArrow(_scored(weights, total, known), schema)
    scale = F.log10(F.lit(total + 0.1 * (known + 1)))
    base = F.col("base") - F.col("n_tokens") * scale
    return scored.select(
        *names[:-1], F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score",
    )
