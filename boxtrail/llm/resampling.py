"""Resampling of documents towards the distribution of a target set.

Words and runs of up to two words are hashed to a fixed number of buckets by CRC-32
of their bytes. The counts of all documents and of all target texts give one gain per
bucket, a smoothed log ratio in thousandths; they are an array that every task gets,
and a document's weight is the floored mean of its features' gains. A score is the
weight and Gumbel noise made from the id.

The k highest scores are found without a global sort. Scores are stored once; jobs that
count the rows at or above some numbers narrow the cutoff down, and the ids tied there
are narrowed down alike. Only drawn rows are then dealt in ranges of score and id, and
ranks are the place in a range after the sizes of the ranges before.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from boxtrail.llm import words
from boxtrail.llm.common import column, stored

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Numbers compared in one counting job.
WAYS = 16
#: Bytes of a word beyond which it is hashed alone.
LONG_WORD = 64

_LAST = (1 << 63) - 1

#: A word is a run of ASCII letters and digits and of bytes of other characters.
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = (value >> 1) ^ np.where(value & 1, np.uint32(0xEDB88320), np.uint32(0))
    return value


_TABLE = _crc_table()
_ONES = np.uint32(0xFFFFFFFF)


def _step(crc: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _TABLE[(crc ^ byte) & 0xFF] ^ (crc >> 8)


def _continue_crc(crc, buffer, starts, ends) -> np.ndarray:
    """CRC-32 of what `crc` stands for followed by buffer[start:end], for each run."""
    size = ends - starts
    out = np.empty(len(size), dtype=np.uint32)
    order = np.argsort(-size, kind="stable")
    n_long = int(np.searchsorted(-size[order], -LONG_WORD, side="left"))
    for k in order[:n_long].tolist():
        out[k] = zlib.crc32(buffer[starts[k] : ends[k]].tobytes(), int(crc[k]))
    order = order[n_long:]
    state, at, size = crc[order] ^ _ONES, starts[order], size[order]
    alive = len(order)
    for step in range(int(size[0]) if alive else 0):
        alive = int(np.searchsorted(-size, -step, side="left"))
        state[:alive] = _step(state[:alive], buffer[at[:alive] + step])
    out[order] = state ^ _ONES
    return out


def features(texts: pa.Array, buckets: int = BUCKETS):
    """Buckets of all features, the text of each, and the number of words per text."""
    raw, offsets = words.text_buffer(texts)
    found = words.split(raw, offsets, KINDS)
    buffer = _LOWER[raw]
    owner = np.repeat(np.arange(len(texts)), found.counts)
    nothing = np.zeros(len(found.starts), dtype=np.uint32)
    one = _continue_crc(nothing, buffer, found.starts, found.ends)
    first = np.flatnonzero(owner[:-1] == owner[1:])
    spaced = _step(one[first] ^ _ONES, np.uint32(32)) ^ _ONES
    two = _continue_crc(spaced, buffer, found.starts[first + 1], found.ends[first + 1])
    bucket = np.concatenate([one, two]).astype(np.int64) % buckets
    return bucket, np.concatenate([owner, owner[first]]), found.counts


def _counter(buckets: int):
    def run(batches):
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in words.slices(batch, "text"):
                counts += np.bincount(features(part["text"], buckets)[0], minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some])], ["bucket", "n"]
        )

    return run


def bucket_counts(df: DataFrame, text_column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    own = df.select(column(df, text_column).cast("string").alias("text"))
    rows = (
        own.mapInArrow(_counter(buckets), "bucket int, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # one row per bucket
    )
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of target to raw share of each bucket, in thousandths."""
    s, t = raw.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(df: DataFrame, table: np.ndarray, text_column: str = "text") -> DataFrame:
    """`df` with its column `text` replaced by `n_words`, `n_features` and `weight`."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, "text"):
                bucket, owner, n_words = features(part["text"], len(table))
                n = len(n_words)
                size = np.bincount(owner, minlength=n)
                total = np.bincount(owner, weights=table[bucket], minlength=n).astype(np.int64)
                mean = total // np.maximum(size, 1)
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in names]
                    + [pa.array(x, pa.int64()) for x in (n_words, size, mean)],
                    [*names, "n_words", "n_features", "weight"],
                )

    source = df.withColumn("text", column(df, text_column).cast("string"))
    new = [StructField(c, LongType()) for c in ("n_words", "n_features", "weight")]
    return source.mapInArrow(run, StructType([f for f in source.schema if f.name != "text"] + new))


def noise(id_column: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from a hash of the id; a null id is an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    high = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    uniform = (high + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def highest_number(rows: DataFrame, number: Column, k: int) -> tuple[int, int] | None:
    """The largest value that at least k rows reach, and how many exceed it.

    Each job counts the rows at or above up to `WAYS` values between two bounds, which
    it so narrows down; None if there are fewer than k rows or k is not positive.
    """
    low, high, n = rows.agg(F.min(number), F.max(number), F.count(number)).first()
    if k <= 0 or n < k:
        return None
    above = 0  # rows beyond `high`
    while low < high:
        step = -(-(high - low) // WAYS)
        tries = [*range(low + step, high, step), high]
        found = rows.agg(*[F.count_if(number >= F.lit(t)) for t in tries]).first()
        reached = [(t, c) for t, c in zip(tries, found, strict=True) if c >= k]
        missed = [(t, c) for t, c in zip(tries, found, strict=True) if c < k]
        low = reached[-1][0] if reached else low
        if missed:
            high, above = missed[0][0] - 1, missed[0][1]
    return low, above


def _chosen(scored: DataFrame, k: int) -> Column:
    """The rows of the k highest scores; more if equal ids tie at the very end."""
    eligible = scored.where("eligible")
    cut = highest_number(eligible, F.col("score"), k)
    if cut is None:
        # nobody is drawn, or everybody
        return F.col("eligible") & F.lit(k > 0)
    score, above = cut
    tied = eligible.where(F.col("score") == F.lit(score))
    # the smallest ids are the highest once their bits are turned
    last, _ = highest_number(tied, F.bitwise_not(_place()), k - above)
    beyond = F.col("score") > F.lit(score)
    return F.col("eligible") & (
        beyond | ((F.col("score") == F.lit(score)) & (_place() <= F.lit(~last)))
    )


def _place() -> Column:
    """Ids in their order, null after all others."""
    return F.coalesce(F.col("doc_id"), F.lit(_LAST))


def ranked(chosen: DataFrame, k: int) -> DataFrame:
    """`chosen` with `rank`, by falling score and rising id; null beyond k.

    Rows go to ranges of that order, each sorted by its task. The sizes of the ranges,
    one row each, give the rank of a range's first row.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    dealt = chosen.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = stored(
        dealt.withColumns(
            {"__range": F.shiftright(place, 33), "__at": place.bitwiseAND((1 << 33) - 1)}
        ),
        "drawn",
    )
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__range").agg(F.count("*").alias("n"))
    first = sizes.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    rank = F.col("__first") + F.col("__at") + 1
    return (
        placed.join(F.broadcast(first), "__range")
        .withColumn("rank", F.when(rank <= F.lit(k), rank))
        .drop("__range", "__at", "__first")
    )


def resample(
    df: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    buckets: int = BUCKETS,
    seed: int = SEED,
    keep: dict | None = None,
) -> DataFrame:
    """`doc_id`, `n_words`, `n_features`, `weight`, `score` and `rank` of every row.

    Of the rows with `min_words` words, `percent` in a hundred are drawn, rounded down;
    `rank` counts them from 1 and is null for all others. `keep` adds columns by name.
    Ids are whole numbers. Null and empty texts have no features and weight 0; they
    are drawn only if `min_words` is 0. A null id has the noise of an empty one and
    comes after others of its score. Repeated rows are drawn as rows: each takes a rank of
    its own, ordered by `n_features`, and those that tie in this too are alike but
    for their other columns. Without target texts, or documents, the model is the
    smoothing alone. An empty table gives an empty result.
    """
    table = gains(
        bucket_counts(df, text_column, buckets), bucket_counts(target, target_column, buckets)
    )
    extra = keep or {}
    own = df.select(
        column(df, id_column).cast("long").alias("doc_id"),
        column(df, text_column).cast("string").alias("text"),
        *[value.alias(name) for name, value in extra.items()],
    )
    scored = weighted(own, table).withColumns(
        {
            "score": F.col("weight") + noise(F.col("doc_id"), seed),
            "eligible": F.col("n_words") >= min_words,
        }
    )
    scored = stored(scored, "resampling")
    k = percent * scored.where("eligible").count() // 100
    chosen = _chosen(scored, k)
    drawn = ranked(scored.where(chosen), k)
    rest = scored.where(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("eligible")
