"""Importance resampling of documents.

Two bag-of-n-gram models over hashed words and word pairs, one of the target (the
documents labelled as good) and one of the raw corpus, give each document a weight:
the sum over its n-grams of the logarithm of the models' ratio. Of n documents, k
are sampled without replacement with probabilities in proportion to the weights:
each gets its log weight plus Gumbel noise as a key, and the k highest keys are
taken. The noise is a function of the id and a seed, so a run can be repeated.

The raw model counts the n-grams of all documents. The target model counts those of
a bounded sample of labelled documents, `fit_rows`, drawn by a hash of the id.

A sum over n-grams lets a long document outweigh any one of them. Words that mark
toxic documents are therefore learned apart, `toxic_words`, and a document with one
comes after all documents without.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from boxtrail.llm import words
from boxtrail.llm.common import column, packed, stored, unpacked

BUCKETS = 1 << 16
FIT_ROWS = 20_000
#: Occurrences that a bucket's ratio of 1 is taken to rest on before any are seen.
PRIOR = 20.0
SEED = 20_11
#: Standard errors by which most documents with a word must be toxic for a mark.
MARK_ERRORS = 3.0
#: Log weight taken from a document with a mark, more than any sum over n-grams.
MARKED = 1e9

_U = np.uint64
_PAIR = _U(0x9FB21C651E98DF25)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the text of each."""
    found = words.of_column(texts, words.WORDS_AND_MARKS)
    return found.hashes(lower=True), np.repeat(np.arange(len(texts)), found.counts)


def features(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of all texts, and the text of each."""
    pairs = words.mix(hashes[:-1] * _PAIR + hashes[1:])
    inside = owner[:-1] == owner[1:]
    buckets = np.concatenate([hashes, pairs[inside]]) % _U(BUCKETS)
    return buckets.astype(np.int64), np.concatenate([owner, owner[:-1][inside]])


def _counted(batches):
    """Counts of a task's documents by bucket, of all and of the target ones."""
    raw, target = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        for part in words.slices(batch, "text"):
            buckets, owner = features(*hashed_words(part["text"]))
            raw += np.bincount(buckets, minlength=BUCKETS)
            good = part["target"].to_numpy(zero_copy_only=False).astype(bool)
            if good.any():
                target += np.bincount(buckets[good[owner]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array(raw[some]), pa.array(target[some])],
        ["bucket", "raw", "target"],
    )


def judged(labels: DataFrame) -> DataFrame:
    """Labels in which no toxic row is good: the quality of a toxic row is 0."""
    return labels.withColumn(
        "quality", F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality"))
    )


def target_ids(labels: DataFrame, fit_rows: int = FIT_ROWS, seed: int = SEED) -> DataFrame:
    """Ids of up to `fit_rows` documents labelled good."""
    chosen = labels.where("quality = 1 AND doc_id IS NOT NULL")
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    return chosen.select("doc_id").distinct().orderBy(order, "doc_id").limit(fit_rows)


def log_ratios(
    df: DataFrame,
    targets: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    prior: float = PRIOR,
) -> np.ndarray:
    """Log ratio of the target model to the raw one, by bucket.

    `targets` holds ids; it is sent to all executors, so its rows must be bounded.
    Without targets all ratios are one.
    """
    marked = F.broadcast(targets.select(F.col("doc_id").alias("__id"), F.lit(True).alias("target")))
    own = df.select(
        column(df, id_column).alias("__own"), column(df, text_column).cast("string").alias("text")
    )
    counts = (
        own.join(marked, F.col("__own") == F.col("__id"), "left")
        .select("text", F.coalesce("target", F.lit(False)).alias("target"))
        .mapInArrow(_counted, "bucket int, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )
    raw, target = np.zeros((2, BUCKETS))
    for bucket, a, b in counts.collect():  # one row per bucket, whatever the input
        raw[bucket], target[bucket] = a, b
    if not target.sum():
        return np.zeros(BUCKETS)
    expected = raw * (target.sum() / raw.sum())
    ratio = (target + prior) / (expected + prior)
    return np.log(ratio) - np.log((raw * ratio).sum() / raw.sum())


def _word_counts(batches):
    """How many documents of a slice have a word, all and toxic ones."""
    for batch in batches:
        for part in words.slices(batch, "text"):
            hashes, owner = hashed_words(part["text"])
            each = np.unique(np.rec.fromarrays([hashes, owner], names="word,owner"))
            toxic = part["toxic"].to_numpy(zero_copy_only=False).astype(np.int64)
            word, first = np.unique(each.word, return_index=True)
            if not len(word):
                continue
            docs = np.diff(np.append(first, len(each)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(word.view(np.int64)), pa.array(docs),
                    pa.array(np.add.reduceat(toxic[each.owner], first)),
                ],
                ["word", "docs", "toxic"],
            )


def toxic_words(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    fit_rows: int = FIT_ROWS,
    seed: int = SEED,
) -> np.ndarray:
    """Sorted hashes of the words that mark a document as toxic.

    Most documents with the word must be toxic, at the lower end of a Wilson interval
    of `MARK_ERRORS`: with 3, ten toxic documents and no other suffice and nine do
    not. Up to `fit_rows` labelled documents are counted, which also bounds the words.
    """
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max(F.col("toxic").cast("long")).alias("toxic"))
        .orderBy(F.xxhash64(F.lit(seed), F.col("__id")), "__id")
        .limit(fit_rows)
    )
    own = df.select(
        column(df, id_column).alias("__own"), column(df, text_column).cast("string").alias("text")
    )
    z = F.lit(MARK_ERRORS)
    share = F.col("toxic") / F.col("docs")
    spread = z * F.sqrt(share * (1 - share) / F.col("docs") + (z / (2 * F.col("docs"))) ** 2)
    lowest = (share + z * z / (2 * F.col("docs")) - spread) / (1 + z * z / F.col("docs"))
    marks = (
        own.join(F.broadcast(known), F.col("__own") == F.col("__id"))
        .select("text", "toxic")
        .mapInArrow(_word_counts, "word long, docs long, toxic long")
        .groupBy("word")
        .agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
        .where(lowest > 0.5)
        .select("word")
        .collect()
    )
    return np.sort(np.array([word for (word,) in marks], dtype=np.int64).view(np.uint64))


def log_weight(
    df: DataFrame,
    ratios: np.ndarray,
    text_column: str = "text",
    marks: np.ndarray | None = None,
) -> DataFrame:
    """`df` with its column `text` replaced by `log_weight`.

    Null and empty texts have weight 0. `MARKED` is taken, once, from a document with
    one of the words in `marks`.
    """

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, "text"):
                hashes, of = hashed_words(part["text"])
                buckets, owner = features(hashes, of)
                # Without any owner the sums would come as whole numbers.
                weight = np.bincount(owner, weights=ratios[buckets], minlength=len(part))
                weight = weight.astype(np.float64)
                if marks is not None and len(marks):
                    place = np.minimum(np.searchsorted(marks, hashes), len(marks) - 1)
                    weight[np.unique(of[marks[place] == hashes])] -= MARKED
                kept = [part[c] for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(weight)],
                    [c for c in part.schema.names if c != "text"] + ["log_weight"],
                )

    source = df.withColumn("text", column(df, text_column).cast("string"))
    fields = [f for f in source.schema if f.name != "text"]
    schema = StructType([*fields, StructField("log_weight", DoubleType())])
    return source.mapInArrow(run, schema)


def gumbel(id_column: Column, seed: int = SEED) -> Column:
    """Gumbel noise from a hash of the id."""
    high = F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_column), 12)
    uniform = (high + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(uniform))


def good_share(labels: DataFrame) -> float:
    """Share of good documents: the labels' share and three standard errors.

    A sample that is too small crowds out good documents, hence the upper bound.
    Without labels the share is 1.
    """
    total, good = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select(
        F.count("*"), F.coalesce(F.sum(F.col("quality").cast("long")), F.lit(0))
    ).first()
    if not total:
        return 1.0
    share = good / total
    return min(1.0, share + 3 * (share * (1 - share) / total) ** 0.5)


#: Keys are whole numbers of millionths, with room on both sides of zero.
UNIT = 1_000_000
_OFFSET = 1 << 62


def sample_key(id_column: Column, seed: int = SEED) -> Column:
    """Log weight plus noise, in millionths."""
    return F.round((F.col("log_weight") + gumbel(id_column, seed)) * UNIT).cast("long")


def kth_highest(keys: DataFrame, k: int) -> int | None:
    """The k-th highest value of the long column `key`; None if there are fewer.

    Four counts over the column settle 16 bits each; nothing is sorted.
    """
    if k <= 0:
        return _OFFSET
    raised = keys.select((F.col("key") + F.lit(_OFFSET)).alias("u"))
    prefix, left = 0, k
    for shift in (48, 32, 16, 0):
        counts = (
            raised.where(F.shiftrightunsigned("u", min(shift + 16, 63)) == prefix)
            .groupBy(F.shiftrightunsigned("u", shift).alias("p"))
            .count()
            .orderBy(F.desc("p"))
            .collect()  # at most 65,536 rows
        )
        for p, count in counts:
            if count >= left:
                prefix = p
                break
            left -= count
        else:
            return None
    return prefix - _OFFSET


def scores(
    df: DataFrame,
    ratios: np.ndarray,
    id_column: str,
    text_column: str,
    seed: int,
    marks: np.ndarray | None = None,
) -> DataFrame:
    """`doc_id`, `log_weight` and `key` of every row."""
    own = df.select(column(df, id_column).alias("doc_id"), column(df, text_column).alias("text"))
    return log_weight(own, ratios, marks=marks).withColumn("key", sample_key(F.col("doc_id"), seed))


def sample(
    df: DataFrame,
    targets: DataFrame,
    share: float,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = SEED,
    marks: np.ndarray | None = None,
) -> DataFrame:
    """The sampled `share` of the rows: `doc_id`, `log_weight` and `key`.

    Rows whose key equals the k-th highest are all taken. Null and empty texts have
    no n-grams and weight 0; a null id has noise of its own like any other id;
    repeated rows have equal keys and stay or go together. An empty table gives an
    empty sample. Rows with one of the words in `marks`, see `toxic_words`, are taken
    only once all others are. Other columns are left out; `keep_sampled` keeps them.
    """
    ratios = log_ratios(df, targets, id_column, text_column)
    scored = stored(scores(df, ratios, id_column, text_column, seed, marks), "importance")
    return _taken(scored, scored, share)


def keep_sampled(
    df: DataFrame,
    targets: DataFrame,
    share: float,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = SEED,
    marks: np.ndarray | None = None,
) -> DataFrame:
    """The sampled rows with all columns of `df`; the same rows as in `sample`."""
    ratios = log_ratios(df, targets, id_column, text_column)
    scored = stored(scores(df, ratios, id_column, text_column, seed, marks), "importance")
    own = df.select(
        packed(df), column(df, id_column).alias("doc_id"), column(df, text_column).alias("text")
    )
    every = log_weight(own, ratios, marks=marks).withColumn("key", sample_key(F.col("doc_id"), seed))
    return unpacked(_taken(every, scored, share), df)


def _taken(rows: DataFrame, scored: DataFrame, share: float) -> DataFrame:
    lowest = kth_highest(scored, int(np.ceil(share * scored.count())))
    return rows if lowest is None else rows.where(F.col("key") >= lowest)
