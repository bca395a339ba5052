"""Spelling variants: words that differ by one code point, and the form they stand for.

Every word is marked with a terminator and rotated to start at each of its places
(a permuterm index): the word `ab` gives `ab$`, `b$a` and `$ab`. Words that differ by
a replacement have rotations that differ in the last code point alone; a word with one
code point less has a rotation that is the other's without its last. So each rotation
is a row under itself, and under its prefix that skips the last code point. Rows are
sorted by this key, and a scan over the sorted rows finds the group of each key: at
most one word that is the key, and the words that add one code point to it, as many
at most as there are code points in use.

No pairs are made. A group gives each of its words the number of near words and the
best of them, where all but the two best words of the group are needed only to be
counted. A code point can be taken out of a run of equal ones in several places; the
first place counts. So two near words meet in one group exactly.

Words are numbered in code point order, without gaps being needed, and numbers take their
place until the end. Keys of more than `LONG` code points are digests of their two
parts, so that the rows of a long word grow with its length, not with its square.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from boxtrail.llm.common import column, stored

#: Maximal runs of letters of Latin-1.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: A form's word has at least this many times the occurrences of its variant.
RATIO = 10
#: Code points of a key beyond which it is a digest.
LONG = 64
END = "\0"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(
    df: DataFrame, pattern: str = LETTERS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """`doc_id` and `run`, one row per match of the pattern, A-Z lower-cased after it."""
    found = F.regexp_extract_all(column(df, text_column).cast("string"), F.lit(pattern), F.lit(0))
    rows = df.select(column(df, id_column).alias("doc_id"), F.explode(found).alias("run"))
    return rows.withColumn("run", F.translate("run", _UPPER, _LOWER))


def without_one(run: Column, mark: Column, every: int) -> Column:
    """The run without code point `mark` modulo its length, if `every` divides `mark`."""
    at = F.pmod(mark, F.char_length(run).cast("long")).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(F.pmod(mark, F.lit(every)) == 0, short).otherwise(run)


def counted(words: DataFrame, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """`word` and `n` of the words that are long and frequent enough."""
    return (
        words.where(F.char_length("word") >= min_length)
        .groupBy("word").agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def numbered(counts: DataFrame) -> DataFrame:
    """`word`, `n` and a number `no` that rises with the words' code point order."""
    dealt = counts.select("word", "n").repartitionByRange("word").sortWithinPartitions("word")
    return stored(dealt.withColumn("no", F.monotonically_increasing_id()), "words")


def _short_rows(words: DataFrame) -> DataFrame:
    """Rows under keys of up to `LONG` code points."""
    word, size = F.col("word"), F.char_length("word")

    def rotated(at):
        return F.concat(F.substr(word, at + 1), F.lit(END), F.substr(word, F.lit(1), at))

    def skipping(at):
        key = F.concat(F.substr(word, at + 1), F.lit(END), F.substr(word, F.lit(1), at - 1))
        code = F.ascii(F.substr(word, at, F.lit(1)))
        again = (at > 1) & (F.substr(word, at, F.lit(1)) == F.substr(word, at - 1, F.lit(1)))
        return F.struct(key.alias("key"), F.when(again, -code).otherwise(code).alias("code"))

    own = F.transform(
        F.sequence(F.lit(0), size),
        lambda at: F.struct(rotated(at).alias("key"), F.lit(0).alias("code")),
    )
    none = F.expr("CAST(array() AS array<struct<key:string,code:int>>)")
    rows = F.concat(
        F.when(size <= LONG, own).otherwise(none),
        F.when(size > 0, F.transform(F.sequence(F.lit(1), size), skipping)).otherwise(none),
    )
    return words.where(size <= LONG + 1).select("no", "n", F.inline(rows))


def _digests(codes: list[bytes]) -> list[bytes]:
    """Digests of all prefixes, the empty one first."""
    seen = hashlib.blake2b(digest_size=16)
    out = [seen.digest()]
    for code in codes:
        seen.update(code)
        out.append(seen.digest())
    return out


def _long_keys(word: str) -> tuple[list[str], list[int]]:
    codes = [c.encode("utf-8", "surrogatepass") for c in word]
    head, tail = _digests(codes), _digests(codes[::-1])[::-1]
    size = len(word)
    keys = [(head[at] + tail[at]).hex() for at in range(size + 1)]
    values = [0] * (size + 1)
    if size > LONG + 1:
        keys += [(head[at] + tail[at + 1]).hex() for at in range(size)]
        values += [
            -ord(c) if at and word[at - 1] == c else ord(c) for at, c in enumerate(word)
        ]
    return keys, values


def _long_rows(batches):
    """Rows under digests: of the key's parts before and after the skipped place."""
    for batch in batches:
        for no, n, word in zip(*(batch[c].to_pylist() for c in ("no", "n", "word")), strict=True):
            keys, values = _long_keys(word)
            for at in range(0, len(keys), 1 << 14):
                part = keys[at : at + (1 << 14)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([no] * len(part), pa.int64()),
                        pa.array([n] * len(part), pa.int64()),
                        pa.array(part, pa.string()),
                        pa.array(values[at : at + (1 << 14)], pa.int32()),
                    ],
                    ["no", "n", "key", "code"],
                )


def keyed(words: DataFrame) -> DataFrame:
    """Rows `no`, `n`, `key`, `code`, one per rotation and per prefix of a rotation.

    `code` is the code point that follows the key, negative if it also ends the
    skipped place's left side, and 0 if the word is the key itself.
    """
    usable = words.where(~F.contains("word", F.lit(END)))
    long = usable.where(F.char_length("word") > LONG).select("no", "n", "word")
    return _short_rows(usable).unionByName(
        long.mapInArrow(_long_rows, "no long, n long, key string, code int")
    )


def _first_of(group: np.ndarray, rows: np.ndarray, n_groups: int, skip: int = 0) -> np.ndarray:
    """For each group its row number `skip` among `rows`, which are in order; -1 if none."""
    groups = np.arange(n_groups)
    own, place = np.append(group[rows], -1), np.append(rows, -1)
    start = np.minimum(np.searchsorted(own[:-1], groups) + skip, len(rows))
    return np.where(own[start] == groups, place[start], -1)


def _neighbours(group, no, n, code):
    """Near words in whole groups: word, count, and occurrences and number of the best.

    Rows are sorted by group here; `group` counts from 0.
    """
    order = np.lexsort((no, -n, group))
    group, no, n, code = group[order], no[order], n[order], code[order]
    rows, n_groups = np.arange(len(group)), int(group[-1]) + 1
    adds, opens = code != 0, code > 0
    first = _first_of(group, rows[adds], n_groups)
    second = _first_of(group, rows[adds], n_groups, 1)
    first_open = _first_of(group, rows[opens], n_groups)
    base = _first_of(group, rows[~adds], n_groups)
    n_adds = np.bincount(group[adds], minlength=n_groups)
    n_opens = np.bincount(group[opens], minlength=n_groups)

    best = np.where(first[group] == rows, second[group], first[group])
    # the word that is the key is near only those that open a run
    met = opens & (base[group] >= 0)
    better = met & ((best < 0) | (base[group] < best))  # rows of a group are in order
    best = np.where(better, base[group], best)
    count = n_adds[group] - 1 + met
    best = np.where(adds, best, first_open[group])
    count = np.where(adds, count, n_opens[group])
    some = count > 0
    return no[some], count[some], n[best[some]], no[best[some]]


def _scan(batches):
    """Find the groups of equal keys in sorted rows; the last group stays open."""
    held: list[pa.RecordBatch] = []

    def found(rows: pa.Table):
        key = rows["key"].combine_chunks()
        new = np.ones(len(key), dtype=bool)
        new[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        shared = ~new
        shared[:-1] |= ~new[1:]
        if shared.any():
            group = np.cumsum(new[shared]) - 1
            values = [rows[c].to_numpy()[shared] for c in ("no", "n", "code")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in _neighbours(group, *values)],
                ["no", "n_near", "best_n", "best"],
            )

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch["key"]
        last = pc.not_equal(key, key[-1]).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if held and (cut or held[0]["key"][-1] != key[-1]):
            yield from found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = []
        elif cut:
            yield from found(pa.Table.from_batches([batch.slice(0, cut)]))
        held.append(batch.slice(cut))
    if held:
        yield from found(pa.Table.from_batches(held))


def near_words(words: DataFrame) -> DataFrame:
    """`no`, `n_near`, `best` and `best_n` of the words that have near words."""
    rows = keyed(words).repartition("key").sortWithinPartitions("key")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("no")))
    return (
        rows.mapInArrow(_scan, "no long, n_near long, best_n long, best long")
        .groupBy("no")
        .agg(F.sum("n_near").alias("n_near"), best.alias("b"))
        .select("no", "n_near", F.col("b.no").alias("best"), (-F.col("b.n")).alias("best_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """`no` and `root`: where the forms of `no` lead in the end.

    Each round joins the table with itself and so doubles the steps taken. A form
    has `RATIO` times the occurrences, so there are few rounds and no circles.
    """
    known = stored(forms.select("no", F.col("form").alias("root")), "roots")
    while True:
        onward = known.select(F.col("no").alias("root"), F.col("root").alias("next"))
        moved = known.join(onward, "root", "left").select(
            "no", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = stored(moved, "roots")
        if moved.where("moved").isEmpty():
            return moved.select("no", "root")
        known = moved.select("no", "root")


def variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near` and `form_n` of every row of (`word`, `n`).

    Words are near if one inserted, deleted or replaced code point makes them equal.
    `form` is the near word with the largest n, ties to the smallest in code point
    order, if it has `ratio` (more than 1) times the word's own n; else null. `root`
    follows forms to the last. Words are distinct and n positive; a null word is left
    out, other columns are ignored. The empty word is near all words of one code point.
    Words with U+0000 have no near words. An empty table gives an empty result.
    """
    if ratio <= 1:
        raise ValueError("with a ratio of 1 or less forms may lead in a circle")
    words = numbered(counts.where("word IS NOT NULL"))
    joined = stored(
        words.join(near_words(words), "no", "left").withColumn(
            "form", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
        ),
        "variants",
    )
    forms = joined.where("form IS NOT NULL").select("no", "form")
    names = words.select(F.col("no").alias("form"), F.col("word").alias("form_word"))
    ends = words.select(F.col("no").alias("root"), F.col("word").alias("root_word"))
    led = roots(forms).join(ends, "root").select("no", "root_word")
    named = (
        forms.join(names, "form").join(led, "no").select("no", "form_word", "root_word")
    )
    return joined.join(named, "no", "left").select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("form_word").isNotNull(), F.col("best_n")).alias("form_n"),
    )
