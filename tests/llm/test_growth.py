"""What the joins of op1 and op10 let through, and that no link is lost by it."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log2

import pytest
from pyspark.sql import functions as F

from boxtrail.llm import line_dedup, minhash_dedup
from boxtrail.llm.common import ship


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def varied():
    """Lines of 9 to 300 words in chains of variants, of which many are just not alike."""
    made = random.Random(3)
    lines = []
    for size in [9, 10, 11, 12, 14, 17, 18, 22, 28, 35, 43, 54, 55, 84, 131, 204, 300] * 4:
        line = [f"w{made.randrange(40)}" for _ in range(3)]
        line += [f"u{made.randrange(10**9)}" for _ in range(size - 3)]
        for _ in range(8):
            lines.append(" ".join(line))
            for _ in range(made.randint(0, max(1, len(line) // 9))):
                if made.random() < 0.5 and len(line) > 9:
                    line.pop(made.randrange(len(line)))
                else:
                    line.insert(0, f"u{made.randrange(10**9)}")
    made.shuffle(lines)
    return ["\n".join(lines[k : k + 5]) for k in range(0, len(lines), 5)]


def kept_lines(texts):
    """Sets of all earlier lines, removed ones too, are what a line is held against."""
    sets, out = [], []
    for text in texts:
        kept = []
        for line in text.split("\n"):
            words = set(line.split())
            if not any(jaccard(words, other) >= 0.9 for other in sets):
                kept.append(line)
            sets.append(words)
        out.append("\n".join(kept))
    return out


def test_op1_on_sizes_at_the_borders_of_bands(spark, varied):
    docs = spark.createDataFrame(list(enumerate(varied)), "doc_id long, text string")
    rows = line_dedup.remove_lines(docs).select("doc_id", "kept_text").collect()
    assert dict(map(tuple, rows)) == dict(enumerate(kept_lines(varied)))


def test_op1_rows_of_unlike_sizes_do_not_meet(spark):
    """One rare word in lines of many sizes: before, each line met all others."""
    sizes = [10 * 2**k for k in range(8)]
    rows = [(k, 0, n, 0, list(range(k * 1000, k * 1000 + 2)) + [7]) for k, n in enumerate(sizes)]
    classes = spark.createDataFrame(
        rows, "doc_id long, spot long, n int, parity long, prefix array<int>"
    )
    found = line_dedup._prefix_rows(classes, 90)
    assert found.groupBy("key").agg(F.countDistinct("doc_id").alias("of")).agg(F.max("of")).first()[0] == 1


@pytest.mark.parametrize("wanted", [1_000, 400_000])
def test_op1_filter_lets_the_same_share_pass(spark, wanted):
    """With bits for a fixed number of values, more of them let more others pass."""
    values = spark.range(wanted).select(F.col("id").alias("v"))
    others = spark.range(1_000_000, 1_100_000).select(F.col("id").alias("v"))
    assert line_dedup._filtered(values, values).count() == wanted
    assert line_dedup._filtered(others, values).count() < 5_000
    assert line_dedup._filtered(others, values.limit(0)).count() == 0


def test_op1_plans_stay_small(spark):
    """The driver holds and prints the table of levels with each plan that makes keys."""
    levels = bytes(1 + k % 127 for k in range(line_dedup.BUCKETS))
    made = spark.range(1).select(F.col("id").cast("string").alias("line"))
    plan = made.select(line_dedup._keys("line", levels))._jdf.queryExecution().optimizedPlan()
    assert len(plan.toString()) < 200_000


def test_op1_rarer_words_come_first(spark):
    words = [f"x{k}" for k in range(200)]
    made = spark.createDataFrame([(w,) for w in words], "line string")
    hashes = dict(map(tuple, made.select("line", line_dedup._short(F.col("line"))).collect()))
    levels = bytearray(1 for _ in range(line_dedup.BUCKETS))
    for k, w in enumerate(words):
        levels[hashes[w] >> 41] = 1 + k % 127
    keys = made.select("line", line_dedup._keys("line", bytes(levels))[0]).collect()
    assert all(key >> 56 == levels[hashes[w] >> 41] for w, key in keys)
    assert len({key for _, key in keys}) == len(words)


CLASS = "doc_id long, spot long, n int, parity long, prefix array<int>"


def test_op1_rows_are_dealt_to_one_window_and_one_join(spark):
    """Before, the window was made for each of two branches, and the join came on top."""
    pairs = line_dedup._candidates(spark.createDataFrame([], CLASS), 90)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
    assert plan.count("RepartitionByExpression [") == 2


def test_op1_variants_of_one_line_meet_the_earliest_alone(spark):
    """Variants pass with the earliest; lines of the same words that do not ask all others."""
    rows = [(k, 0, 50, 0, [1000 + k, 7, 8]) for k in range(300)]
    # Too many bits apart from the variants, but not from each other.
    rows += [(300 + k, 0, 50, 0x3FFFFF, [2000 + k, 7, 8]) for k in range(3)]
    found = line_dedup._candidates(spark.createDataFrame(rows, CLASS), 90).collect()
    got = {(r.x_doc, r.y_doc): len(r["keys"]) for r in found}
    assert len(got) == len(found)
    assert {p for p in got if p[1] < 300} == {(0, k) for k in range(1, 300)}
    assert {p for p in got if p[1] >= 300} == {(300, 301), (300, 302), (301, 302)}
    # Asked of the earliest for both words; pairs of others have no key to try again.
    assert all(n == (2 if x == 0 else 0) for (x, _), n in got.items())


def test_op1_spaces_are_made_plain_once_a_text(spark):
    """Before, each line was searched for rare spaces and went through a regular expression."""
    texts = ["d\ta\x0bb a  d\r\n\f \t\n\n c", "x y\nz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = line_dedup._lines(docs)
    assert [r.line for r in lines.orderBy("doc_id", "line_no").collect()] == [
        "d a b a  d ", "   ", "", " c", "x y", "z"
    ]
    worded = lines.where(line_dedup._has_words("line"))
    keys = worded.withColumn("keys", line_dedup._keys("line", b"\x01" * line_dedup.BUCKETS))
    assert [(r.line, len(r["keys"])) for r in keys.orderBy("doc_id", "line_no").collect()] == [
        ("d a b a  d ", 3), (" c", 1), ("x y", 2), ("z", 1)
    ]
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and plan.count("Contains(") == len(line_dedup._RARE_SPACES)


def test_op1_rarity_counts_words_of_whole_texts(spark):
    texts = ["a b\n\nc a ", "", "\n", "d\ta\x0bb\r\n\fe a", "\u00a0 z\u2028z"]
    words = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    made = spark.createDataFrame([(w,) for w in words], "word string")
    hashes = [h for (h,) in made.select(line_dedup._short(F.col("word"))).collect()]
    counts = Counter(h >> 41 for h in hashes)
    levels = line_dedup.rarity(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert {b: n for b, n in enumerate(levels) if n > 1 or b in counts} == {
        b: 1 + floor(4 * log2(n)) for b, n in counts.items()
    }


def test_op10_joins_few_pairs_below_the_threshold(spark, monkeypatch):
    """Variants of one text that are all alike at about 0.7: no links, but near ones.

    By length and position alone most of these pairs came out of the exact join.
    """
    made = random.Random(5)
    base = [f"b{k}" for k in range(200)]
    texts = []
    for k in range(60):
        words = list(base)
        for at in made.sample(range(0, 200, 5), 7):
            words[at] = f"{k}.{at}"
        texts.append(" ".join(words))
    texts += [t.replace("b199", "last") for t in texts[:5]]
    ship(spark)
    sets = [minhash_dedup.shingle_sets(minhash_dedup.pa.array([t]))[0] for t in texts]
    names = [minhash_dedup.identity(s) for s in sets]
    frame = spark.createDataFrame(
        [(n, s.view("int64").tolist()) for n, s in zip(names, sets)], "name long, shingles array<long>"
    )
    members = frame.select(F.col("name").alias("node"), F.col("name").alias("label"))
    got = {frozenset(r) for r in minhash_dedup._across(members, frame, 75).collect()}
    pairs = {
        frozenset((names[a], names[b])): jaccard(set(sets[a].tolist()), set(sets[b].tolist()))
        for a in range(len(sets)) for b in range(a)
    }
    links = {p for p, value in pairs.items() if value >= 0.75}
    assert len(links) >= 5 and links <= got
    assert sum(0.5 <= v < 0.75 for v in pairs.values()) > 1000
    assert len(got) < 100 + len(links)
