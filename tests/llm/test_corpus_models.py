"""Resampling, spelling variants and n-gram scores against brute force and on odd rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxtrail.llm import interpolation, resampling, spelling
from boxtrail.llm.common import ship, table
from boxtrail.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LONG = "x" * 300 + " " + "abcdefghij" * 40
ODD = [
    (1, None, "q", 1), (2, "", None, 2), (3, " \n\t", "q", 3), (4, "a b c " * 9, "q", 4),
    (4, "a b c " * 9, "q", 4), (None, "a b c " * 9, None, 5), (None, None, "q", 6),
    (5, "A é\x1cb, 7-up " * 8, "q", 7), (6, LONG, "q", 8), (7, "w " * 30_000, "q", 9),
]
#: Extra columns that carry names the operators use themselves.
SCHEMA = "doc_id long, text string, score string, rank long"


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    return spark.createDataFrame(ODD, SCHEMA)


# --- target resampling ------------------------------------------------------


def features(text):
    lower = (text or "").translate(str.maketrans({c: chr(c + 32) for c in range(65, 91)}))
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_features_equal_crc_of_their_bytes():
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("aB 9é,😀\n", k=rnd.randint(0, 60))) for _ in range(200)]
    texts += [None, "z" * 500, "a " + "y" * 70 + " b"]
    bucket, owner, n_words = resampling.features(pa.array(texts))
    got = defaultdict(list)
    for b, o in zip(bucket.tolist(), owner.tolist()):
        got[o].append(b)
    for k, text in enumerate(texts):
        words, every = features(text)
        assert n_words[k] == len(words)
        assert sorted(got[k]) == sorted(zlib.crc32(f.encode()) % 10_000 for f in every)


def test_cutoffs_of_any_size(spark):
    rnd = random.Random(2)
    values = [rnd.choice([-5, 0, 3, 3, 3, 10**12, -(2**62)]) for _ in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(3).cache()
    for k in (1, 2, 17, 40, 60):
        cut = sorted(values, reverse=True)[k - 1]
        found = resampling.highest_number(df, F.col("v"), k)
        assert found == (cut, sum(v > cut for v in values))
    assert resampling.highest_number(df, F.col("v"), 61) is None
    assert resampling.highest_number(df, F.col("v"), 0) is None


def test_resampling_of_odd_rows(spark, odd):
    target = spark.createDataFrame([("a b c",), (None,)], "text string")
    got = resampling.resample(
        odd, target, percent=50, keep={"score_text": F.col("score"), "place": F.col("rank")}
    ).collect()
    assert sorted(r.place for r in got) == sorted(r[3] for r in ODD)
    by_place = {r.place: r for r in got}
    for doc, text, note, place in ODD:
        words, every = features(text)
        r = by_place[place]
        assert (r.doc_id, r.n_words, r.n_features, r.score_text) == (
            doc, len(words), len(every), note
        )
        assert every or r.weight == 0
    eligible = [r for r in got if r.n_words >= 20]
    drawn = sorted((r for r in got if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in drawn] == list(range(1, len(eligible) // 2 + 1))
    order = sorted(eligible, key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0))
    assert [(r.score, r.doc_id) for r in drawn] == [(r.score, r.doc_id) for r in order][: len(drawn)]


def test_resampling_draws_ties_by_id_and_repeated_rows_exactly(spark):
    text = "t " * 25
    rows = [(i, text) for i in range(40)] + [(7, text)] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # equal noise for all: scores tie, ids decide, copies of one id fill the rest
    scored = df.select(
        "doc_id", F.lit(25).cast("long").alias("n_words"), F.lit(49).cast("long").alias("n_features"),
        F.lit(5).cast("long").alias("score"), F.lit(True).alias("eligible"),
    )
    for k in (1, 8, 15, 28, 29, 60):
        chosen = scored.where(resampling._chosen(scored, k))
        got = resampling.ranked(chosen, k).where("rank IS NOT NULL").collect()
        want = sorted(r[0] for r in rows)[:k]
        assert [r.doc_id for r in sorted(got, key=lambda r: r.rank)] == want


def test_resampling_without_rows(spark, odd):
    target = spark.createDataFrame([], "text string")
    assert resampling.resample(odd.limit(0), target).count() == 0
    got = resampling.resample(odd, target, percent=0).collect()
    assert len(got) == len(ODD) and all(r.rank is None for r in got)


# --- spelling variants ------------------------------------------------------


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, ratio=10):
    form, out = {}, {}
    for word, n in counts.items():
        others = [w for w in counts if near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        good = best is not None and counts[best] >= ratio * n
        form[word] = best if good else None
        out[word] = [len(others), counts[best] if good else None]
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        out[word] = (form[word], root, counts[word], *out[word])
    return out


def check_variants(spark, counts, ratio=10):
    rows = [(n, w, "x") for w, n in counts.items()]
    df = spark.createDataFrame(rows, "n long, word string, no string").repartition(3)
    got = {
        r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
        for r in spelling.variants(df, ratio).collect()
    }
    assert got == brute_variants(counts, ratio)


def test_variants_equal_brute_force(spark):
    ship(spark)
    rnd = random.Random(5)
    counts = {
        "".join(rnd.choices("aabé", k=rnd.randint(1, 6))): rnd.choice([1, 2, 2, 30, 900])
        for _ in range(260)
    }
    check_variants(spark, {**counts, "": 3, "😀a": 4, "퟿a": 50, "a": 50})
    check_variants(spark, counts, ratio=2)


def test_variants_of_long_words(spark):
    """On both sides of the length at which keys become digests."""
    rnd = random.Random(6)
    counts = {}
    for size in (spelling.LONG - 1, spelling.LONG, spelling.LONG + 1, spelling.LONG + 2, 400):
        base = "".join(rnd.choices("ab", k=size))
        words = [base, base[1:], base + "a", "a" + base, base[:30] + "z" + base[31:],
                 base[:30] + base[31:], base[:20] + base[20] + base[20:], base[:-1] + "y"]
        counts |= {w: rnd.choice([1, 1, 15, 200]) for w in words}
    check_variants(spark, counts)


def test_chains_lead_to_their_root_and_ties_to_the_smallest(spark):
    chain = {"aaaa": 1, "aaab": 10, "aabb": 100, "abbb": 1000, "bbbb": 10_000}
    check_variants(spark, chain | {"cccca": 50, "ccccb": 50, "cccc": 5})


def test_variants_of_nothing_and_odd_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(empty).count() == 0
    df = spark.createDataFrame([(None, 5), ("a\0b", 5), ("a\0c", 90)], "word string, n long")
    got = {r.word: (r.form, r.n_near) for r in spelling.variants(df).collect()}
    assert got == {"a\0b": (None, 0), "a\0c": (None, 0)}
    with pytest.raises(ValueError):
        spelling.variants(df, 1)


def test_runs_keep_letters_only(spark, odd):
    got = Counter(r.run for r in spelling.runs(odd).where("doc_id = 5").collect())
    assert got == {"a": 8, "é": 8, "b": 8, "up": 8}


# --- interpolated n-gram scores ---------------------------------------------


def tokens_of(text):
    lower = (text or "").translate(str.maketrans({c: chr(c + 32) for c in range(65, 91)}))
    return [*re.findall("[^\x20\x09-\x0d]+", lower), None]


def counted(texts):
    """Counts of single tokens, of pairs, and the tokens in total."""
    one, two = Counter(), Counter()
    for text in texts:
        tokens = tokens_of(text)
        one.update(tokens)
        two.update(zip([None, *tokens], tokens))
    return one, two, sum(one.values())


def probability(model, known, weights, before, token):
    one, two, total = model
    level = lambda c: min(int(c).bit_length(), interpolation.LEVELS - 1)
    p = 1 / (known + 1)
    first = weights[0][level(total)]
    p = first * one[token] / max(total, 1) + (1 - first) * p
    second = weights[1][level(one[before])]
    return second * two[before, token] / max(one[before], 1) + (1 - second) * p


def brute_scores(rows, rounds=interpolation.ROUNDS, prior=interpolation.PRIOR):
    """(text, part) rows to (known tokens, base, score) by plain counting."""
    full = counted(t for t, p in rows if p)
    left = counted(t for t, p in rows if p == interpolation.COUNTED)
    known = len(full[0])
    weights = np.full((2, interpolation.LEVELS), 0.5)
    weights[:, 0] = 0
    for _ in range(rounds):
        reach, explain = np.zeros((2, 2, interpolation.LEVELS))
        for text, part in rows:
            if part != interpolation.DELETED:
                continue
            tokens = tokens_of(text)
            for before, token in zip([None, *tokens], tokens):
                one, two, total = left
                levels = [int(total).bit_length(), int(one[before]).bit_length()]
                whole = probability(left, known, weights, before, token)
                mine = weights[1][levels[1]] * two[before, token] / max(one[before], 1) / whole
                reach[1][levels[1]] += 1
                explain[1][levels[1]] += mine
                rest = (1 - weights[1][levels[1]]) * weights[0][levels[0]]
                reach[0][levels[0]] += 1 - mine
                explain[0][levels[0]] += rest * one[token] / max(total, 1) / whole
        weights = np.where(reach + explain > 0, (explain + prior / 2) / (reach + prior), weights)
        weights[:, 0] = 0
        weights = np.round(weights, 6)
    out = []
    for text, _ in rows:
        tokens = tokens_of(text)
        c = [full[0][t] for t in tokens]
        base = sum(math.log10((x + 0.1) / (full[2] + 0.1 * (known + 1))) for x in c)
        score = sum(
            math.log10(probability(full, known, weights, b, t))
            for b, t in zip([None, *tokens], tokens)
        )
        out.append((len(tokens), sum(x > 0 for x in c), full[2], base, score))
    return out


def test_scores_equal_plain_counting(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    part = [zlib.crc32(str(i).encode()) % 10 for i, _ in docs]
    kinds = {0: interpolation.SCORED, 1: interpolation.DELETED}
    want = brute_scores([(t, kinds.get(p, interpolation.COUNTED)) for (_, t), p in zip(docs, part)])
    got = {r.doc_id: r for r in QUERIES["op13_interpolated_scores"](spark, SF).collect()}
    assert len(got) == len(docs)
    held, base = 0.0, 0.0
    for (doc, _), p, (n, known, total, low, score) in zip(docs, part, want):
        r = got[doc]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (p == 0, n, known, total)
        assert r.base_score == pytest.approx(low, abs=1e-6)
        # weights are rounded, sums of doubles differ in their last digits
        assert r.score == pytest.approx(score, rel=1e-5)
        held, base = held + (p == 0) * r.score, base + (p == 0) * r.base_score
    assert held > base  # texts left out are told better than by single tokens


def test_probabilities_of_all_tokens_sum_to_one():
    """Of every known token and the class of unknown ones, after any context."""
    model = counted(["a b a c", "b a b", "c c a", "", "a"])
    known = list(model[0])
    weights = np.random.default_rng(4).random((2, interpolation.LEVELS))
    weights[:, 0] = 0
    for before in (*known, "unseen"):
        p = [probability(model, len(known), weights, before, t) for t in (*known, "zz")]
        assert sum(p) == pytest.approx(1, abs=1e-12)


def test_scores_of_odd_rows(spark, odd):
    part = F.when(F.col("doc_id") == 6, 0).when(F.col("doc_id") == 4, 2).otherwise(1)
    keep = {"note": F.col("score"), "place": F.col("rank")}
    got = sorted(interpolation.score(odd, part, keep=keep).collect(), key=lambda r: r.place)
    rows = sorted(ODD, key=lambda r: r[3])
    kinds = [0 if d == 6 else 2 if d == 4 else 1 for d, *_ in rows]
    want = brute_scores([(t, k) for (_, t, *_), k in zip(rows, kinds)])
    for r, (doc, _, note, place), (n, known, total, base, score) in zip(got, rows, want):
        assert (r.doc_id, r.note, r.place, r.n_tokens, r.n_known, r.train_tokens) == (
            doc, note, place, n, known, total
        )
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert r.score == pytest.approx(score, rel=1e-5)


def test_scores_without_training_or_rows(spark, odd):
    assert interpolation.score(odd.limit(0), F.lit(1)).count() == 0
    got = interpolation.score(odd, F.lit(0)).collect()
    assert len(got) == len(ODD)
    assert all((r.n_known, r.train_tokens, r.score) == (0, 0, 0.0) for r in got)


def test_counts_do_not_depend_on_blocks(spark):
    docs = table(spark, SF, "documents")
    part = F.pmod(F.col("doc_id"), F.lit(3)).cast("int")
    found = []
    for size in (1 << 30, 50_000):
        rows = interpolation.gram_counts(docs, part, order=3, block_bytes=size).collect()
        known = sum(r.known_tokens for r in rows)
        found.append((known, {r.doc_id: (r.n_known, r.counts, r.left_counts) for r in rows}))
    assert found[0] == found[1] and found[0][0] > 0
