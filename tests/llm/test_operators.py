"""The operators against brute force, over the smallest tables and odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from boxtrail.llm import (
    bpe, fingerprint, importance, line_dedup, minhash_dedup, pack, substring_dedup,
    token_files, token_trees, units, vector_search, vocabulary,
)
from boxtrail.llm.common import ship, table
from boxtrail.llm.queries import ORACLES, QUERIES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "a b c d e f g h i j k l m n o p q"
ODD = [
    (1, None, "x", 1), (2, "", None, 1), (3, " \n\t ", "x", 2), (4, LONG, "x", 3),
    (4, LONG, "x", 3), (5, f"{LONG}\n{LONG} z", None, 4), (None, LONG, "y", 5),
    (6, "  two  spaces é😀\x1c ", "y", 6), (7, "w " * 30_000, "y", 7), (8, "A B C D E F", "y", 8),
]
SCHEMA = "doc_id long, text string, source string, kept long"


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


def reference_encoder():
    import tiktoken

    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks(RANKS),
        special_tokens={},
    )


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_sql(spark, key):
    assert compare(QUERIES[key](spark, SF), connect(SF), ORACLES[key]) == []


def test_bpe_and_trees_equal_the_library_after_edits():
    truth, rnd = reference_encoder(), random.Random(3)
    encoder = bpe.prefix_encoder(RANKS)
    count, leaves = token_trees._counter(JSON), vocabulary.token_counts(JSON)
    for _ in range(400):
        text, new = ("".join(rnd.choices("ab 'slre\n\t.1é😀 \x1c", k=rnd.randint(0, n)))
                     for n in (40, 6))
        low = rnd.randint(0, len(text))
        high = rnd.randint(low, len(text))
        want = text[:low] + new + text[high:]
        edited = bpe.EncodedText(encoder, text)
        edited.replace(low, high, new)
        assert edited.ids() == truth.encode_ordinary(want)
        edited.append("'re x")
        assert edited.ids() == truth.encode_ordinary(want + "'re x")
        tree = token_trees.CountTree(leaves([text])[0])
        tree = token_trees.CountTree.from_bytes(tree.to_bytes())
        tree.replace(text, low, high, new, count)
        assert (tree.n_tokens, tree.n_chars) == (len(truth.encode_ordinary(want)), len(want))


def test_units_forget_and_still_encode():
    encoder = vocabulary.tokenizer(JSON)
    small = units.UnitEncoder(
        lambda u: vocabulary.token_encoder.__wrapped__(JSON)._encode(u), limit=50
    )
    for k in range(5):
        texts = [f"word{k}{j} and\nmore{j}" for j in range(40)]
        flat, at = small(texts)
        for j, text in enumerate(texts):
            assert flat[at[j] : at[j + 1]].tolist() == encoder.encode(text).ids


def test_op4(spark, documents):
    truth = reference_encoder()
    got = {r.doc_id: r for r in QUERIES["op4_prefix_bpe"](spark, SF).collect()}
    for doc, text in documents:
        ids = truth.encode_ordinary(text or "")
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_op6_covers_every_token_once(spark, documents):
    encoder = vocabulary.tokenizer(JSON)
    pieces = QUERIES["op6_mixture_packing"](spark, SF).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc, text in documents:
        ids, at = encoder.encode(text or "").ids + [1], 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += p.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == own[0].sequence_length and (at == 2048 or at & (at - 1) == 0)


def test_mixture_serves_what_falls_due_first():
    totals = [7, 1, 120, 33]
    mixture = pack.Mixture(totals, length=16)
    due = sorted(((i + 0.5) / n, k) for k, n in enumerate(totals) for i in range(n))
    served = mixture.served(np.arange(sum(totals) + 1))
    for place, (_, queue) in enumerate(due):
        step = np.zeros(4, dtype=int)
        step[queue] = 1
        assert (served[place + 1] - served[place] == step).all()
    assert all(abs(mixture.deficits(k)).max() < 2 for k in range(mixture.sequences))
    weighted = pack.Mixture(totals, [1, 1, 2, 0], 16)
    assert (weighted.served(np.array([sum(totals)]))[0] == totals).all()


def test_op7(spark, documents):
    encoder, start = vocabulary.tokenizer(JSON), 0
    got = {r.doc_id: tuple(r) for r in QUERIES["op7_token_files"](spark, SF).collect()}
    for doc, text in sorted(documents):
        ids = np.array(encoder.encode(text or "").ids + [0], "<u4")
        assert got[doc] == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op8(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op8_quartile_digest"](spark, SF).collect()}
    order = sorted(documents, reverse=True)
    closer = 0
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        row = got[doc]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_next <= 1 and 0 <= row.near_edited <= 1
        closer += row.near_edited > row.near_next
    assert closer > 0.9 * len(order)


def test_op9(spark, documents):
    truth = reference_encoder()
    rows = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    for r in QUERIES["op9_token_trees"](spark, SF).collect():
        row = rows[r.doc_id]
        text = row.text or ""
        middle = len(text) // 2
        edited = f"{text[:middle]} {row.lang} {row.source}{text[middle + 24:]}"
        assert r.n_tokens_before == len(truth.encode_ordinary(text))
        assert r.n_tokens == len(truth.encode_ordinary(edited))
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_op3_keeps_good_documents_out_of_sample(spark):
    sf = "/root/testdata/sf0.1"
    ship(spark)
    labels = table(spark, sf, "labels").where("quality IS NOT NULL")
    held_out = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    fitted = labels.join(held_out.select("doc_id"), "doc_id", "left_anti")
    kept = importance.sample(
        table(spark, sf, "documents"), importance.target_ids(fitted),
        importance.good_share(fitted),
    ).select("doc_id", F.lit(1).alias("in"))
    share = dict(
        held_out.join(kept, "doc_id", "left").groupBy("quality")
        .agg(F.avg(F.coalesce("in", F.lit(0)))).collect()
    )
    # what the upper bound of the good share lets in beside the good ones
    plain = fitted.agg(F.avg("quality")).first()[0]
    let_in = (importance.good_share(fitted) - plain) / (1 - plain)
    assert share[1] > 0.97 and share[0] < let_in + 0.05


INSULTS = "trash|pathetic|idiot|worthless|disgusting|stupid|clown|scum|loser|moron"


def test_op3_leaves_toxic_documents_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents")
    marked = F.col("text").rlike(rf"(?i)\b({INSULTS})\b")
    kept = QUERIES["op3_importance_resampling"](spark, sf)
    assert docs.where(marked).count() > 500
    assert docs.where(marked).join(kept, "doc_id", "left_semi").count() == 0

    labels = importance.judged(table(spark, sf, "labels"))
    held_out = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    fitted = labels.join(held_out.select("doc_id"), "doc_id", "left_anti")
    assert importance.target_ids(fitted).join(
        labels.where("toxic = 1"), "doc_id", "left_semi").isEmpty()
    # a text far longer and better than any other, but for one word
    good = docs.join(importance.target_ids(fitted, 300), "doc_id", "left_semi")
    texts = " ".join(r.text for r in good.where("lang = 'en'").collect())
    more = spark.createDataFrame([(-1, texts), (-2, f"{texts} Moron")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(more)
    marks = importance.toxic_words(docs, fitted)
    kept = importance.sample(
        docs, importance.target_ids(fitted), importance.good_share(fitted), marks=marks
    ).select("doc_id", F.lit(1).alias("in")).cache()
    assert [r.doc_id for r in kept.where("doc_id < 0").collect()] == [-1]
    rows = held_out.join(kept, "doc_id", "left").groupBy("quality", "toxic").agg(
        F.avg(F.coalesce("in", F.lit(0))), F.count("*")).collect()
    share = {(r[0], r[1]): r[2] for r in rows}
    assert share[1, 0] > 0.97 and share[0, 1] < 0.25


@pytest.mark.parametrize("size", ["0.1", "0.01", "0.001"])
def test_readme_states_what_the_good_share_lets_through(spark, size):
    labels = importance.judged(table(spark, f"/root/testdata/sf{size}", "labels"))
    rows = labels.where("quality IS NOT NULL")
    plain = rows.agg(F.avg("quality")).first()[0]
    let_in = (importance.good_share(labels) - plain) / (1 - plain)
    readme = (Path(__file__).parents[2] / "README.md").read_text()
    assert f"{100 * let_in:.1f}% at sf{size} (" in " ".join(readme.split())


def test_kth_highest(spark):
    values = [random.Random(k).randint(-10**12, 10**12) for k in range(300)] + [5, 5, 5]
    keys = spark.createDataFrame([(v,) for v in values], "key long")
    ordered = sorted(values, reverse=True)
    for k in (1, 17, 150, len(values)):
        assert importance.kth_highest(keys, k) == ordered[k - 1]
    assert importance.kth_highest(keys, len(values) + 1) is None


def test_large_buckets_give_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "SMALL", 1)
    key = "op10_minhash_dedup"
    assert compare(QUERIES[key](spark, SF), connect(SF), ORACLES[key]) == []


def test_rows_without_an_id_link_others(spark):
    ship(spark)

    def words(prefix, first):
        return " ".join(f"{prefix}{k}" for k in range(first, first + 100))

    # 86 of 106 shingles in common ten words on, 76 of 116 twenty words on
    rows = [
        (1, words("a", 0)), (None, words("a", 10)), (2, words("a", 20)),
        (3, words("b", 0)), (None, words("b", 3)), (None, words("c", 0)), (None, words("c", 2)),
        (4, words("a", 40)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for small in (minhash_dedup.SMALL, 1):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(minhash_dedup, "SMALL", small)
            got = [(r.doc_id, r.component_id, r.kept) for r in minhash_dedup.groups(docs).collect()]
        assert sorted(got, key=str) == sorted([
            (1, 1, True), (None, 1, False), (2, 1, False), (3, 3, True), (None, 3, False),
            (None, None, False), (None, None, False), (4, 4, True),
        ], key=str)


def test_odd_rows(odd):
    lines = line_dedup.remove_lines(odd).select("n_lines", "n_removed", "kept_text")
    got = sorted((tuple(r) for r in lines.collect()), key=str)
    assert (0, 0, None) in got and (1, 0, "") in got
    # the longer line of document 5 has 18 words, of which 17 stand in document 4
    assert (2, 2, "") in got
    cut = {r.doc_id: r for r in substring_dedup.remove_repeats(odd).collect() if r.doc_id}
    assert cut[1].kept_text == "" and (cut[5].n_words, cut[5].n_removed) == (35, 34)
    assert cut[4].n_removed == 0 and cut[7].n_removed == 0
    groups = [tuple(r) for r in minhash_dedup.groups(odd).collect()]
    assert (1, 0, 1, True) in groups and (None, 13, 4, False) in groups
    assert (8, 2, 8, True) in groups and groups.count((4, 13, 4, True)) == 2
    assert minhash_dedup.keep_one(odd).columns == odd.columns
    assert fingerprint.edited_neighbours(odd).count() == len(ODD)
    assert fingerprint.fingerprints(odd).count() == len(ODD)
    assert bpe.decode(bpe.encode(odd)).count() == len(ODD)
    packed = pack.pack(odd).groupBy("queue").agg(F.sum("length"))
    assert {r[0] for r in packed.collect()} == {None, "x", "y"}


def test_empty_tables(spark, odd, tmp_path):
    none = odd.limit(0)
    token_files.write_tokens(none, str(tmp_path / "tokens"))
    assert token_files.read_tokens(spark, str(tmp_path / "tokens")).count() == 0
    ids = none.select("doc_id")
    for frame in (
        line_dedup.remove_lines(none), substring_dedup.remove_repeats(none),
        minhash_dedup.groups(none), pack.pack(none), fingerprint.edited_neighbours(none),
        bpe.encode(none), importance.sample(none, ids, 0.5), token_trees.trees(none),
        vector_search.top_k(
            spark.createDataFrame([], "vec_id long, vector array<long>"), F.lit(True)
        ),
    ):
        assert frame.count() == 0


def test_pipeline_stages_return_documents(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == docs.count()
