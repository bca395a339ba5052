"""Digests, importance weights and the pipeline against plain computations."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import pytest
import public_tokenizers
import xxhash

from boxtrail.llm import fingerprint, importance, token_files
from boxtrail.llm.common import ship, table
from boxtrail.llm.queries import ORACLES, QUERIES
from oracle import connect

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
RUNS = re.compile(rb"[0-9A-Za-z\x00-\x08\x0e-\x1f\x80-\xff]+|[!-/:-@\[-`{-\x7f]+")


def mixed(x):
    for _ in range(2):
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & MASK
    return x ^ (x >> 32)


def word_hash(word: bytes) -> int:
    total = sum(mixed((b + 1) * BASE & MASK) * pow(BASE, i, 1 << 64) for i, b in enumerate(word))
    return mixed(total & MASK)


def buckets_and_words(text):
    found = [word_hash(w) for w in RUNS.findall((text or "").encode().lower())]
    pairs = [mixed((a * 0x9FB21C651E98DF25 + b) & MASK) for a, b in zip(found, found[1:])]
    return Counter(h % importance.BUCKETS for h in found + pairs), set(found)


def importance_rows(documents, labels):
    """Weight and key of every document and the ids taken, as the module states them."""
    made = {doc: buckets_and_words(text) for doc, text in documents}
    good = {doc for doc, quality, toxic in labels if quality == 1 and toxic != 1}
    raw, target = Counter(), Counter()
    for doc, (counts, _) in made.items():
        raw.update(counts)
        if doc in good:
            target.update(counts)
    part = sum(target.values()) / sum(raw.values())
    ratio = {
        b: (target[b] + importance.PRIOR) / (n * part + importance.PRIOR) for b, n in raw.items()
    }
    mean = sum(n * ratio[b] for b, n in raw.items()) / sum(raw.values())

    toxic = Counter()
    for doc, _, bad in labels:
        if bad is not None:
            toxic[doc] = max(toxic[doc], bad)
    seen, bad_seen, z = Counter(), Counter(), importance.MARK_ERRORS
    for doc, bad in toxic.items():
        for word in made.get(doc, ((), ()))[1]:
            seen[word] += 1
            bad_seen[word] += bad
    marks = set()
    for word, n in seen.items():
        p = bad_seen[word] / n
        spread = z * math.sqrt(p * (1 - p) / n + (z / (2 * n)) ** 2)
        if (p + z * z / (2 * n) - spread) / (1 + z * z / n) > 0.5:
            marks.add(word)

    rows = {}
    for doc, (counts, own) in made.items():
        weight = sum(n * math.log(ratio[b] / mean) for b, n in counts.items())
        weight -= importance.MARKED if own & marks else 0
        seed = xxhash.xxh64_intdigest(struct.pack("<i", importance.SEED), 42)
        high = xxhash.xxh64_intdigest(struct.pack("<q", doc), seed) >> 12
        noise = -math.log(-math.log((high + 0.5) / (1 << 52)))
        rows[doc] = (weight, (weight + noise) * importance.UNIT)
    judged = [(q if t != 1 else 0) for _, q, t in labels if q is not None or t == 1]
    share = sum(judged) / len(judged)
    share = min(1.0, share + 3 * (share * (1 - share) / len(judged)) ** 0.5)
    order = sorted(rows, key=lambda doc: -rows[doc][1])
    return rows, set(order[: math.ceil(share * len(order))])


@pytest.fixture(scope="module")
def documents(spark):
    ship(spark)
    return [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def judged_rows(spark, documents):
    labels = table(spark, SF, "labels").select("doc_id", "quality", "toxic").collect()
    return importance_rows(documents, [tuple(r) for r in labels])


def test_op3_weights_keys_and_choice(spark, judged_rows):
    rows, taken = judged_rows
    got = {r.doc_id: r for r in QUERIES["op3_importance_resampling"](spark, SF).collect()}
    assert set(got) == taken
    for doc, row in got.items():
        assert row.log_weight == pytest.approx(rows[doc][0], abs=1e-6)
        assert abs(row.key - rows[doc][1]) <= 2


def test_op3_on_odd_rows(spark):
    """Texts without words weigh nothing; repeated rows share their fate."""
    docs = spark.createDataFrame(
        [(1, None, 7), (2, "", 7), (3, " \n", 7), (4, "good text here", 7),
         (4, "good text here", 7), (None, "bad bad bad", 7), (5, "x " * 20_000, 7)],
        "doc_id long, text string, log_weight int",
    )
    ship(spark)
    targets = spark.createDataFrame([(4,)], "doc_id long")
    every = importance.sample(docs, targets, 1.0).collect()
    weights = {}
    for r in every:
        weights.setdefault(r.doc_id, []).append((r.log_weight, r.key))
    assert len(every) == 7 and all(weights[d][0][0] == 0 for d in (1, 2, 3))
    assert weights[4][0] == weights[4][1] and weights[4][0][0] > weights[None][0][0]
    kept = importance.keep_sampled(docs, targets, 1.0)
    assert kept.columns == docs.columns and kept.where("log_weight = 7").count() == 7


def digest(text):
    data = text.encode()
    counts = [0] * 256
    for a, b, c in zip(data, data[1:], data[2:]):
        counts[((a | b << 8 | c << 16) * 0x9E3779B1 & 0xFFFFFFFF) >> 24] += 1
    cuts = [sorted(counts)[k] for k in (63, 127, 191)]
    quartile = [sum(c > cut for cut in cuts) for c in counts]
    return [min(255, round(8 * math.log2(len(data) + 1)))], quartile


def alike(x, y):
    apart = sum((0, 1, 2, 6)[abs(a - b)] for a, b in zip(x[1], y[1]))
    return max(0.0, 1 - (apart + min(48, abs(x[0][0] - y[0][0]))) / 416)


def written(made):
    quads = [made[1][k : k + 4] for k in range(0, 256, 4)]
    return bytes(made[0] + [q[0] << 6 | q[1] << 4 | q[2] << 2 | q[3] for q in quads]).hex()


def test_op8_digests_and_likeness(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op8_quartile_digest"](spark, SF).collect()}
    order = sorted(documents, reverse=True)
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 3
        mine, edited = digest(text), digest(text[: len(text) - cut] + after[:cut])
        row = got[doc]
        assert row.fingerprint == written(mine)
        assert row.edited_fingerprint == written(edited)
        assert row.near_edited == pytest.approx(alike(mine, edited))
        assert row.near_next == pytest.approx(alike(mine, digest(after)))


def test_fingerprints_of_odd_texts(spark):
    ship(spark)
    texts = ["", None, "ab", "abc" * 9_000, "é😀", "abc" * 9_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(docs).collect()}
    assert got == {k: written(digest(t or "")) for k, t in enumerate(texts)}


def test_token_files_take_special_strings_as_text(spark, tmp_path):
    """Against the library opened here as the vocabulary's description shows it."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    texts = ["<|endoftext|> hi", "a<|endoftext|><|endoftext|>b", None, "hi"]
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "tokens"))
    got = {r.doc_id: r for r in token_files.read_tokens(spark, str(tmp_path / "tokens")).collect()}
    for doc, text in enumerate(texts):
        ids = plain.encode(text or "", add_special_tokens=False).ids
        assert list(got[doc].ids)[: len(ids)] == ids and 50256 not in ids


def sql_over(docs, key):
    """An operator's SQL with a stage's input as the table of documents."""
    con = connect(SF)
    frame = docs.toArrow()
    con.register("frame", frame)
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM frame")
    cursor = con.execute(ORACLES[key])
    names = [c[0] for c in cursor.description]
    return {row["doc_id"]: row for row in (dict(zip(names, r)) for r in cursor.fetchall())}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_pipeline_stage_by_stage_and_as_a_whole(spark, judged_rows):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality", "line_dedup", "minhash_dedup", "substring_dedup", "packing"
    ]

    def after(name, docs):
        out = stages[name](spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        return spark.createDataFrame(rows, docs.schema), {r.doc_id: r for r in rows}

    docs = table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    docs, got = after("quality", docs)
    assert got == {doc: before[doc] for doc in judged_rows[1]}

    truth = sql_over(docs, "op1_line_dedup")
    docs, got = after("line_dedup", docs)
    assert {d: sha(r.text or "") for d, r in got.items()} == {
        d: r["kept_sha256"] or sha("") for d, r in truth.items()
    }

    truth, lines = sql_over(docs, "op10_minhash_dedup"), got
    docs, got = after("minhash_dedup", docs)
    assert got == {d: lines[d] for d, r in truth.items() if r["kept"]}

    truth = sql_over(docs, "op2_substring_dedup")
    docs, got = after("substring_dedup", docs)
    space = re.compile(r"[^\x20\x09-\x0D]+")
    assert {d: sha(" ".join(space.findall(r.text))) for d, r in got.items()} == {
        d: r["kept_sha256"] for d, r in truth.items()
    }

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    pieces = corpus_pipeline.run(spark, SF).collect()
    ends = Counter()
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        ids = plain.encode(got[p.doc_id].text, add_special_tokens=False).ids + [1]
        part = ids[p.start : p.start + p.length]
        assert (p.start, len(part), p.doc_tokens) == (ends[p.doc_id], p.length, len(ids))
        assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        ends[p.doc_id] += p.length
    assert ends == {d: ends[d] for d in got} and len(ends) == len(got)
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    for (s, at, n), (t, to, _) in zip(places, places[1:]):
        assert (t, to) == ((s, at + n) if s == t else (s + 1, 0)) and at + n <= 2048
