"""The operators over the test tables, and SQL for those that have one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from boxtrail.llm import (
    bpe,
    fingerprint,
    importance,
    interpolation,
    line_dedup,
    minhash_dedup,
    pack,
    resampling,
    spelling,
    substring_dedup,
    token_files,
    token_trees,
    vector_search,
)
from boxtrail.llm.common import ship, table
from boxtrail.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def shipped(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = shipped
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return shipped

    return add


@_query(r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(range(len(lines))) AS line_no, unnest(lines) AS line FROM split),
sets AS (
  SELECT doc_id, line_no, line, list_sort(list_distinct(list_filter(
    regexp_split_to_array(line, '[ \t\x0B\f\r]+'), lambda w: w <> ''))) AS words FROM lines),
first AS (
  SELECT words, len(words) AS n, min((doc_id, line_no)) AS place
  FROM sets WHERE len(words) > 0 GROUP BY words),
heads AS (
  SELECT words, n, place, unnest(words[1:n - CAST(ceil(90 * n / 100) AS BIGINT) + 1]) AS head
  FROM first WHERE n >= 9),
later AS (
  SELECT DISTINCT y.words FROM heads x JOIN heads y
    ON x.head = y.head AND x.place < y.place
   AND 10 * x.n >= 9 * y.n AND 10 * y.n >= 9 * x.n
   AND 100 * len(list_intersect(x.words, y.words))
    >= 90 * (x.n + y.n - len(list_intersect(x.words, y.words)))),
marked AS (
  SELECT s.doc_id, s.line_no, s.line, len(s.words) > 0 AND (
      (s.doc_id, s.line_no) <> f.place OR l.words IS NOT NULL) AS gone
  FROM sets s LEFT JOIN first f ON s.words = f.words LEFT JOIN later l ON s.words = l.words)
SELECT d.doc_id, CAST(count(m.line) AS BIGINT) AS n_lines,
  CAST(count(*) FILTER (WHERE m.gone) AS BIGINT) AS n_removed,
  CASE WHEN any_value(d.text) IS NOT NULL THEN sha256(coalesce(
    string_agg(m.line, chr(10) ORDER BY m.line_no) FILTER (WHERE NOT coalesce(m.gone, FALSE)),
    '')) END AS kept_sha256
FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id GROUP BY d.doc_id
""")
def op1_line_dedup(spark, sf_dir):
    """Lines that stay in each document."""
    found = line_dedup.remove_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@_query(r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS passage
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM split)),
first AS (SELECT passage, min(doc_id) AS doc_id FROM windows GROUP BY passage),
gone AS (
  SELECT DISTINCT w.doc_id, w.p + k AS p FROM windows w JOIN first f USING (passage),
    range(13) r(k) WHERE f.doc_id < w.doc_id),
words AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS word FROM split),
marked AS (
  SELECT w.doc_id, w.p, w.word, g.p IS NOT NULL AS gone
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p)
SELECT d.doc_id, CAST(count(m.word) AS BIGINT) AS n_words,
  CAST(count(*) FILTER (WHERE m.gone) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.p) FILTER (WHERE NOT m.gone), ''))
    AS kept_sha256
FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id GROUP BY d.doc_id
""")
def op2_substring_dedup(spark, sf_dir):
    """Words that stay in each document."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.array_remove(F.split("kept_text", r"[\x20\x09-\x0D]+"), "")
    return found.select(
        "doc_id", "n_words", "n_removed",
        F.sha2(F.array_join(kept, " "), 256).alias("kept_sha256"),
    )


@_query()
def op3_importance_resampling(spark, sf_dir):
    """The documents sampled towards the labelled good ones, with their weights."""
    docs = table(spark, sf_dir, "documents")
    labels = importance.judged(table(spark, sf_dir, "labels"))
    return importance.sample(
        docs,
        importance.target_ids(labels),
        importance.good_share(labels),
        marks=importance.toxic_words(docs, labels),
    )


@_query()
def op4_prefix_bpe(spark, sf_dir):
    """Digests of each document's ids and of the bytes they decode to."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), decoded=True)
    return encoded.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query("""
WITH whole AS (
  SELECT vec_id, list_transform(embedding,
    lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored) WHERE rank <= 5
""")
def op5_pivot_top_k(spark, sf_dir):
    """The five best vectors of each query vector."""
    rows = table(spark, sf_dir, "embeddings")
    whole = rows.where(vector_search.complete(F.col("embedding"))).select(
        "vec_id", vector_search.quantised(F.col("embedding")).alias("vector")
    )
    return vector_search.top_k(whole, F.col("vec_id") % 50 == 0)


@_query()
def op6_mixture_packing(spark, sf_dir):
    """The pieces of all documents in their sequences."""
    found = pack.pack(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", F.col("queue").alias("source"), "sequence_length",
    )


@_query()
def op7_token_files(spark, sf_dir):
    """Checksums of each document's ids, read back from the written files."""
    path = scratch_path(spark, "token_files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.checksums(token_files.read_tokens(spark, path))


@_query()
def op8_quartile_digest(spark, sf_dir):
    """Fingerprints of each text and its edited text, and their likenesses."""
    return fingerprint.edited_neighbours(table(spark, sf_dir, "documents"))


@_query()
def op9_token_trees(spark, sf_dir):
    """Token counts before and after an edit in the middle of each document.

    The edit takes out up to 24 characters and puts in the document's language and
    source.
    """
    docs = table(spark, sf_dir, "documents")
    middle = F.floor(F.char_length(F.coalesce("text", F.lit(""))) / 2)
    edits = docs.select(
        "doc_id", "text", middle.alias("start"), (middle + 24).alias("end"),
        F.concat_ws(" ", F.lit(""), "lang", "source").alias("new"),
    )
    return token_trees.count_edited(edits).select(
        "doc_id", "n_tokens_before", "n_tokens", "n_recounted",
        F.sha2("text", 256).alias("edited_sha256"),
    )


@_query(r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS p
        FROM split WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE r(a, b) AS (
    SELECT a, b FROM edges UNION SELECT r.a, e.b FROM r JOIN edges e ON r.b = e.a)
  SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
  least(d.doc_id, coalesce(r.least, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(r.least, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN reach r ON d.doc_id = r.a
""")
def op10_minhash_dedup(spark, sf_dir):
    """Near-duplicate groups of documents."""
    return minhash_dedup.groups(table(spark, sf_dir, "documents"))


#: CRC-32 of the UTF-8 bytes of `{text}`, with the table `t` of `_CRC_TABLE`.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(
    range(1, length(hex({text})), 2), lambda i: CAST('0x' || substr(hex({text}), i, 2) AS BIGINT))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)"""
_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t)"""


@_query(rf"""
WITH {_CRC_TABLE},
texts AS (
  SELECT doc_id, text, TRUE AS raw FROM documents
  UNION ALL SELECT item_id, text, FALSE FROM benchmark),
split AS (
  SELECT doc_id, raw, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
runs AS (
  SELECT doc_id, raw, unnest(words) AS feature FROM split
  UNION ALL
  SELECT doc_id, raw, unnest(list_transform(range(1, len(words)),
    lambda i: words[i] || ' ' || words[i + 1])) FROM split),
counted AS (SELECT doc_id, raw, feature, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT feature, {_CRC.format(text="feature")} % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted), crc),
totals AS (
  SELECT bucket, sum(n) FILTER (WHERE raw) AS s, sum(n) FILTER (WHERE NOT raw) AS t
  FROM counted JOIN hashed USING (feature) GROUP BY bucket),
sums AS (SELECT sum(s) AS s, sum(t) AS t FROM totals),
gains AS (
  SELECT bucket, floor(1000 * ln(
    (coalesce(a.t, 0) + 1.0::DOUBLE) * (coalesce(b.s, 0) + 10000.0::DOUBLE)
    / ((coalesce(a.s, 0) + 1.0::DOUBLE) * (coalesce(b.t, 0) + 10000.0::DOUBLE)))) AS gain
  FROM totals a, sums b),
weights AS (
  SELECT doc_id, sum(n) AS n_features, floor(sum(n * gain) / sum(n)) AS weight
  FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE raw GROUP BY doc_id),
scored AS (
  SELECT s.doc_id, coalesce(len(words), 0) AS n_words,
    CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
    CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (CAST('0x' || sha256('7:' || s.doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM split s LEFT JOIN weights w ON s.doc_id = w.doc_id WHERE raw),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
    count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score,
  CASE WHEN rank <= 25 * n // 100 THEN CAST(rank AS BIGINT) END AS rank
FROM scored s LEFT JOIN drawn d ON s.doc_id = d.doc_id
""")
def op11_target_resampling(spark, sf_dir):
    """A quarter of the documents with twenty words, drawn towards the benchmark."""
    found = resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@_query(rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY ALL),
named AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS name FROM runs),
hashed AS (SELECT run, n, {_CRC.format(text="name")} AS h FROM named, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
      ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words),
gaps AS (
  SELECT word, n, left(word, p - 1) || '_' || substr(word, p + 1) AS open,
    left(word, p - 1) || substr(word, p + 1) AS less FROM places),
pairs AS (
  SELECT a.word, b.word AS near, b.n FROM gaps a JOIN gaps b USING (open) WHERE a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.less = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.less = w.word),
ranked AS (
  SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place FROM pairs),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
    CASE WHEN r.n >= 10 * w.n THEN r.near END AS form,
    CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1),
chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.next = f.word)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN chain c ON f.word = c.word AND c.next IS NULL
""")
def op12_spelling_variants(spark, sf_dir):
    """Each frequent word with its near words, its form and its root."""
    run = spelling.runs(table(spark, sf_dir, "documents"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    word = spelling.without_one(F.col("run"), F.crc32(name.cast("binary")), every=31)
    return spelling.variants(spelling.counted(run.select(word.alias("word"))))


@_query()
def op13_interpolated_scores(spark, sf_dir):
    """Log probabilities of all documents under a model of nine tenths of them.

    Weights are learned on a ninth of the training documents.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    part = F.pmod(F.crc32(name.cast("binary")), F.lit(10))
    found = interpolation.score(
        table(spark, sf_dir, "documents"),
        F.when(part == 0, interpolation.SCORED)
        .when(part == 1, interpolation.DELETED)
        .otherwise(interpolation.COUNTED),
    )
    return found.select(
        "doc_id", (F.col("part") == interpolation.SCORED).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )
