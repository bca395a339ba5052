"""Removal of lines that resemble an earlier line, by an exact set-similarity join.

A line's set are its distinct words; a word is a run of characters other than space
and the control characters 9 to 13. Lines with equal sets form a class, which stands
where its first line does. Classes are joined by prefixes:

- The words of a line are sorted by rarity: by how often the words of their hash
  bucket occur in the corpus, then by hash. Any common order gives the same result.
- Two lines of similarity t share one of the first n - ceil(t n) + 1 words of each
  (prefix filter), their sizes differ by a factor t at most (length filter), and from
  the places of the shared word the rest must still suffice (positional filter). A
  64-bit parity of the words' hashes bounds how many words they do not share.
- Only rows of one word and of like sizes meet: sizes fall into bands, and a row that
  can resemble a larger set of another band stands there, too.
- Each class is first held against the earliest one with the same prefix word and
  band. Only where these two fall through the filters are all earlier ones tried. A
  boilerplate line in many variants thus costs one comparison for each variant and word.
- Candidates are verified on their whole sets. A class that resembles none of its
  candidates is tried again, with all earlier ones of the words and bands whose first
  one verification refuted.

A line goes if it is not the first of its class, or if its class resembles an earlier
class. All steps are DataFrame operations. Words are compared by 56 bits of a hash
and their rarity, classes by 64 bits and the size.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from boxtrail.llm.common import column, packed, stored, unpacked

#: Per cent.
SIMILARITY = 90
#: Hash buckets by which the frequency of words is counted.
BUCKETS = 1 << 15
#: Bits for each wanted value in the filter that keeps other lines from being moved.
FILTER_BITS = 32
#: Bits in one of Spark's bitmaps.
BITMAP = 1 << 15
#: The factor between the smallest sizes of two neighbouring bands.
BAND = 1.25

#: Spaces within a line, but for the space itself.
_RARE_SPACES = "\t\x0b\f\r"


def _plain(text: str) -> Column:
    """The text with a space for each of the rare ones, asked of a whole text at once."""
    plain = F.translate(text, _RARE_SPACES, " " * len(_RARE_SPACES))
    odd = reduce(or_, [F.col(text).contains(c) for c in _RARE_SPACES])
    return F.when(odd, plain).otherwise(F.col(text))


def _words(line: str | Column) -> Column:
    """The words of a plain line among empty strings; splitting at one character is fast."""
    return F.split(line, " ")


def _short(word: Column) -> Column:
    """56 bits of a word's hash."""
    return F.shiftrightunsigned(F.xxhash64(word), 8)


def _bucket(short: Column) -> Column:
    return F.shiftrightunsigned(short, 56 - BUCKETS.bit_length() + 1).cast("int")


def rarity(texts: DataFrame) -> bytes:
    """For each hash bucket, the logarithm of its words' occurrences: 1 to 127."""
    counts = (
        # Words do not care about lines here, so each text is split once.
        texts.select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("line"))
        .select(F.explode(_words(_plain("line"))).alias("word"))
        .where("word <> ''")
        .groupBy(_bucket(_short(F.col("word"))).alias("bucket"))
        .agg(F.least(F.lit(127), 1 + F.floor(4 * F.log2(F.count("*")))).cast("int").alias("level"))
    )
    levels = bytearray(b"\x01" * BUCKETS)
    for bucket, level in counts.collect():  # one row per bucket, whatever the input
        levels[bucket] = level
    return bytes(levels)


def _keys(line: str, levels: bytes) -> Column:
    """The distinct words of a plain line as numbers, rarest first.

    Only the making of the numbers is in lambdas, which are not compiled and make no use
    of what they have made already: each word is hashed in one, and each distinct hash
    gets its level in another. What follows runs compiled on longs, which takes numbers
    that cannot be null.
    """
    # Eight levels in a number, as plans on the driver hold and print this table. Made
    # once, when the plan is optimised; one literal for each number would not be.
    eights = [int.from_bytes(levels[k : k + 8], "big") for k in range(0, BUCKETS, 8)]
    table = F.split(F.lit(" ".join(map(str, eights))), " ").cast("array<long>")
    # One set for both: what repeats goes, and what stands for the empty strings.
    hashes = F.array_except(F.transform(_words(line), _short), F.array(_short(F.lit(""))))

    def key(h):
        """The level above the hash, which the other levels of its eight stir."""
        # The bucket is above the bits of `low`: an eight, then three bits in units of eight.
        low = 56 - BUCKETS.bit_length() + 1
        eight = F.coalesce(
            F.get(table, F.shiftrightunsigned(h, low + 3).cast("int")), F.lit(0).cast("long")
        )
        bits = F.shiftrightunsigned(h, low - 3).bitwiseAND(F.lit(56)).cast("int")
        return F.call_function("shiftleft", eight, bits).bitwiseXOR(h)

    return F.sort_array(F.transform(hashes, key))


def _parity(keys: str) -> Column:
    """64 bits, of which each is the parity of the words whose hash ends in its number."""
    bit = F.lit(1).cast("long")
    return F.aggregate(
        keys, F.lit(0).cast("long"),
        lambda a, k: a.bitwiseXOR(
            F.call_function("shiftleft", bit, k.bitwiseAND(F.lit(63)).cast("int"))
        ),
    )


def _has_words(line: str) -> Column:
    """Asked of the plain line: a filter on its keys would have Spark make them twice.

    No regular expression, as that takes each line for a string of Java's first.
    """
    return F.ltrim(F.col(line)) != ""


def _name() -> Column:
    return F.xxhash64("keys")


def _spot() -> Column:
    """Place in the document, and a little of the line's name for equal ids' sake."""
    return F.shiftleft(F.col("line_no").cast("long"), 16).bitwiseOR(
        F.col("name").bitwiseAND(F.lit(0xFFFF))
    )


def _lines(docs: DataFrame) -> DataFrame:
    """`doc_id`, `twin`, `line_no` and the plain `line`; `twin` tells texts with one id apart.

    `twin` is made first, or else each line would carry its text and hash it.
    """
    return docs.select(
        "doc_id", F.xxhash64("text").alias("twin"), _plain("text").alias("text")
    ).select("doc_id", "twin", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _ceil(value: Column, by: int) -> Column:
    return F.floor((value + (by - 1)) / by).cast("int")


def _passes(x: str, y: str, similarity: int) -> Column:
    """Length, positional and parity filters on two prefix rows.

    Of n + m words, similar sets share similarity / (100 + similarity) or more.
    """
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    whole = F.lit(100 + similarity).cast("long")
    shared = F.lit(similarity).cast("long") * (n + m)
    rest = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    apart = F.bit_count(F.col(f"{x}.parity").bitwiseXOR(F.col(f"{y}.parity")))
    return (
        (100 * F.least(n, m) >= similarity * F.greatest(n, m))
        & (whole * rest >= shared)
        & (whole * (n + m - apart) >= 2 * shared)
    )


def _before(x: str, y: str) -> Column:
    return (F.col(f"{x}.doc_id") < F.col(f"{y}.doc_id")) | (
        (F.col(f"{x}.doc_id") == F.col(f"{y}.doc_id")) & (F.col(f"{x}.spot") < F.col(f"{y}.spot"))
    )


def _pair(x: str, y: str, *more) -> list:
    return [
        F.col(f"{x}.doc_id").alias("x_doc"), F.col(f"{x}.spot").alias("x_spot"),
        F.col(f"{y}.doc_id").alias("y_doc"), F.col(f"{y}.spot").alias("y_spot"), *more,
    ]


def _band(n: Column) -> Column:
    return F.floor(F.ln(n) / log(BAND)).cast("int")


def _prefix_rows(classes: DataFrame, similarity: int) -> DataFrame:
    """A row for each prefix word and each band of sizes; `key` names both.

    The bands are that of the class itself and those of larger sets which, by the
    length and positional filters, the row may resemble.
    """
    n, left = F.col("n"), F.col("n") - F.col("pos")
    largest = F.least(100 * n / similarity, left * ((100 + similarity) / similarity) - n)
    # A little more, as these are floating-point numbers.
    last = _band(F.greatest(n, F.floor(largest + 0.001)))
    return (
        classes.select("doc_id", "spot", "n", "parity", F.posexplode("prefix").alias("pos", "word"))
        .withColumn("band", F.explode(F.sequence(_band(n), last)))
        .withColumn("key", F.shiftleft(F.col("word").cast("long"), 16).bitwiseOR(F.col("band")))
        .select("key", "doc_id", "spot", "n", "parity", "pos")
        # One filter for all uses, so that Spark deals the rows once for all of them.
        .where("key IS NOT NULL AND n IS NOT NULL AND parity IS NOT NULL")
    )


def _candidates(classes: DataFrame, similarity: int) -> DataFrame:
    """Pairs that pass the filters; `keys` are those of which the former is the earliest.

    Rows are dealt by key once and sorted twice, for a window that finds the earliest row
    of each key and for one join. Rows that pass with the earliest one ask no others:
    they take part in the join as its other side alone, which keeps many variants of one
    line from meeting each other. All others ask the rows before them, and the earliest
    one the rows after it. Both sides are sorted by the key alone: one column of numbers
    is sorted by its digits, several columns by comparing rows.
    """
    columns = ("doc_id", "spot", "n", "parity", "pos")
    rows = _prefix_rows(classes, similarity).repartition(F.col("key"))
    first = ~_before("e", "a")
    asking = (
        rows.select(
            "key", F.struct(*columns).alias("a"),
            F.min(F.struct(*columns)).over(Window.partitionBy("key")).alias("e"),
        )
        .where(first | ~_passes("e", "a", similarity))
        .select("key", "a", first.alias("first"))
    )
    met = asking.join(rows.alias("b"), "key").where(
        F.when(F.col("first"), _before("a", "b")).otherwise(_before("b", "a"))
        & _passes("a", "b", similarity)
    )

    def either(x: str, y: str) -> Column:
        return F.when(F.col("first"), F.col(x)).otherwise(F.col(y))

    return (
        met.select(
            either("a.doc_id", "b.doc_id").alias("x_doc"), either("a.spot", "b.spot").alias("x_spot"),
            either("b.doc_id", "a.doc_id").alias("y_doc"), either("b.spot", "a.spot").alias("y_spot"),
            F.when(F.col("first"), F.col("key")).alias("key"),
        )
        .groupBy("x_doc", "x_spot", "y_doc", "y_spot")
        .agg(F.collect_set("key").alias("keys"))
    )


def _filtered(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows that a bitmap of the wanted values, by all columns of `wanted`, lets pass.

    The bitmap has FILTER_BITS bits for each of them, so of other rows it lets the
    same share pass whatever the input, and is sent to all executors.
    """
    bits = BITMAP * ceil(FILTER_BITS * max(wanted.count(), 1) / BITMAP)
    bit = F.pmod(F.xxhash64(*wanted.columns), F.lit(bits)) + 1
    maps = (
        wanted.select(bit.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))
    )
    asked = rows.withColumn("p", bit)
    position = F.bitmap_bit_position("p")
    byte = F.substring("bitmap", F.floor(position / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    power = F.pow(F.lit(2), position % 8)
    return (
        asked.join(F.broadcast(maps), F.bitmap_bucket_number("p") == F.col("bucket"))
        .where(F.floor(value / power) % 2 == 1)
        .drop("p", "bucket", "bitmap")
    )


def _verified(pairs: DataFrame, docs: DataFrame, levels: bytes, similarity: int) -> DataFrame:
    """Add `alike` to pairs, from the whole sets of their lines."""
    places = (
        pairs.select(F.col("x_doc").alias("doc_id"), F.col("x_spot").alias("spot"))
        .union(pairs.select("y_doc", "y_spot"))
        .select("doc_id", F.shiftright("spot", 16).cast("int").alias("line_no"))
        .distinct()
    )
    places = stored(places, "places")
    ids = places.select("doc_id").distinct()
    # Other texts with the id of a wanted one may add sets; no pair has their spots.
    # Places are distinct. A semi join would be moved below the filter by the optimiser.
    sets = (
        _filtered(_lines(_filtered(docs, ids)).drop("twin"), places)
        .join(places, ["doc_id", "line_no"])
        .withColumn("keys", _keys("line", levels))
        .withColumn("name", _name())
        .select("doc_id", _spot().alias("spot"), "keys")
        .dropDuplicates(["doc_id", "spot"])
    )
    sets = stored(sets, "sets")
    x = sets.select(*[F.col(c).alias(f"x_{k}") for c, k in _SET])
    y = sets.select(*[F.col(c).alias(f"y_{k}") for c, k in _SET])
    both = F.size(F.array_intersect("x_keys", "y_keys"))
    union = F.size("x_keys") + F.size("y_keys") - both
    return (
        pairs.join(x, ["x_doc", "x_spot"]).join(y, ["y_doc", "y_spot"])
        .withColumn("alike", 100 * both >= similarity * union)
        .drop("x_keys", "y_keys")
    )


_SET = (("doc_id", "doc"), ("spot", "spot"), ("keys", "keys"))


def removed_lines(
    docs: DataFrame, similarity: int = SIMILARITY
) -> DataFrame:
    """`doc_id`, `twin` and `gone`, the numbers of the lines to remove, where there are any.

    `docs` has `doc_id` and `text`, both without nulls.
    """
    levels = rarity(docs)
    n = F.col("n")
    size = n - _ceil(similarity * n, 100) + 1
    # A set of n words resembles another one only if n / (n + 1) reaches the similarity.
    # Smaller ones are only held against equal sets, by name.
    joins = (100 - similarity) * n >= similarity
    lines = (
        _lines(docs)
        .where(_has_words("line"))
        .withColumn("keys", _keys("line", levels))
        .withColumn("n", F.size("keys"))
        .withColumn("name", _name())
        .select(
            "doc_id", "twin", "line_no", "n", "name",
            F.when(joins, F.transform(F.slice("keys", F.lit(1), size), lambda k: F.hash(k)))
            .alias("prefix"),
            F.when(joins, _parity("keys")).alias("parity"),
        )
    )
    lines = stored(lines, "lines").withColumn("spot", _spot())
    classes = (
        lines.where(joins).groupBy("name", "n")
        .agg(
            F.min(F.struct("doc_id", "spot")).alias("place"),
            F.first("prefix").alias("prefix"),
            F.first("parity").alias("parity"),
            F.count("*").alias("size"),
        )
        .select("place.*", "name", "n", "prefix", "parity", "size")
    )
    classes = stored(classes, "classes")
    pairs = stored(_candidates(classes, similarity), "pairs")
    checked = stored(_verified(pairs, docs, levels, similarity), "checked")
    later = checked.where("alike").select("y_doc", "y_spot").distinct()

    open_ = (
        checked.where("NOT alike").select("y_doc", "y_spot", F.explode("keys").alias("key"))
        .distinct().join(later, ["y_doc", "y_spot"], "left_anti")
        .withColumnsRenamed({"y_doc": "doc_id", "y_spot": "spot"})
    )
    open_ = stored(open_, "open")
    if not open_.isEmpty():
        again = classes.join(open_, ["doc_id", "spot"], "left_semi")
        asking = _prefix_rows(again, similarity).join(open_, ["doc_id", "spot", "key"], "left_semi")
        asking = stored(asking, "asking")
        asked = stored(asking.select("key").distinct(), "asked")
        earlier = _prefix_rows(classes, similarity).join(asked, "key", "left_semi")
        more = (
            asking.alias("y").join(earlier.alias("x"), "key")
            .where(_before("x", "y") & _passes("x", "y", similarity))
            .select(*_pair("x", "y")).distinct()
            .join(checked, ["x_doc", "x_spot", "y_doc", "y_spot"], "left_anti")
        )
        more = _verified(stored(more, "pairs"), docs, levels, similarity)
        later = later.union(more.where("alike").select("y_doc", "y_spot")).distinct()

    short = (
        lines.where(~joins).groupBy("name", "n")
        .agg(F.min(F.struct("doc_id", "spot")).alias("place"), F.count("*").alias("size"))
        .select("place.*", "name", "n", "size")
    )
    first = short.unionByName(classes.select("doc_id", "spot", "name", "n", "size"))
    first = first.withColumnsRenamed({"doc_id": "y_doc", "spot": "y_spot"})
    marked = first.join(
        later.withColumn("later", F.lit(True)), ["y_doc", "y_spot"], "left"
    ).where("size > 1 OR later").drop("size")
    place = (F.col("doc_id") == F.col("y_doc")) & (F.col("spot") == F.col("y_spot"))
    return (
        lines.select("doc_id", "twin", "line_no", "spot", "name", "n")
        .join(marked, ["name", "n"])
        .where(~place | F.col("later"))
        .groupBy("doc_id", "twin")
        .agg(F.collect_set("line_no").alias("gone"))
    )


def remove_lines(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: int = SIMILARITY,
) -> DataFrame:
    """The columns of `df` packed as one, with `kept_text`, `n_lines` and `n_removed`.

    Lines end at line feeds. Lines without words always stay. A null text stays null
    and has no lines; an empty text is one empty line; a text whose lines all go
    becomes empty. Earlier means a smaller id, then a smaller line number. Rows with
    equal ids are one document: of repeated rows none is later than the other. Texts
    under a null id are neither earlier nor later and stay whole.
    """
    rows = df.select(
        packed(df), column(df, id_column).alias("doc_id"),
        column(df, text_column).cast("string").alias("text"),
    )
    docs = rows.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    gone = removed_lines(docs, similarity).select(
        F.col("doc_id").alias("gone_id"), F.col("twin").alias("gone_twin"), "gone"
    )
    all_lines = F.split("text", "\n")
    left = F.array_sort(
        F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone"))
    )
    kept = F.array_join(F.transform(left, lambda k: F.element_at(F.col("lines"), k + 1)), "\n")
    return (
        rows.join(
            gone,
            (F.col("doc_id") == F.col("gone_id"))
            & (F.xxhash64("text") == F.col("gone_twin")),
            "left",
        )
        .withColumn("lines", all_lines)
        .withColumns(
            {
                "kept_text": F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept),
                "n_lines": F.when(F.col("text").isNull(), 0)
                .otherwise(F.size("lines")).cast("long"),
                "n_removed": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
            }
        )
        .drop("lines", "gone", "gone_id", "gone_twin", "text")
    )


def keep_lines(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: int = SIMILARITY,
    **new: Column,
) -> DataFrame:
    """The columns of `df` with the text replaced by what is kept of it."""
    found = remove_lines(df, id_column, text_column, similarity)
    return unpacked(found, df, **{text_column: F.col("kept_text"), **new})
