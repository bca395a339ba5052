"""Near-duplicate documents by b-bit MinHash.

A document's set are its distinct word shingles. Documents with equal sets form a
class, and each class goes through these steps:

1. 160 minima of hash functions over the set. Their two lowest bits are packed into a
   signature of five long integers; four whole minima make one of 40 band keys. A pair
   of similarity 0.75 shares no key with probability 3e-7.
2. Classes that share a key are candidates. First, each class is compared with its
   bucket's smallest one, so a group of copies costs one comparison per class.
3. The share of equal bit pairs, found by counting bits, less what chance gives, is an
   estimate of the similarity. Candidates five standard deviations below the
   threshold are left out, as are those whose sizes are too far apart; both are
   conditions of the join that finds candidates, which so gives likely pairs only.
4. The others are compared on their full sets. Links join classes into components.
5. Buckets whose members are not all in one component are finished. In those of up to
   32 classes the pairs of different components are candidates; larger ones are
   compared with a second class, of another component than the first. What large
   buckets are still open then take an exact join on the rarest shingles of each set,
   as many as a similar set must share one of, with length, position and parity
   filters, between different components.

Sets are compared as sets of 64-bit shingle hashes.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from boxtrail.llm import words
from boxtrail.llm.common import column, packed, stored, texts, unpacked

SHINGLE = 5
#: Per cent.
SIMILARITY = 75
ROWS, BANDS, BITS = 4, 40, 2
MINIMA = ROWS * BANDS
#: Classes in a bucket of which all pairs are compared at once.
SMALL = 32
#: Hash buckets by which the rarity of shingles is counted, as a power of two.
RARITY_BITS = 16
#: Hash buckets of which a set tells whether it has an odd number of shingles in them.
PARITY_BITS = 1024

_U = np.uint64
_PER_LONG = 64 // BITS


@cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    values = words.mix(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * _U(0xA24BAED4963EE407))
    values = (values >> _U(32)).astype(np.uint32)
    return values[:MINIMA] | np.uint32(1), values[MINIMA:]


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z as a-z.

    A text with fewer words than a shingle has one: all of them. A text without
    words has none.
    """
    found = words.of_column(column)
    hashes = found.hashes(lower=True)
    values, at = words.windows(hashes, found.first, SHINGLE)
    cuts = np.searchsorted(at, found.first)
    out = []
    for low, high, a, b in zip(
        found.first[:-1].tolist(), found.first[1:].tolist(),
        cuts[:-1].tolist(), cuts[1:].tolist(), strict=True,
    ):
        if high - low >= SHINGLE:
            out.append(np.unique(values[a:b]))
        elif high > low:
            out.append(np.array([words.sequence(hashes[low:high])], dtype=np.uint64))
        else:
            out.append(values[:0])
    return out


def minima(values: np.ndarray) -> np.ndarray:
    factor, shift = _functions()
    low = np.full(MINIMA, 0xFFFFFFFF, dtype=np.uint32)
    half = (values >> _U(32)).astype(np.uint32)
    for k in range(0, len(half), 2048):
        np.minimum(low, (half[k : k + 2048, None] * factor + shift).min(axis=0), out=low)
    return low


def identity(values: np.ndarray) -> int:
    """A 64-bit name of a set."""
    total = words.mix(values).sum(dtype=np.uint64) + _U(len(values))
    return int(words.mix(np.array([total]))[0].astype(np.int64))


def _signed(column: pa.Array) -> dict:
    """Size, name, signature and band keys of each text; null where there is no set."""
    sets = shingle_sets(column)
    some = [k for k, s in enumerate(sets) if len(s)]
    low = np.array([minima(sets[k]) for k in some], dtype=np.uint64).reshape(-1, MINIMA)
    bits = low & _U((1 << BITS) - 1)
    place = _U(BITS) * np.arange(_PER_LONG, dtype=np.uint64)
    signature = (bits.reshape(len(some), MINIMA // _PER_LONG, _PER_LONG) << place).sum(axis=2, dtype=np.uint64)
    keys = np.zeros((len(some), BANDS), dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = words.mix(keys + low.reshape(len(some), BANDS, ROWS)[:, :, k])

    def lists(values):
        out = [None] * len(sets)
        for k, row in zip(some, values.view(np.int64), strict=True):
            out[k] = row
        return pa.array(out, pa.list_(pa.int64()))

    names = [None] * len(sets)
    for k in some:
        names[k] = identity(sets[k])
    return {
        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
        "name": pa.array(names, pa.int64()),
        "signature": lists(signature),
        "bands": lists(keys),
    }


def signatures(df: DataFrame) -> DataFrame:
    """Signatures of rows with `doc_id` and `text`."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, "text"):
                made = _signed(part["text"])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *made.values()], ["doc_id", *made]
                )

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(
        run,
        f"doc_id {kind}, n_shingles long, name long, signature array<long>, bands array<long>",
    )


def full_sets(df: DataFrame) -> DataFrame:
    """`name` and `shingles` of rows with `text`."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, "text"):
                sets = [s for s in shingle_sets(part["text"]) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([identity(s) for s in sets], pa.int64()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["name", "shingles"],
                )

    return df.select("text").mapInArrow(run, "name long, shingles array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two signatures, corrected for equal bits by chance."""
    lanes = int("01" * _PER_LONG, 2)
    apart = F.lit(0)
    for k in range(MINIMA // _PER_LONG):
        x = a.getItem(k).bitwiseXOR(b.getItem(k))
        apart = apart + F.bit_count(
            x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(lanes).cast("long"))
        )
    chance = 0.5**BITS
    return ((1 - apart / F.lit(float(MINIMA))) - chance) / (1 - chance)


def _lowest_estimate(similarity: int) -> float:
    chance = 0.5**BITS
    equal = similarity / 100 * (1 - chance) + chance
    deviation = (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - chance)
    return similarity / 100 - 5 * deviation


def _alike(a: Column, b: Column, similarity: int) -> Column:
    """Whether two sets, given as arrays, reach the similarity."""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= similarity * (F.size(a) + F.size(b) - both)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    left = sets.select(F.col("name").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("name").alias("b"), F.col("shingles").alias("right"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(_alike(F.col("left"), F.col("right"), similarity))
        .select("a", "b")
    )


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """`node` and `label` of every node of some links `a`, `b`: the component's least node.

    Every node hooks on to its least neighbour, chains of hooks are followed to
    their end by doubling, and the links between what remains go on to the next
    round. Each round is a table in the shared folder.
    """
    edges = stored(edges.select("a", "b").distinct(), name)
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(
            both.groupBy(F.col("a").alias("node")).agg(
                F.least(F.min("b"), F.first("a")).alias("label")
            ),
            name,
        )
        while True:
            above = parent.select(F.col("node").alias("label"), F.col("label").alias("upper"))
            jumped = stored(parent.join(above, "label").select("node", "label", "upper"), name)
            parent = jumped.select("node", F.col("upper").alias("label"))
            if jumped.where("upper <> label").isEmpty():
                break
        if found is None:
            found = parent
        else:
            step = parent.select(F.col("node").alias("label"), F.col("label").alias("upper"))
            found = found.join(step, "label", "left").select(
                "node", F.coalesce("upper", "label").alias("label")
            )
        a = parent.select(F.col("node").alias("a"), F.col("label").alias("x"))
        b = parent.select(F.col("node").alias("b"), F.col("label").alias("y"))
        edges = stored(
            edges.join(a, "a").join(b, "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            name,
        )
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stored(found, name)


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Add `label` to rows with `node`; a node without links is its own."""
    return nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) >> _U(64 - RARITY_BITS)).astype(np.int64)


def _counted(batches):
    """How many of a task's sets have a shingle of each hash bucket."""
    counts = np.zeros(1 << RARITY_BITS, dtype=np.int64)
    for batch in batches:
        shingles = batch["shingles"].flatten().to_numpy()
        counts += np.bincount(_bucket(shingles), minlength=len(counts))
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array(counts[some])], ["bucket", "members"]
    )


def _parity(shingles: np.ndarray) -> np.ndarray:
    """Which hash buckets have an odd number of a set's shingles, as long integers.

    Two sets differ in one shingle at least for each bucket where these differ.
    """
    place = (shingles.view(np.uint64) & _U(PARITY_BITS - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(counts: np.ndarray, similarity: int):
    """The rarest shingles of each set, as many as a similar set must share one of."""

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            odd = []
            for row, shingles in enumerate(batch["shingles"]):
                values = shingles.values.to_numpy()
                odd.append(_parity(values))
                often = counts[_bucket(values)]
                first = len(values) - (similarity * len(values) + 99) // 100 + 1
                order = np.lexsort((values, often))[:first]
                # A bucket of one has no other set.
                place = np.flatnonzero(often[order] > 1)
                for column, value in zip(
                    out,
                    (np.full(len(place), row), np.full(len(place), len(values)), place,
                     values[order[place]]),
                    strict=True,
                ):
                    column.append(value)
            if not batch.num_rows:
                continue
            row, n, place, shingle = (np.concatenate(c).astype(np.int64) for c in out)
            longs = PARITY_BITS // 64
            odd = pa.ListArray.from_arrays(
                np.arange(len(odd) + 1, dtype=np.int32) * np.int32(longs), np.concatenate(odd)
            )
            for k in range(0, len(row), 1 << 15):
                some = slice(k, k + (1 << 15))
                rows = pa.array(row[some])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["node"].take(rows), batch["label"].take(rows), pa.array(n[some]),
                        pa.array(place[some]), pa.array(shingle[some]), odd.take(rows),
                    ],
                    ["node", "label", "n", "pos", "shingle", "parity"],
                )

    return run


def _across(members: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Exact candidates between members of different components.

    `members` has `node` and `label`. A set is sorted by how often the shingles of
    their hash buckets occur among the members, then by hash; similar sets share one
    among the first n - ceil(t n) + 1 of n.
    """
    own = stored(
        members.join(sets.select(F.col("name").alias("node"), "shingles"), "node"), "prefix_sets"
    )
    counts = np.zeros(1 << RARITY_BITS, dtype=np.int64)
    counted = own.select("shingles").mapInArrow(_counted, "bucket long, members long")
    for bucket, count in counted.groupBy("bucket").agg(F.sum("members")).collect():
        counts[bucket] = count  # one row per bucket, whatever the input
    prefix = own.select("node", "label", "shingles").mapInArrow(
        _prefixes(counts, similarity),
        "node long, label long, n long, pos long, shingle long, parity array<long>",
    )
    prefix = stored(prefix, "prefix")
    x, y = prefix.alias("x"), prefix.alias("y")
    total = F.col("x.n") + F.col("y.n")
    least = F.ceil(total * similarity / (100 + similarity))
    apart = F.lit(0)
    for k in range(PARITY_BITS // 64):
        apart = apart + F.bit_count(
            F.col("x.parity").getItem(k).bitwiseXOR(F.col("y.parity").getItem(k))
        )
    return (
        x.join(
            y,
            (F.col("x.shingle") == F.col("y.shingle"))
            & (F.col("x.node") < F.col("y.node"))
            & (F.col("x.label") != F.col("y.label"))
            & (100 * F.least("x.n", "y.n") >= similarity * F.greatest("x.n", "y.n"))
            & (
                # Positions count from 0: this one and what follows it.
                F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= least
            )
            & (apart <= total - 2 * least),
        )
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct()
    )


def _open(buckets: DataFrame) -> DataFrame:
    """The rows of the buckets whose members are not all in one component."""
    live = (
        buckets.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high").select("key")
    )
    return buckets.join(live, "key", "left_semi")


def _merged(links: DataFrame, rows: DataFrame) -> DataFrame:
    """`label` and `upper`: what links between `node`s of rows make of their labels."""
    ends = rows.select("node", "label").distinct()
    joined = (
        links.join(ends.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
        .join(ends.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    return components(joined).select(
        F.col("node").alias("label"), F.col("label").alias("upper")
    )


def _lifted(rows: DataFrame, upper: DataFrame) -> DataFrame:
    found = rows.join(upper, "label", "left")
    return found.withColumn("label", F.coalesce("upper", "label")).drop("upper")


def groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: int = SIMILARITY,
) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` and `kept` of every row.

    `component_id` is the smallest id that links lead to, the row's own included;
    `kept` says whether it is the row's own. Texts that are null, empty or without
    words have no shingles, no links and their own id. Repeated rows get equal
    results. A row with a null id counts for its text's links, but its id is never
    the smallest: it is not kept if its group has an id, and else its component is
    null. Other columns are left out.
    """
    source = texts(df, id_column, text_column)
    signed = stored(signatures(source), "signatures")
    some = signed.where("n_shingles > 0")
    classes = stored(
        some.groupBy("name").agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    rows = classes.select(F.col("name").alias("node"), F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("least"))
    own = classes.select(F.col("name").alias("node"), "n", "signature")
    shared = stored(rows.join(sizes.where("size > 1"), "key").join(own, "node"), "buckets")

    def alike(a: DataFrame, b: DataFrame, only: Column) -> DataFrame:
        """Likely pairs of two sides that share a key."""
        x, y = a.alias("x"), b.alias("y")
        sizes_fit = 100 * F.least("x.n", "y.n") >= similarity * F.greatest("x.n", "y.n")
        likely = estimate(F.col("x.signature"), F.col("y.signature")) >= _lowest_estimate(similarity)
        on = (F.col("x.key") == F.col("y.key")) & only & sizes_fit & likely
        return x.join(y, on).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))

    star = alike(
        shared.where("node = least"), shared.where("node <> least"), F.lit(True)
    ).distinct()
    likely = stored(star, "candidates")
    # Full sets of all that may be compared: one text for each class. A class may have
    # no id at all; rows without one are told apart by the name of their set.
    wanted = shared.select(F.col("node").alias("name")).distinct()
    ids = signed.select("name", "doc_id").join(
        wanted.join(classes.select("name", "doc_id"), "name"), ["name", "doc_id"], "left_semi"
    )
    chosen = source.join(ids.select("doc_id").distinct(), "doc_id", "left_semi").unionByName(
        source.where("doc_id IS NULL")
    )
    sets = stored(
        full_sets(chosen).join(wanted, "name", "left_semi").dropDuplicates(["name"]), "sets"
    )
    labels = components(_verified(likely, sets, similarity))

    apart = F.col("x.label") != F.col("y.label")
    first = stored(_open(_labelled(shared.drop("least"), labels)), "open_buckets")
    small = first.where(F.col("size") <= SMALL)
    # in a large bucket a second star, from a class of its last component
    large = first.where(F.col("size") > SMALL)
    last = large.groupBy("key").agg(F.max(F.struct("label", "node")).getField("node").alias("node"))
    later = alike(small, small, (F.col("x.node") < F.col("y.node")) & apart).union(
        alike(large.join(last, ["key", "node"], "left_semi"), large, apart)
    )
    second = _merged(_verified(stored(later.distinct(), "later"), sets, similarity), first)
    large = _open(_lifted(large, second))
    members = stored(large.select("node", "label").distinct(), "members")
    third = _merged(_verified(_across(members, sets, similarity), sets, similarity), members)
    final = _labelled(classes.select(F.col("name").alias("node"), "doc_id"), labels)
    final = _lifted(_lifted(final, second), third)
    least = final.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = final.select("label", F.col("node").alias("name")).join(least, "label")
    return (
        signed.select("doc_id", "n_shingles", "name")
        .join(named.select("name", "component_id"), "name", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component_id"))
            .otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
        )
    )


def keep_one(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: int = SIMILARITY,
) -> DataFrame:
    """The rows of `df` that `groups` keeps, with all their columns.

    Rows that share an id stay or go together. Rows with a null id stay.
    """
    found = groups(df, id_column, text_column, similarity)
    gone = found.where("NOT kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("__gone")
    ).distinct()
    with_id = df.select(packed(df), column(df, id_column).alias("__id"))
    return unpacked(with_id.join(gone, F.col("__id") == F.col("__gone"), "left_anti"), df)
