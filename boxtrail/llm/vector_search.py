"""Exact search for the highest inner products by distances to pivots.

Vectors get one more component that makes all their lengths equal, so that the
highest inner products become the smallest distances. Each vector is keyed by its
nearest pivot and its distance from it; runs of vectors in that order are segments,
thin rings (annuli) around a pivot. By the triangle inequality a vector within r of
a query lies in rings within r of the query's own distance from that pivot.

A query first looks at the ring of its own pivot that lies nearest to it. The k-th
best score found there bounds the distance of all better vectors, and the query
goes on to the rings that this bound reaches, in each of them only to the vectors
within the bound. Scores are whole numbers; bounds have some slack for rounding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from boxtrail.llm.common import column, stored

#: Vectors from which pivots are fitted, pivots, vectors of a segment, queries of a block.
SAMPLE, PIVOTS, SEGMENT, QUERIES = 4096, 64, 1024, 256
#: Share of the vectors' common length by which bounds are widened.
SLACK = 1e-5


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def complete(vector: Column) -> Column:
    """Whether a vector is there and has only finite components."""
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _matrix(vectors: pa.Array) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(vectors), -1) if len(vectors) else values.reshape(0, 0)


def _levelled(vectors: np.ndarray, square: float) -> np.ndarray:
    """Vectors with the component that brings their squared length to `square`."""
    own = vectors.astype(float)
    rest = np.sqrt(np.maximum(0.0, square - (own**2).sum(axis=1)))
    return np.column_stack([own, rest])


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (
        (points**2).sum(axis=1)[:, None] - 2 * points @ pivots.T + (pivots**2).sum(axis=1)
    )
    return np.sqrt(np.maximum(0.0, square))


def fit_pivots(sample: np.ndarray, count: int, seed: int = 7) -> np.ndarray:
    """Centres of a few rounds of k-means."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centres = distinct[rng.choice(len(distinct), min(count, len(distinct)), replace=False)]
    for _ in range(5):
        nearest = _distances(sample, centres).argmin(axis=1)
        for k in range(len(centres)):
            if (nearest == k).any():
                centres[k] = sample[nearest == k].mean(axis=0)
    return centres


def _segments(batches):
    """Runs of rows with one pivot, each packed into a row."""
    part, number, held = TaskContext.get().partitionId(), 0, None

    def packed(rows: pa.Table, number: int) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        distance = rows["distance"].to_numpy()
        vectors = _matrix(rows["vector"])
        return pa.RecordBatch.from_pylist(
            [
                {
                    "segment": (part << 32) + number,
                    "pivot": rows["pivot"][0].as_py(),
                    "low": float(distance[0]),
                    "high": float(distance[-1]),
                    "ids": rows["vec_id"].to_numpy().astype("<i8").tobytes(),
                    "distances": distance.astype("<f8").tobytes(),
                    "vectors": vectors.astype("<i8").tobytes(),
                }
            ],
            pa.schema(
                [
                    ("segment", pa.int64()), ("pivot", pa.int32()), ("low", pa.float64()),
                    ("high", pa.float64()), ("ids", pa.binary()), ("distances", pa.binary()),
                    ("vectors", pa.binary()),
                ]
            ),
        )

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        while held.num_rows:
            pivot = held["pivot"].to_numpy()
            same = int(np.argmax(np.append(pivot[1:] != pivot[:-1], True))) + 1
            if same == held.num_rows and same < SEGMENT:
                break
            same = min(same, SEGMENT)
            yield packed(held.slice(0, same), number)
            number, held = number + 1, held.slice(same)
    if held is not None and held.num_rows:
        yield packed(held, number)


_SEGMENT_SCHEMA = (
    "segment long, pivot int, low double, high double, ids binary, distances binary, vectors binary"
)


def _scan(k: int, slack: float):
    """Best scores of a block of queries in one segment."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                distance = np.frombuffer(row["distances"], "<f8")
                vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(ids), -1)
                asked = row["asked"]
                queries = np.array([q["vector"] for q in asked], dtype=np.int64)
                largest = np.abs(vectors).max(initial=0).astype(float)
                largest *= np.abs(queries).max(initial=0) * vectors.shape[1]
                if largest < 2**53:
                    scores = (queries.astype(float) @ vectors.T.astype(float)).astype(np.int64)
                else:
                    scores = queries @ vectors.T
                out = []
                for q, score in zip(asked, scores, strict=True):
                    own, reach = q["distance"], q["reach"]
                    low, high = 0, len(ids)
                    if reach is not None:
                        low = int(np.searchsorted(distance, own - reach - slack, side="left"))
                        high = int(np.searchsorted(distance, own + reach + slack, side="right"))
                    at = np.arange(low, high)[ids[low:high] != q["query_id"]]
                    if len(at) > k:
                        least = np.partition(score[at], len(at) - k)[len(at) - k]
                        at = at[score[at] >= least]
                    best = at[np.lexsort((ids[at], -score[at]))[:k]]
                    out += [(q["query_id"], int(ids[j]), int(score[j])) for j in best]
                columns = list(zip(*out, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
                )

    return run


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "vector",
    pivots: int = PIVOTS,
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id` and `score` of each query's k best vectors.

    Vectors are arrays of whole numbers of one length. `is_query` picks the queries
    by the columns of `df`; the candidates are all rows whose id is not the query's.
    Ties go to the smaller id; a query with fewer candidates gets them all. Rows
    with a null id or vector take no part, other columns are left out. Repeated rows
    are candidates as often as they occur. An empty table gives no rows; vectors of
    different lengths are an error.
    """
    spark = df.sparkSession
    names = {"vec_id": column(df, id_column), "vector": column(df, vector_column)}
    rows = df.select(
        names["vec_id"].cast("long").alias("vec_id"),
        names["vector"].alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    square = rows.agg(F.max(length)).first()[0]
    # A bounded sample for the pivots.
    sample = (
        rows.select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    )
    result = "query_id long, rank int, vec_id long, score long"
    if square is None:
        return spark.createDataFrame([], result)
    centres = fit_pivots(_levelled(_matrix(sample["vector"]), square), pivots)
    slack = SLACK * max(1.0, square**0.5)

    def place(batches):
        for batch in batches:
            vectors = _matrix(batch["vector"])
            points = _levelled(vectors, square)
            away = _distances(points, centres)
            nearest = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"], batch["vector"], batch["asks"],
                    pa.array(nearest, pa.int32()),
                    pa.array(away[np.arange(len(away)), nearest]),
                ],
                ["vec_id", "vector", "asks", "pivot", "distance"],
            )

    def ask(batches):
        """Queries with their distances from all pivots, in the levelled space."""
        for batch in batches:
            vectors = _matrix(batch["vector"]).astype(float)
            points = np.column_stack([vectors, np.zeros(len(vectors))])
            away = _distances(points, centres)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"], batch["vector"],
                    pa.array(list(away), pa.list_(pa.float64())),
                    pa.array(away.argmin(axis=1), pa.int32()),
                    pa.array((vectors**2).sum(axis=1)),
                ],
                ["query_id", "vector", "away", "pivot", "square"],
            )

    placed = rows.mapInArrow(
        place, "vec_id long, vector array<long>, asks boolean, pivot int, distance double"
    )
    dealt = placed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions(
        "pivot", "distance", "vec_id"
    )
    segments = stored(
        dealt.select("vec_id", "vector", "pivot", "distance").mapInArrow(
            _segments, _SEGMENT_SCHEMA
        ),
        "segments",
    )
    rings = segments.select("segment", F.col("pivot").alias("ring_pivot"), "low", "high")
    asked = stored(
        rows.where("asks").select("vec_id", "vector").dropDuplicates(["vec_id", "vector"])
        .mapInArrow(
            ask,
            "query_id long, vector array<long>, away array<double>, pivot int, square double",
        ),
        "queries",
    )
    blocks = max(1, -(-asked.count() // QUERIES))

    def look(visits: DataFrame) -> DataFrame:
        """Scores of visits (`segment`, `query_id`, `vector`, `distance`, `reach`)."""
        grouped = visits.groupBy(
            "segment", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block")
        ).agg(
            F.collect_list(F.struct("query_id", "vector", "distance", "reach")).alias("asked")
        )
        return grouped.join(segments, "segment").select(
            "ids", "distances", "vectors", "asked"
        ).mapInArrow(_scan(k, slack), "query_id long, vec_id long, score long")

    gap = F.greatest(
        F.lit(0.0), F.col("low") - F.col("distance"), F.col("distance") - F.col("high")
    )
    own = asked.withColumn("distance", F.element_at("away", F.col("pivot") + 1))
    nearest = (
        own.join(rings, F.col("pivot") == F.col("ring_pivot"))
        .groupBy("query_id", "vector")
        .agg(F.min(F.struct(gap.alias("gap"), "segment", "distance")).alias("first"))
        .select(
            "query_id", "vector", "first.segment", "first.distance",
            F.lit(None).cast("double").alias("reach"),
        )
    )
    nearest = stored(nearest, "nearest")
    first = stored(look(nearest), "first_scores")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bound = (
        first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
        .select(F.col("query_id").alias("bound_id"), F.col("score").alias("bound"))
    )
    square_reach = F.col("square") + F.lit(float(square)) - 2 * F.col("bound")
    reach = F.when(F.col("bound").isNotNull(), F.sqrt(F.greatest(F.lit(0.0), square_reach)))
    bounded = asked.join(bound, F.col("query_id") == F.col("bound_id"), "left").withColumn(
        "reach", reach
    )
    away = F.element_at("away", F.col("ring_pivot") + 1)
    within = (F.col("low") - away <= F.col("reach") + slack) & (
        away - F.col("high") <= F.col("reach") + slack
    )
    seen = nearest.select(F.col("query_id").alias("seen_id"), F.col("segment").alias("seen"))
    # The stated queries against rings, not against rows.
    further = (
        bounded.join(rings, F.col("reach").isNull() | within)
        .withColumn("distance", away)
        .join(
            seen,
            (F.col("query_id") == F.col("seen_id")) & (F.col("segment") == F.col("seen")),
            "left_anti",
        )
        .select("segment", "query_id", "vector", "distance", "reach")
    )
    return (
        first.union(look(further))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
