"""Aligning rows to a target table and merging them into it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from boxtrail.functions.rewrite import now_or
from boxtrail.operators.lookups import one_per_key
from boxtrail.schemas import PROC_BOX, PROC_BOX_RENAMES


def dedup_by_id(df: DataFrame) -> DataFrame:
    """One row per id: the latest, with ties broken the same way every time."""
    return one_per_key(df, ["id"], newest="updated_at")


def duplicate_ids(df: DataFrame) -> DataFrame:
    return df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_summary(df: DataFrame) -> DataFrame:
    """How many ids occur more than once, and over how many rows."""
    return duplicate_ids(df).agg(
        F.count(F.lit(1)).alias("n_ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_linhas")
    )


def schema_align(
    df: DataFrame,
    target: T.StructType = PROC_BOX,
    renames: Mapping[str, str] = PROC_BOX_RENAMES,
    now: Column | None = None,
    fill: bool = False,
) -> DataFrame:
    """Rename, keep the columns the target has, in its order and types.

    ``created_at`` and ``updated_at`` are added where absent. Other columns
    the source lacks are left out, so that a merge keeps their stored values;
    ``fill`` adds them as typed NULLs instead.
    """
    df = df.withColumnsRenamed({a: b for a, b in renames.items() if a in df.columns})
    stamp = now_or(now)
    out = []
    for field in target:
        if field.name in df.columns:
            out.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.name in ("created_at", "updated_at"):
            out.append(stamp.cast(field.dataType).alias(field.name))
        elif fill:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*out)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = ("id",),
    insert_only: Sequence[str] = (),
) -> DataFrame:
    """The target with the source merged in: new keys added, known keys updated.

    Columns the source lacks keep the stored value, as do ``insert_only``
    columns of known keys. Both sides hold one row per key. One join does it
    all; keys are unique, so no partition of it can run hot.
    """
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns],
                      F.lit(True).alias("_s"))
    t = target.withColumn("_t", F.lit(True))
    match = [t[k] == s[f"_s_{k}"] for k in keys]
    both = t.join(s, match, "full")
    out = []
    for field in target.schema:
        name, old = field.name, F.col(field.name)
        if name not in source.columns:
            out.append(old)
            continue
        new = F.col(f"_s_{name}").cast(field.dataType)
        keep = F.col("_t").isNotNull() if name in insert_only else F.col("_s").isNull()
        out.append(F.when(keep, old).otherwise(new).alias(name))
    return both.select(*out)


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks, one per key."""
    known = target.select(*keys)
    return one_per_key(source, keys).join(known, list(keys), "left_anti")


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target plus the rows it has no key for; known keys stay as they are."""
    fresh = new_rows(target, source, keys)
    return target.unionByName(fresh, allowMissingColumns=True)


def union_groups(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for df in rest:
        first = first.unionByName(df)
    return first


def numbered_rows(
    df: DataFrame, order: Sequence[str],
    materialise: Callable[[DataFrame], DataFrame], number: str = "_nr",
) -> DataFrame:
    """Rows numbered from 1 in a total order: the given columns, then all others.

    Rows are dealt in ranges, each sorted by its task, and stored by ``materialise``.
    The sizes of the ranges, one row each, give the number a range starts with.
    """
    every = [*order, *[c for c in df.columns if c not in order]]
    place = F.monotonically_increasing_id()  # the range, then the row in it
    dealt = df.repartitionByRange(*every).sortWithinPartitions(*every)
    stored = materialise(
        dealt.withColumns({"_range": F.shiftright(place, 33), "_at": place.bitwiseAND((1 << 33) - 1)})
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    numbered = stored.join(F.broadcast(first), "_range")
    return numbered.select(*df.columns, (F.col("_first") + F.col("_at") + 1).alias(number))


def slice_except(
    df: DataFrame, start: int, end: int, order: Sequence[str],
    materialise: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Rows after ``start`` up to ``end`` in the given order, as a set difference.

    Duplicate rows collapse, and rows equal to an earlier one drop out. Equal rows stand
    next to each other in a total order, so only the slice and the row before it are
    compared; a slice deep in a table costs no more than one at its head.
    """
    near = numbered_rows(df, order, materialise).filter(F.col("_nr").between(start, end))
    first = near.groupBy(*df.columns).agg(F.min("_nr").alias("_nr"))
    return first.filter(F.col("_nr") > F.lit(start)).drop("_nr")


def hash_chunk(df: DataFrame, n: int, i: int, by: str = "id") -> DataFrame:
    """Chunk ``i`` of ``n``: the chunks cover the table and do not overlap."""
    return df.filter(F.pmod(F.xxhash64(by), F.lit(n)) == F.lit(i))
