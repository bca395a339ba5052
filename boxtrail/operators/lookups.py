"""One row per key, and left joins against such reduced lookups.

Two kinds of hot key are handled here, for every link in the package:

* rows whose key is NULL never match, so they are spread over many hash
  values instead of meeting in one task;
* a key shared by many rows makes an oversized partition, which the runtime
  skew join splits over several tasks, with the few lookup rows repeated for
  each. Where a hot key is known beforehand, ``salt`` deals its rows over that
  many values instead, and repeats the whole lookup as often.

The runtime can split where both sides of a join come straight from a shuffle
and no second join relies on the same layout. So each link is one join on its
own keys, and a reduced lookup is shuffled again to the join even though its
reduction had nearly the same layout: it is the small side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

SPREAD = 4096
_RANK = "_rank"
_SALT = "_salt"
_ROW_IDS = ("id", "registro_id", "caixa_id")


def one_per_key(df: DataFrame, keys: Sequence[str], newest: str | None = None) -> DataFrame:
    """Keep one row of each key: the newest by a time column, if the frame has
    it, then the lowest id, then the lowest by every other column, so that the
    choice repeats.

    The ``= 1`` filter lets Spark cut each key to one row per task before the
    shuffle, so a hot key never travels whole.
    """
    order = [F.col(newest).desc_nulls_last()] if newest in df.columns else []
    rest = [c for c in df.columns if c not in (*keys, newest)]
    rest.sort(key=lambda c: c != "id")
    order += [F.col(c).asc_nulls_last() for c in rest]
    # a frame of nothing but keys still needs some order
    window = Window.partitionBy(*keys).orderBy(*(order or keys))
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that can match: every key column present, as tests a scan can apply."""
    return df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def _seed(rows: DataFrame) -> Column:
    """A hash that differs from row to row, from as few columns as will do:
    every column named here must be read and shuffled."""
    ids = [c for c in _ROW_IDS if c in rows.columns]
    plain = [c for c, kind in rows.dtypes if kind != "variant" and "<" not in kind]
    return F.xxhash64(*(ids or plain))


def left_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, Column],
    payload: Sequence[str] = (),
    *,
    salt: int = 1,
    how: str = "left",
) -> DataFrame:
    """Add the lookup's payload columns to the rows, or with ``how`` left_semi
    or left_anti keep the rows that have a match or none.

    ``on`` maps a lookup column to the row expression it must equal. The
    lookup should hold one row per key; where it does not, rows multiply as
    in any left join. Payload names must be free on the row side.
    """
    row_keys = [f"_rk{i}" for i in range(len(on))]
    look_keys = [f"_lk{i}" for i in range(len(on))]
    right = lookup.select(
        *[F.col(name).alias(key) for name, key in zip(on, look_keys)],
        *payload,
        # generated, for the same reason as the remainder below
        F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias(_SALT),
    )
    left = rows.withColumns(dict(zip(row_keys, on.values())))
    no_key = reduce(or_, [F.col(k).isNull() for k in row_keys])
    seed = _seed(rows)
    # a remainder even for salt 1: a constant would be folded out of the keys
    deal = F.pmod(seed, F.when(no_key, F.lit(SPREAD)).otherwise(F.lit(salt)))
    left = left.withColumn("_deal", deal.cast("int"))
    match = [left[r] == right[k] for r, k in zip(row_keys, look_keys)]
    joined = left.join(right, [*match, left["_deal"] == right[_SALT]], how)
    return joined.select(*[left[c] for c in rows.columns], *[right[c] for c in payload])
