"""Linking boxes to their deboning order, schedule and animals.

A flag says whether a match was found. It comes from a marker on the lookup
row, because JSON text built from an unmatched row would not be NULL.

``where`` restricts a link to some rows: the others go through with their
values unchanged, joined on a NULL key, which the join spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxtrail.functions.payload import row_json
from boxtrail.functions.rewrite import now_or, set_where
from boxtrail.operators.lookups import keyed, left_lookup, one_per_key

# The most selective key comes first: sorts compare a prefix of it before
# anything else. An order number tells more rows apart than a unit or tenant.
DEBONING_KEYS = ("nr_op_desossa", "nr_unidade_desossa")
ORIGIN_KEYS = ("dt_abate", "nr_unidade_abate")


def _tenant_keys(lookup: DataFrame, keys, tenant_scoped: bool | None) -> tuple[str, ...]:
    """The join keys. The tenant is one of them unless the lookup has no
    tenant column or the caller says otherwise."""
    if tenant_scoped is None:
        tenant_scoped = "token_cliente" in lookup.columns
    return (*keys, "token_cliente") if tenant_scoped else tuple(keys)


def _only(where: Column | None, key: Column) -> Column:
    return key if where is None else F.when(where, key)


def _lineage(lookup: DataFrame, keys, json_name: str) -> DataFrame:
    """The lookup cut to one row per key, with the whole row as JSON text."""
    reduced = one_per_key(keyed(lookup, keys), keys)
    return reduced.withColumn(json_name, row_json(lookup.columns))


def link_deboning(
    boxes: DataFrame,
    deboning: DataFrame,
    *,
    where: Column | None = None,
    tenant_scoped: bool | None = None,
    salt: int = 1,
    now: Column | None = None,
) -> DataFrame:
    """Attach the deboning order and carry its slaughter day and unit."""
    keys = _tenant_keys(deboning, DEBONING_KEYS, tenant_scoped)
    lookup = _lineage(deboning, keys, "_json").select(
        *keys,
        "_json",
        F.col("dt_abate").alias("_dt_abate"),
        F.col("nr_unidade_abate").alias("_nr_unidade_abate"),
    )
    on = {k: _only(where, F.col(k)) for k in keys}
    payload = ["_json", "_dt_abate", "_nr_unidade_abate"]
    # the JSON of a lookup row holds its non-NULL keys, so it is never NULL
    return set_where(
        left_lookup(boxes, lookup, on, payload, salt=salt),
        where,
        {
            "json_desossa": F.col("_json"),
            "flag_desossa": F.col("_json").isNotNull(),
            "dt_abate": F.coalesce("_dt_abate", "dt_abate"),
            "nr_unidade_abate": F.coalesce("_nr_unidade_abate", "nr_unidade_abate"),
            "updated_at": now_or(now),
        },
    ).drop(*payload)


def link_deboning_grouped(boxes: DataFrame, deboning: DataFrame, *, now=None) -> DataFrame:
    """The tenant-scoped link, with the lookup first cut to the orders in use."""
    keys = (*DEBONING_KEYS, "token_cliente")
    groups = keyed(boxes.select(*keys), keys).distinct()
    in_use = left_lookup(deboning, groups, {k: F.col(k) for k in keys}, how="left_semi")
    return link_deboning(boxes, in_use, tenant_scoped=True, now=now)


def _link_one(
    boxes, lookup, json_name, flag_name, where, tenant_scoped, salt, now
) -> DataFrame:
    keys = _tenant_keys(lookup, ORIGIN_KEYS, tenant_scoped)
    reduced = _lineage(lookup, keys, "_json").select(*keys, "_json")
    on = {k: _only(where, F.col(k)) for k in keys}
    return set_where(
        left_lookup(boxes, reduced, on, ["_json"], salt=salt),
        where,
        {
            json_name: F.col("_json"),
            flag_name: F.col("_json").isNotNull(),
            "updated_at": now_or(now),
        },
    ).drop("_json")


def link_schedule(
    boxes, schedule, *, where=None, tenant_scoped=None, salt=1, now=None
) -> DataFrame:
    """Attach the slaughter schedule, which says what property it was."""
    return _link_one(
        boxes, schedule, "json_propriedades", "flag_propriedades", where, tenant_scoped, salt, now
    )


def link_animals(
    boxes, animals, *, where=None, tenant_scoped=None, salt=1, now=None
) -> DataFrame:
    return _link_one(
        boxes, animals, "json_animais", "flag_animais", where, tenant_scoped, salt, now
    )


def link_origin(
    boxes: DataFrame,
    schedule: DataFrame,
    animals: DataFrame,
    *,
    where: Column | None = None,
    tenant_scoped: bool | None = None,
    salt: int = 1,
    now: Column | None = None,
) -> DataFrame:
    """Schedule and animals, in one join where both have the same keys.

    Joined with each other first, the lookups cost the boxes one shuffle, and
    the runtime skew join can split that shuffle.
    """
    keys = _tenant_keys(schedule, ORIGIN_KEYS, tenant_scoped)
    if keys != _tenant_keys(animals, ORIGIN_KEYS, tenant_scoped):
        # the first link changes flags the selection may look at
        chosen = boxes.withColumn("_chosen", F.lit(True) if where is None else where)
        options = {
            "where": F.col("_chosen"), "tenant_scoped": tenant_scoped, "salt": salt, "now": now
        }
        linked = link_schedule(chosen, schedule, **options)
        return link_animals(linked, animals, **options).drop("_chosen")
    origin = _lineage(schedule, keys, "_json_p").select(*keys, "_json_p").join(
        _lineage(animals, keys, "_json_a").select(*keys, "_json_a"), list(keys), "full"
    )
    on = {k: _only(where, F.col(k)) for k in keys}
    return set_where(
        left_lookup(boxes, origin, on, ["_json_p", "_json_a"], salt=salt),
        where,
        {
            "json_propriedades": F.col("_json_p"),
            "flag_propriedades": F.col("_json_p").isNotNull(),
            "json_animais": F.col("_json_a"),
            "flag_animais": F.col("_json_a").isNotNull(),
            "updated_at": now_or(now),
        },
    ).drop("_json_p", "_json_a")
