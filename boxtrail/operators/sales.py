"""Sales: their boxes, the lineage behind each box, and the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxtrail.functions.flags import all_true
from boxtrail.functions.payload import json_id, trimmed_id
from boxtrail.functions.rewrite import now_or
from boxtrail.operators.lookups import keyed, left_lookup, one_per_key
from boxtrail.schemas import (
    PROPERTY_COLUMNS,
    PROPERTY_REQUIRED,
    SALE_BOXES,
    SALE_HEADER_COLUMNS,
    SALE_HEADER_DATES,
    SALE_HEADER_TEXT,
    SALE_HEADER_ZERO_ID,
    SALE_HEADER_ZERO_IDS,
    STAGE_FLAGS,
)

ALL_FLAGS = (*STAGE_FLAGS, "flag_rastreavel")
# Property columns stored in a box's property lineage; the tenant is the sale's.
_PROPERTY_JSON = ", ".join(
    f"{c} {'date' if c == 'dt_abate' else 'string'}"
    for c in PROPERTY_COLUMNS
    if c != "token_cliente"
)


def oldest_unprocessed(
    sales: DataFrame,
    grupo_id: int | None = None,
    token: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Open sales, with a limit the oldest ones. A NULL flag is not open.

    A group can only be asked for where the table has that column.
    """
    chosen = F.col("flag_processada") == F.lit(False)
    if grupo_id is not None:
        if "grupo_id" not in sales.columns:
            raise ValueError("the sales have no grupo_id to filter by")
        chosen = chosen & (F.col("grupo_id") == F.lit(grupo_id))
    if token is not None:
        chosen = chosen & (F.col("token_cliente") == F.lit(token))
    picked = sales.filter(chosen)
    if limit is None or limit <= 0:
        return picked
    return picked.orderBy(F.col("created_at").asc_nulls_last(), F.col("id")).limit(limit)


def optional_group(sales: DataFrame) -> DataFrame:
    """Add ``grupo_id`` as a NULL int where the table lacks it."""
    if "grupo_id" in sales.columns:
        return sales
    return sales.withColumn("grupo_id", F.lit(None).cast("int"))


def explode_sale_boxes(sales: DataFrame) -> DataFrame:
    """One row per box of a sale; absent, malformed or empty lists give none."""
    return (
        optional_group(sales)
        .select(
            F.col("id").alias("registro_id"),
            "token_cliente",
            "grupo_id",
            F.explode(F.from_json("json_caixas", SALE_BOXES)).alias("caixa"),
        )
        .select(
            "registro_id",
            "token_cliente",
            "grupo_id",
            trimmed_id(F.col("caixa.id")).alias("caixa_id"),
            F.col("caixa.codigo").alias("codigo"),
            F.col("caixa.peso").alias("peso"),
        )
    )


def semi_by_ids(boxes: DataFrame, sale_boxes: DataFrame) -> DataFrame:
    """Boxes that some sale names."""
    ids = sale_boxes.select("caixa_id").dropna().distinct()
    return left_lookup(boxes, ids, {"caixa_id": trimmed_id(F.col("id"))}, how="left_semi")


def traceable(boxes: DataFrame) -> DataFrame:
    return boxes.filter(all_true(ALL_FLAGS))


def _add_lineage(rows, deboning, properties, animals) -> DataFrame:
    """Look up the ids that the lineage JSON of each row names.

    A lookup may hold an id more than once; one row of each is taken.
    """
    d = deboning.select(
        F.col("id").alias("desossa_id"), F.col("lote").alias("desossa_lote")
    )
    p = properties.select(
        F.col("id").alias("propriedade_id"), F.col("nome").alias("propriedade_nome")
    )
    a = animals.select(
        F.col("id").alias("animal_id"), F.col("codigo").alias("animal_codigo")
    )
    for lookup, source in (
        (d, "json_desossa"), (p, "json_propriedades"), (a, "json_animais")
    ):
        key, label = lookup.columns
        keys = lookup.withColumn("_id", F.col(key).cast("string"))
        keys = one_per_key(keyed(keys, ["_id"]), ["_id"])
        rows = left_lookup(rows, keys, {"_id": json_id(F.col(source))}, [key, label])
    return rows


def lineage_lookup(boxes, deboning, properties, animals) -> DataFrame:
    """Traceable boxes with deboning order, property and animal behind them."""
    kept = traceable(boxes).select(
        "id", "codigo", "peso", "dt_producao", *ALL_FLAGS,
        "json_desossa", "json_propriedades", "json_animais",
    )
    return _add_lineage(kept, deboning, properties, animals).drop(
        "json_desossa", "json_propriedades", "json_animais"
    )


def prefix_shared(df: DataFrame, other: DataFrame, prefix: str = "caixa_", keep=("id", "caixa_id")):
    """Rename the columns both frames have, so that a join keeps them apart."""
    shared = [c for c in df.columns if c in other.columns and c not in keep]
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in shared})


def sale_box_join(
    sale_boxes: DataFrame, boxes: DataFrame, tenant_scoped: bool = False
) -> DataFrame:
    """Sale boxes with the box rows they name; the id is trimmed on both sides.

    With ``tenant_scoped`` a sale only meets boxes of its own tenant; one without a
    tenant meets all.
    """
    right = prefix_shared(boxes, sale_boxes)
    joined = sale_boxes.join(
        right, sale_boxes["caixa_id"] == trimmed_id(right["id"]), "inner"
    ).drop(right["id"])
    if not tenant_scoped:
        return joined
    tenant = F.col("token_cliente")
    return joined.filter(tenant.isNull() | (tenant == F.col("caixa_token_cliente")))


def sale_lineage(
    sale_boxes, boxes, deboning, properties, animals, tenant_scoped: bool = False
) -> DataFrame:
    """Sold traceable boxes with everything behind them.

    The sale join comes first: it already leaves only the boxes that are
    sold, so the three lookups carry no row that a later join would drop.
    """
    kept = traceable(boxes).select(
        "id",
        F.col("codigo").alias("caixa_codigo"),
        F.col("peso").alias("caixa_peso"),
        F.col("dt_producao").alias("caixa_dt_producao"),
        "json_desossa", "json_propriedades", "json_animais",
        *(["token_cliente"] if tenant_scoped else []),
    )
    named = sale_boxes.select("registro_id", "token_cliente", "grupo_id", "caixa_id")
    sold = sale_box_join(named, kept, tenant_scoped).drop("caixa_token_cliente")
    return _add_lineage(sold, deboning, properties, animals)


def proc_projection(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """The columns the result tables draw on; absent ones are skipped.

    Property columns come from the property lineage of the box.
    """
    if "json_propriedades" in rows.columns:
        rows = rows.withColumn("_p", F.from_json("json_propriedades", _PROPERTY_JSON))
        rows = rows.withColumns(
            {
                c: F.col(f"_p.{c}")
                for c in PROPERTY_COLUMNS
                if c != "token_cliente" and c not in rows.columns
            }
        )
    wanted = [
        "registro_id", "token_cliente", "grupo_id", "caixa_id", "caixa_codigo",
        "caixa_peso", "caixa_dt_producao",
        *[c for c in PROPERTY_COLUMNS if c != "token_cliente"],
        "desossa_id",
    ]
    out = [F.col(c) for c in wanted if c in rows.columns]
    if "desossa_lote" in rows.columns:
        out.append(F.col("desossa_lote").alias("lote_desossa"))
    out += [
        F.col(c)
        for c in ("propriedade_id", "propriedade_nome", "animal_id", "animal_codigo")
        if c in rows.columns
    ]
    return rows.select(*out, now_or(now).alias("dt_processamento"))


def sale_header_defaults(now: Column | None = None) -> dict[str, Column]:
    """Values of the header columns that no source fills."""
    stamp = now_or(now)
    day = stamp.cast("date")
    values: dict[str, Column] = {c: F.lit(SALE_HEADER_ZERO_ID) for c in SALE_HEADER_ZERO_IDS}
    values |= {c: day for c in SALE_HEADER_DATES}
    values |= {c: F.lit(text) for c, text in SALE_HEADER_TEXT.items()}
    values |= {"data_hora_processada": stamp, "flag_web": F.lit(True)}
    return values


def proc_sale_header(proc: DataFrame, now: Column | None = None) -> DataFrame:
    """One header per sale, keyed by the sale's id."""
    values = sale_header_defaults(now)
    stamp = now_or(now)
    sales = proc.select(F.col("registro_id").alias("id"), "token_cliente").distinct()
    return sales.select(
        "id",
        *[
            F.col(c) if c == "token_cliente" else values[c].alias(c)
            for c in SALE_HEADER_COLUMNS
        ],
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def proc_property(proc: DataFrame) -> DataFrame:
    """Distinct properties, when the required columns are there."""
    missing = [c for c in PROPERTY_REQUIRED if c not in proc.columns]
    if missing:
        raise ValueError(f"property columns missing: {missing}")
    return proc.select(*[c for c in PROPERTY_COLUMNS if c in proc.columns]).distinct()


def proc_animal(proc: DataFrame, now: Column | None = None) -> DataFrame:
    code = F.col("animal_codigo") if "animal_codigo" in proc.columns else F.lit(None)
    when = F.col("dt_processamento") if "dt_processamento" in proc.columns else now_or(now)
    return (
        proc.filter(F.col("animal_id").isNotNull())
        .select(
            F.col("animal_id").alias("id"),
            "token_cliente",
            code.cast("string").alias("codigo"),
            when.alias("dt_processamento"),
        )
        .distinct()
    )


def proc_sale_property(proc: DataFrame) -> DataFrame:
    """Which properties stand behind which sale."""
    return (
        proc.select("propriedade_id", F.col("registro_id").alias("registro_venda_id"))
        .dropna()
        .distinct()
    )


def traced_sales(proc: DataFrame) -> DataFrame:
    """Ids of the sales with at least one traceable box."""
    return proc.select("registro_id").distinct()
