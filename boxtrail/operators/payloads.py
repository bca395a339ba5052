"""Payload rows to table rows: projections, defaults, mapping, flattening."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from boxtrail.functions.payload import iso_timestamp, json_or_empty, variant_json
from boxtrail.functions.rewrite import now_or
from boxtrail.operators.validate import required_rules, type_rules
from boxtrail.schemas import ANIMAL, ANIMAL_RAW, SCHEDULE, SLAUGHTER_MAPPING
from boxtrail.sources.json_files import CORRUPT

SCHEDULE_KEYS = ("dt_abate", "nr_unidade_abate", "nr_lote_abate")


def _animal_column(field: T.StructField) -> Column:
    raw = F.col(field.name)
    if isinstance(ANIMAL_RAW[field.name].dataType, T.VariantType):
        out = variant_json(raw)
    elif isinstance(field.dataType, T.TimestampType):
        out = iso_timestamp(raw)
    elif isinstance(field.dataType, T.StringType):
        out = raw
    else:
        out = raw.try_cast(field.dataType)
    return out.alias(field.name)


def animal_projection(raw: DataFrame, *keep: str) -> DataFrame:
    """The 33 typed animal columns, and any other columns to keep."""
    return raw.select(*[_animal_column(f) for f in ANIMAL], *keep)


def animal_rules() -> dict[str, Column]:
    """The id must be there and numbers must be numbers; dates are lenient."""
    numbers = {
        f.name: f.dataType.simpleString()
        for f in ANIMAL
        if isinstance(f.dataType, (T.IntegerType, T.DoubleType))
    }
    return {**corrupt_rule(), **required_rules(["id"]), **type_rules(numbers)}


def corrupt_rule() -> dict[str, Column]:
    """Documents the reader could not fit to the schema."""
    return {"json invalido": F.col(CORRUPT).isNotNull()}


def audit_stamp(df: DataFrame, token: str, now: Column | None = None) -> DataFrame:
    stamp = now_or(now)
    return df.withColumns(
        {"created_at": stamp, "updated_at": stamp, "token_cliente": F.lit(token)}
    )


def processed_stamp(df: DataFrame, now: Column | None = None) -> DataFrame:
    return df.withColumn("processado_em", now_or(now))


def default_json(
    df: DataFrame, source: str = "habilitacoes_etiqueta", target: str = "json_habilitacoes"
) -> DataFrame:
    return df.withColumn(target, json_or_empty(F.col(source)))


def field_mapping(df: DataFrame, mapping=SLAUGHTER_MAPPING, keep: tuple[str, ...] = ()):
    """Select, rename and cast by table: (target, source, type)."""
    kinds = dict(df.dtypes)
    out = []
    for target, source, kind in mapping:
        column = F.col(source)
        if kinds[source] == "string" and kind == "date":
            column = F.try_to_date(column)
        elif kinds[source] == "boolean":
            column = column.cast("int").cast(kind)
        elif kinds[source] != kind:
            column = column.try_cast(kind)
        out.append(column.alias(target))
    return df.select(*out, *keep)


class Schedule(NamedTuple):
    header: DataFrame
    trucks: DataFrame
    permits: DataFrame
    invoices: DataFrame
    items: DataFrame


def _blank_to_null(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        column = F.nullif(F.trim(column), F.lit(""))
    return column.alias(field.name)


def _schedule_header() -> Column:
    """Scalars, with empty text as NULL, plus permits and invoices as JSON
    text. The compressed invoice document is left out."""
    scalars = [f for f in SCHEDULE if not isinstance(f.dataType, T.ArrayType)]
    invoices = F.transform("nfs", lambda n: n.dropFields("xml"))
    return F.struct(
        *[_blank_to_null(f) for f in scalars],
        F.to_json("gtas").alias("json_gtas"),
        F.to_json(invoices).alias("json_nfs"),
    )


def _fields(array: str) -> list[str]:
    return SCHEDULE[array].dataType.elementType.fieldNames()


def _at_least_one(array: Column) -> Column:
    """The array, or one NULL where it is empty or absent."""
    return F.when(F.size(array) > 0, array).otherwise(F.array(F.lit(None)))


def _schedule_parts() -> dict[str, Column]:
    """Rows of each part of a schedule, as arrays of structs."""
    def children(array: Column, build) -> Column:
        return F.transform(_at_least_one(array), build)

    def invoice_items(invoice: Column) -> Column:
        return children(invoice["itens"], lambda i: F.struct(
            invoice["numero"].alias("numero"),
            *[i[f.name].alias(f.name) for f in _ITEM],
        ))

    invoice = [c for c in _fields("nfs") if c not in ("xml", "itens")]
    return {
        "escala": F.array(_schedule_header()),
        "caminhao": children(F.col("caminhoes"), lambda c: F.struct(c["placa_veiculo"].alias("placa_veiculo"))),
        "gta": children(F.col("gtas"), lambda g: F.struct(g["nr_gta"].alias("nr_gta"))),
        "nf": children(F.col("nfs"), lambda n: F.struct(*[n[c].alias(c) for c in invoice])),
        "item": F.flatten(children(F.col("nfs"), invoice_items)),
    }


_ITEM = SCHEDULE["nfs"].dataType.elementType["itens"].dataType.elementType
SCHEDULE_PARTS = ("escala", "caminhao", "gta", "nf", "item")
SCHEDULE_PART = "parte"


def schedule_rows(payload: DataFrame) -> DataFrame:
    """All parts of the schedules as tagged rows, in one pass over the payload.

    ``parte`` names the part and one column per part holds its fields; the others are
    NULL. Rows are keyed by slaughter day, unit and lot. A schedule, or invoice,
    without children keeps one child row of NULLs.
    """
    parts = payload.select(
        *SCHEDULE_KEYS, F.struct(*[c.alias(n) for n, c in _schedule_parts().items()]).alias("_s")
    )
    kinds = parts.schema["_s"].dataType

    def tagged(name: str):
        def row(value: Column) -> Column:
            return F.struct(
                F.lit(name).alias(SCHEDULE_PART),
                *[
                    (value if n == name else F.lit(None)).cast(kinds[n].dataType.elementType).alias(n)
                    for n in SCHEDULE_PARTS
                ],
            )
        return row

    rows = F.concat(*[F.transform(F.col(f"_s.{n}"), tagged(n)) for n in SCHEDULE_PARTS])
    return parts.select(*SCHEDULE_KEYS, F.inline(rows))


def schedule_part(rows: DataFrame, part: str, *keep: str) -> DataFrame:
    """One part of tagged rows with its own columns."""
    own = rows.filter(F.col(SCHEDULE_PART) == F.lit(part))
    fields = rows.schema[part].dataType.fieldNames()
    keys = [k for k in SCHEDULE_KEYS if k not in fields]
    return own.select(*keys, *[F.col(part)[c].alias(c) for c in fields], *keep)


def flatten_schedule(payload: DataFrame) -> Schedule:
    """Header and child tables. They read the same tagged rows; a job stores those."""
    rows = payload if SCHEDULE_PART in payload.columns else schedule_rows(payload)
    return Schedule(*[schedule_part(rows, part) for part in SCHEDULE_PARTS])


def schedule_origin(rows: DataFrame, *keep: str) -> DataFrame:
    """Schedule headers as tracing links them: an id made of the keys comes first."""
    header = schedule_part(rows, "escala", *keep)
    ident = F.concat_ws("-", *SCHEDULE_KEYS).alias("id")
    return header.select(ident, *header.columns)


def slaughtered_animals(records: DataFrame) -> DataFrame:
    """Slaughter records as the animals that tracing links by slaughter day and unit.

    The animal's number, chip or bar code, whichever is there first, is its code; the
    id adds the slaughter, as numbers may return.
    """
    code = F.coalesce("nr_identificacao", "nr_chip", "codigo_barra_etiqueta")
    ident = F.concat_ws("-", "dt_abate", "nr_unidade_abate", "nr_lote_abate", "nr_sequencial", code)
    return records.select(
        ident.alias("id"), "token_cliente", code.alias("codigo"), "dt_abate", "nr_unidade_abate",
        "sexo", "dt_nascimento", "peso_carcaca", "prod_cpf_cnpj",
    )
