"""Small invented rows for the tests."""

from __future__ import annotations

import datetime as dt

from boxtrail.schemas import BOX

DEBONING = (
    "id string, token_cliente string, nr_unidade_desossa string, nr_op_desossa string, "
    "lote string, dt_abate date, nr_unidade_abate string"
)
ORIGIN = "id string, token_cliente string, codigo string, dt_abate date, nr_unidade_abate string"
SCHEDULE = "id string, dt_abate date, nr_unidade_abate string, prod_cpf_cnpj string, faz_nome string"
PROPERTY = "id string, nome string"
SALE = (
    "id string, token_cliente string, grupo_id int, flag_processada boolean, "
    "data_hora_processada timestamp, created_at timestamp, json_caixas string"
)

DAY = dt.date(2024, 3, 10)
OTHER_DAY = dt.date(2024, 3, 11)


def box(**values):
    base = dict.fromkeys(BOX.fieldNames())
    base |= {
        "token_cliente": "t0", "dt_producao": DAY, "nr_unidade_desossa": "U1",
        "nr_op_desossa": "OP1", "flag_processamento": False,
    }
    return tuple({**base, **values}[c] for c in BOX.fieldNames())


def boxes(spark, *rows):
    return spark.createDataFrame([box(**r) for r in rows], BOX)


def deboning(spark, *rows):
    return spark.createDataFrame(list(rows), DEBONING)


def schedule(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEDULE)


def animals(spark, *rows):
    return spark.createDataFrame(list(rows), ORIGIN)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def by_id(df, *columns):
    """id to the row's other values, for frames with one row per id."""
    found = {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}
    return {k: v[0] if len(columns) == 1 else v for k, v in found.items()}
