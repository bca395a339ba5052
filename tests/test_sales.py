"""Sales: parsing their box lists, lineage, and the result tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boxtrail.functions.payload import row_json
from boxtrail.operators import sales as op
from boxtrail.plans.sale_trace import sale_rows, sale_trace
from boxtrail.schemas import SALE_HEADER_COLUMNS, STAGE_FLAGS
from data import DAY, PROPERTY, SALE, animals, boxes, by_id, deboning, rows

DONE = {**dict.fromkeys(STAGE_FLAGS, True), "flag_rastreavel": True}


def sale(ident, text, flag=False, token="t0", group=1, day=1):
    return (ident, token, group, flag, None, dt.datetime(2024, 1, day), text)


def sales(spark, *items):
    return spark.createDataFrame(list(items), SALE)


@pytest.fixture(scope="module")
def lookups(spark):
    return (
        deboning(spark, ("d1", "t0", "U1", "OP1", "L1", DAY, "A1")),
        spark.createDataFrame([("p1", "Fazenda")], PROPERTY),
        animals(spark, ("a1", "t0", "X", DAY, "A1")),
    )


@pytest.fixture(scope="module")
def traced(spark):
    lineage = {
        "json_desossa": '{"id":"d1"}',
        "json_propriedades": '{"id":"p1","dt_abate":"2024-03-10","nr_unidade_abate":"A1",'
        '"prod_cpf_cnpj":"0011","nr_lote_abate":7,"json_gtas":"[{\\"nr_gta\\":\\"G\\"}]"}',
        "json_animais": '{"id":"a1"}',
    }
    return boxes(
        spark,
        {"id": "b1", **DONE, **lineage, "codigo": "c1", "peso": 10.0},
        {"id": "b2", **DONE, **lineage, "codigo": "c2"},
        {"id": "7", **DONE, "json_animais": '{"id":"unknown"}'},
        {"id": "open", "flag_desossa": True},
    )


def test_box_lists_of_every_kind(spark):
    df = sales(
        spark,
        sale("ok", '[{"id":"b1","codigo":"c","peso":"1"},{"id":" b2 "}]'),
        sale("null", None), sale("empty", "[]"), sale("broken", '[{"id":"b1"'),
        sale("single", '{"id":"b1"}'), sale("number", '[{"id":7}]'), sale("blank", '[{"id":"  "}]'),
    )
    assert rows(op.explode_sale_boxes(df), "registro_id", "caixa_id") == [
        ("blank", None), ("number", "7"), ("ok", "b1"), ("ok", "b2"), ("single", "b1")
    ]


def test_group_column_may_be_absent(spark):
    df = sales(spark, sale("a", '{"id":"b1"}')).drop("grupo_id")
    assert op.explode_sale_boxes(df).first().grupo_id is None
    assert op.oldest_unprocessed(df, token="t0").count() == 1
    with pytest.raises(ValueError, match="grupo_id"):
        op.oldest_unprocessed(df, grupo_id=9)


def test_oldest_open_sales_first(spark):
    df = sales(
        spark, sale("c", "", day=3), sale("b", "", day=2), sale("a", "", day=2),
        sale("null", "", None, day=1), sale("done", "", True, day=1), sale("t", "", token="t1"),
        sale("g", "", group=2, day=4),
    )
    ids = lambda d: [r.id for r in d.collect()]
    assert ids(op.oldest_unprocessed(df, token="t0", limit=2)) == ["a", "b"]
    assert ids(op.oldest_unprocessed(df, grupo_id=2)) == ["g"]
    assert op.oldest_unprocessed(df, token="t0", limit=None).count() == 4


def test_lineage_takes_one_row_of_an_id(traced, lookups):
    once = op.lineage_lookup(traced, *lookups)
    twice = op.lineage_lookup(traced, *(d.union(d) for d in lookups))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_lineage_needs_all_four_flags(traced, lookups):
    got = by_id(
        op.lineage_lookup(traced, *lookups), "desossa_lote", "propriedade_nome", "animal_codigo"
    )
    assert got == {
        "b1": ("L1", "Fazenda", "X"), "b2": ("L1", "Fazenda", "X"), "7": (None, None, None)
    }


def test_semi_join_trims(spark, traced):
    named = op.explode_sale_boxes(sales(spark, sale("s", '[{"id":" b1 "},{"id":"b1"},{"id":"zz"}]')))
    assert [r.id for r in op.semi_by_ids(traced, named).collect()] == ["b1"]


def test_one_join_for_a_run_equals_the_separate_steps(spark, traced, lookups):
    named = op.explode_sale_boxes(
        sales(spark, sale("s1", '[{"id":"b1"},{"id":"7"}]'), sale("s2", '[{"id":"b1 "},{"id":"open"}]'))
    ).drop("codigo", "peso")
    step = op.sale_box_join(named, op.lineage_lookup(op.semi_by_ids(traced, named), *lookups))
    whole = op.sale_lineage(named, traced, *lookups)
    names = ("registro_id", "caixa_id", "desossa_id", "propriedade_id", "animal_codigo")
    assert rows(step, *names) == rows(whole, *names)
    assert len(rows(whole, *names)) == 3


def run(spark, traced, lookups, *items, **options):
    return sale_trace(sales(spark, *items), traced, *lookups, **{"token": "t0", **options})


def test_result_tables(spark, traced, lookups):
    got = run(
        spark, traced, lookups,
        sale("s1", '[{"id":"b1"},{"id":"b2"},{"id":"7"}]'), sale("s2", '[{"id":"b1"}]'),
        sale("none", '[{"id":"open"}]'), sale("done", '[{"id":"b1"}]', True),
    )
    assert rows(got.rows, "registro_id", "caixa_id", "caixa_codigo", "animal_id") == [
        ("s1", "7", None, None), ("s1", "b1", "c1", "a1"), ("s1", "b2", "c2", "a1"),
        ("s2", "b1", "c1", "a1"),
    ]
    assert rows(got.headers, "id", "token_cliente", "destino_pais") == [
        ("s1", "t0", "Brasil"), ("s2", "t0", "Brasil")
    ]
    assert got.headers.columns == ["id", *SALE_HEADER_COLUMNS, "created_at", "updated_at"]
    assert rows(got.properties, "dt_abate", "prod_cpf_cnpj", "nr_lote_abate", "json_gtas") == sorted(
        [(DAY, "0011", "7", '[{"nr_gta":"G"}]'), (None, None, None, None)], key=repr
    )
    assert rows(got.animals, "id", "token_cliente", "codigo") == [("a1", "t0", "X")]
    assert rows(got.sale_properties) == [("p1", "s1"), ("p1", "s2")]
    assert by_id(got.sales, "flag_processada") == {
        "s1": True, "s2": True, "none": False, "done": True
    }
    assert got.sales.filter("data_hora_processada IS NOT NULL").count() == 2


def test_limit_takes_the_oldest(spark, traced, lookups):
    got = run(
        spark, traced, lookups, sale("new", '{"id":"b1"}', day=2), sale("old", '{"id":"b1"}'), limit=1
    )
    assert [r.id for r in got.headers.collect()] == ["old"]


def test_needs_a_group_or_a_tenant(spark, traced, lookups):
    with pytest.raises(ValueError):
        sale_rows(sales(spark, sale("s", "[]")), traced, *lookups)


def test_missing_property_columns_are_an_error(traced):
    with pytest.raises(ValueError):
        op.proc_property(traced.select("id", "token_cliente"))


def test_shared_columns_get_a_prefix(spark):
    left = spark.createDataFrame([("1", "x")], "caixa_id string, codigo string")
    right = spark.createDataFrame([("1", "y", 2)], "id string, codigo string, n int")
    got = op.sale_box_join(left, right)
    assert got.columns == ["caixa_id", "codigo", "caixa_codigo", "n"]


def test_empty_input_keeps_the_schema(spark, traced, lookups):
    got = run(spark, traced, lookups)
    assert got.headers.count() == 0 and got.properties.count() == 0
    assert "id" in got.headers.columns


def test_lineage_json_is_text_of_the_row(spark):
    df = spark.createDataFrame([("a", DAY, None)], "id string, d date, v string")
    assert df.select(row_json(["id", "d", "v"])).first()[0] == '{"id":"a","d":"2024-03-10"}'
    assert df.select(F.col("v").alias("x")).first().x is None


def test_a_sale_meets_boxes_of_its_own_tenant(spark):
    named = spark.createDataFrame(
        [("s1", "t1", "b"), ("s2", "t2", "b"), ("s3", None, "b")],
        "registro_id string, token_cliente string, caixa_id string",
    )
    found = spark.createDataFrame([("b", "t1"), (" b ", "t3")], "id string, token_cliente string")
    got = op.sale_box_join(named, found, tenant_scoped=True)
    assert rows(got, "registro_id", "caixa_token_cliente") == [
        ("s1", "t1"), ("s3", "t1"), ("s3", "t3")
    ]
