"""Selections and state changes on three-valued flags."""

from __future__ import annotations

from itertools import product

import pytest
from pyspark.sql import functions as F

from boxtrail.operators import filters as sel, reports, transitions as st
from boxtrail.schemas import STAGE_FLAGS
from data import DAY, OTHER_DAY, boxes, by_id, rows

TRIPLES = list(product((True, False, None), repeat=3))


@pytest.fixture(scope="module")
def triples(spark):
    """All 27 flag triples, each box waiting to be processed."""
    return boxes(
        spark, *[{"id": f"b{i:02}", **dict(zip(STAGE_FLAGS, t))} for i, t in enumerate(TRIPLES)]
    )


def expected_label(linked, prop, animal):
    if linked and prop and animal:
        return "Todas flags true"
    if linked and (prop is False or animal is False):
        return "Desossa true, outras false"
    return "Desossa false" if linked is False else "Outros casos"


def test_labels_of_all_triples(triples):
    got = by_id(triples.withColumn("label", reports.flag_label()), "label")
    assert got == {f"b{i:02}": expected_label(*t) for i, t in enumerate(TRIPLES)}


def test_pending_any_flag_of_all_triples(triples):
    got = {r.id for r in sel.pending_boxes(triples, "t0", DAY, DAY).collect()}
    assert got == {f"b{i:02}" for i, t in enumerate(TRIPLES) if t != (True, True, True)}


def test_null_processing_flag_is_not_waiting(spark):
    df = boxes(
        spark, {"id": "a", "flag_processamento": None}, {"id": "b", "flag_processamento": False}
    )
    assert [r.id for r in sel.pending_boxes(df, "t0", DAY, DAY).collect()] == ["b"]


def test_reprocess_drops_the_link_test(triples):
    assert sel.pending_boxes(triples, "t0", DAY, DAY, reprocess=True).count() == 27


def test_period_includes_both_ends_and_needs_both(spark):
    df = boxes(
        spark, {"id": "a", "dt_producao": DAY}, {"id": "b", "dt_producao": OTHER_DAY},
        {"id": "c", "dt_producao": None},
    )
    assert [r.id for r in sel.tenant_period(df, "t0", DAY, OTHER_DAY).orderBy("id").collect()] == ["a", "b"]
    assert sel.tenant_period(df, "t0").count() == 3
    with pytest.raises(ValueError):
        sel.tenant_period(df, "t0", DAY, None)


def test_chosen_flags(triples):
    got = sel.pending_by_flags(triples, "t0", DAY, DAY, ["flag_animais"])
    assert got.count() == 18
    assert sel.pending_by_flags(triples, "t0", DAY, DAY).count() == 27


def test_set_traceable_only_complete_boxes_and_never_back(spark):
    done = dict.fromkeys(STAGE_FLAGS, True)
    df = boxes(
        spark, {"id": "new", **done}, {"id": "no", **done, "flag_rastreavel": False},
        {"id": "kept", "flag_rastreavel": True}, {"id": "open", "flag_desossa": True},
        {"id": "other", **done, "token_cliente": "t1"},
    )
    got = st.set_traceable(df, "t0")
    assert by_id(got, "flag_rastreavel") == {
        "new": True, "no": True, "kept": True, "open": None, "other": None
    }
    assert {r.id for r in got.filter("updated_at IS NOT NULL").collect()} == {"new", "no"}


def test_reset_leaves_the_traceable_flag(spark):
    df = boxes(spark, {"id": "a", "flag_desossa": True, "flag_rastreavel": True})
    got = st.reset_flags(df, "t0").first()
    assert (got.flag_processamento, got.flag_desossa, got.flag_propriedades, got.flag_animais) == (
        False, False, False, False
    )
    assert got.flag_rastreavel is True


def test_mark_processed_ignores_a_passed_processing_flag(spark):
    df = boxes(spark, {"id": "a"}, {"id": "a"}, {"id": "b"}, {"id": None})
    ids = df.filter("id = 'a'").select("id")
    got = st.mark_processed(df, ids, {"flag_desossa": True, "flag_processamento": False})
    assert rows(got, "id", "flag_processamento", "flag_desossa") == sorted(
        [("a", True, True), ("a", True, True), ("b", False, None), (None, False, None)], key=repr
    )


def test_row_operations(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "id string, n int")
    assert rows(st.update_where(df, {"n": 2}, {"id": "x"})) == [("a", 1), ("c", None), ("x", 2)]
    assert rows(st.delete_where(df, {"n": 2})) == [("a", 1), ("c", None)]
    assert st.affected(df, {"n": 2}).first()[0] == 1
    more = spark.createDataFrame([("d",)], "id string")
    assert rows(st.insert_rows(df, more))[-1] == ("d", None)
    with pytest.raises(ValueError):
        st.delete_where(df, {})


def test_flag_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "boxes")
    boxes(spark, {"id": "a"}).write.partitionBy("token_cliente").parquet(path)
    df = sel.needs_deboning(spark.read.parquet(path), "t0", DAY, OTHER_DAY).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(dt_producao)" in plan
    assert "Or(IsNull(flag_desossa),Not(EqualTo(flag_desossa,true)))" in plan
    assert "PartitionFilters: [isnotnull(token_cliente" in plan
    assert "json_desossa" not in plan


def test_counts_by_tenant(spark):
    df = boxes(
        spark, {"id": "a", "flag_rastreavel": True}, {"id": "b", "flag_rastreavel": False},
        {"id": "c"}, {"id": "d", "token_cliente": "t1"},
    )
    assert rows(reports.flag_status(df, "t0")) == [("t0", 3, 1, 1, 1)]
    assert reports.flag_status(df).count() == 2


def test_required_filter_keeps_two_of_four(spark):
    df = spark.createDataFrame(
        [("1", "A"), (None, "B"), ("3", None), ("4", "D")], "id string, identificacao string"
    )
    assert rows(sel.with_required(df, ["id", "identificacao"])) == [("1", "A"), ("4", "D")]


def test_oldest_sales_of_a_tenant_are_closed(spark):
    sales = spark.createDataFrame(
        [(str(i), "t0", False, None, None) for i in range(5)],
        "id string, token_cliente string, flag_processada boolean, "
        "data_hora_processada timestamp, created_at timestamp",
    )
    got = st.mark_sales_by_tenant(sales, "t0", 3)
    assert rows(got, "id", "flag_processada") == [
        ("0", True), ("1", True), ("2", True), ("3", False), ("4", False)
    ]
    assert got.filter(F.col("data_hora_processada").isNotNull()).count() == 3
