"""The trace stages in sequence, and what must hold whatever the data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from boxtrail import bindings as b
from boxtrail.functions.payload import json_id
from boxtrail.operators import merge
from boxtrail.plans import trace
from boxtrail.schemas import BOX, STAGE_FLAGS
from data import DAY, OTHER_DAY, animals, boxes, by_id, deboning, rows, schedule

SF = "/root/testdata/sf0.001"
CLOCK = "2024-06-01 12:00:00"


def clock():
    return F.lit(CLOCK).cast("timestamp")


@pytest.fixture(scope="module")
def lookups(spark):
    return (
        deboning(
            spark, ("d1", "t0", "U1", "OP1", "L1", DAY, "A1"),
            ("d2", "t0", "U1", "OP2", "L2", OTHER_DAY, "A1"),
        ),
        schedule(spark, ("s1", DAY, "A1", "11", "F")),
        animals(spark, ("a1", "t0", "X", DAY, "A1")),
    )


STATE = ("flag_processamento", *STAGE_FLAGS, "flag_rastreavel")


def test_whole_run(spark, lookups):
    df = boxes(
        spark, {"id": "full"}, {"id": "half", "nr_op_desossa": "OP2"},
        {"id": "lost", "nr_op_desossa": "OP3"}, {"id": "other", "token_cliente": "t1"},
    )
    got = by_id(trace.trace_all(df, *lookups, "t0"), *STATE)
    assert got == {
        "full": (True, True, True, True, True),
        "half": (True, True, False, False, None),
        "lost": (False, False, None, None, None),
        "other": (False, None, None, None, None),
    }


def test_without_the_traceable_update(spark, lookups):
    got = trace.trace_all(boxes(spark, {"id": "a"}), *lookups, "t0", update_traceable=False)
    assert got.first().flag_rastreavel is None


def test_settled_boxes_are_left_alone(spark, lookups):
    settled = {**dict.fromkeys(STAGE_FLAGS, True), "json_desossa": "old"}
    df = boxes(spark, {"id": "a", **settled, "nr_op_desossa": "OP3"})
    got = trace.trace_all(df, *lookups, "t0").first()
    assert (got.json_desossa, got.flag_desossa, got.flag_rastreavel) == ("old", True, True)


def test_reset_links_again(spark, lookups):
    settled = {**dict.fromkeys(STAGE_FLAGS, True), "json_desossa": "old"}
    df = boxes(spark, {"id": "a", **settled, "nr_op_desossa": "OP3"})
    got = trace.trace_all(df, *lookups, "t0", reset=True).first()
    assert (got.json_desossa, got.flag_desossa) == (None, False)


def test_period_run_and_its_worklist(spark, lookups):
    done = {**dict.fromkeys(STAGE_FLAGS, True), "flag_processamento": True}
    df = boxes(
        spark, {"id": "in"}, {"id": "lost", "nr_op_desossa": "OP3", "flag_processamento": None},
        {"id": "late", "dt_producao": OTHER_DAY}, {"id": "done", **done},
    )
    got = trace.trace_period(df, *lookups, "t0", DAY, DAY, now=clock())
    assert by_id(got, *STATE) == {
        "in": (True, True, True, True, None),
        "lost": (True, False, False, False, None),
        "late": (False, None, None, None, None),
        "done": (True, True, True, True, None),
    }
    assert {r.id for r in trace.worked_on(got, clock()).collect()} == {"in", "lost"}


def test_modes_and_their_errors(spark, lookups):
    df = boxes(spark, {"id": "a"})
    first = trace.trace_stage("desossa", df, *lookups, "t0")
    assert by_id(first, *STATE) == {"a": (False, True, None, None, None)}
    second = trace.trace_stage("propriedades", first, *lookups, "t0")
    assert by_id(second, *STATE) == {"a": (False, True, True, True, None)}
    third = trace.trace_stage("proc-caixas", second, *lookups, "t0")
    assert by_id(third, *STATE) == {"a": (True, True, True, True, None)}
    whole = trace.trace_stage("completo", df, *lookups, "t0", DAY, DAY, every_period=True)
    assert whole.first().flag_rastreavel is True
    with pytest.raises(ValueError):
        trace.trace_stage("completo", df, *lookups, "t0", DAY)
    with pytest.raises(ValueError):
        trace.trace_stage("tudo", df, *lookups, "t0")


@pytest.fixture(scope="module")
def real(spark):
    lookups = (b.deboning(spark, SF), b.schedule(spark, SF), b.animals(spark, SF))
    return b.boxes(spark, SF), lookups


def test_no_box_lost_and_running_twice_changes_nothing(real):
    boxes, lookups = real
    once = trace.trace_all(boxes, *lookups, None, now=clock())
    twice = trace.trace_all(once, *lookups, None, now=clock())
    assert once.count() == boxes.count()
    assert rows(once, *BOX.fieldNames()) == rows(twice, *BOX.fieldNames())


def test_flag_holds_exactly_where_there_is_lineage(real):
    boxes, lookups = real
    traced = trace.trace_all(boxes, *lookups, None, reset=True)
    for flag, text in (
        ("flag_desossa", "json_desossa"), ("flag_propriedades", "json_propriedades"),
        ("flag_animais", "json_animais"),
    ):
        wrong = traced.filter(F.col(flag) != json_id(F.col(text)).isNotNull())
        assert wrong.count() == 0
    linked = traced.filter("flag_desossa").count()
    assert 0 < linked <= boxes.count()


def test_result_rows_are_one_per_box_and_merge_is_idempotent(spark, lookups):
    df = boxes(
        spark, {"id": "a", "updated_at": None}, {"id": "a", "codigo": "z"}, {"id": "b"}
    )
    traced = trace.trace_all(df, *lookups, "t0", now=clock())
    new = trace.proc_boxes(trace.proc_candidates(traced, "t0"), clock())
    assert sorted(r.id for r in new.collect()) == ["a", "b"]
    assert "json_desossa" not in new.columns and "codigo_barras" not in new.columns
    before = F.lit("2024-01-01 00:00:00").cast("timestamp")
    stored = merge.schema_align(
        boxes(spark, {"id": "b"}, {"id": "c"}), now=before, fill=True
    ).withColumn("codigo_barras", F.lit("bar"))
    once = trace.merge_proc(stored, new, df.columns)
    twice = trace.merge_proc(once, new, df.columns)
    assert rows(once) == rows(twice)
    got = by_id(once, "codigo_barras", "nr_unidade_abate")
    assert got == {"a": (None, "A1"), "b": ("bar", "A1"), "c": ("bar", None)}
    kept = once.join(stored.select("id", F.col("created_at").alias("old")), "id")
    assert kept.filter(F.col("created_at") != F.col("old")).count() == 0
