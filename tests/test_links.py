"""Links, their flags and lineage, and their behaviour on hot keys."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from boxtrail.operators import link
from boxtrail.operators.lookups import left_lookup, one_per_key
from boxtrail.operators.sales import sale_box_join
from boxtrail.plans.trace import trace_all
from boxtrail.schemas import BOX
from data import DAY, OTHER_DAY, animals, boxes, by_id, deboning, rows, schedule


def test_unmatched_box_has_false_flag_and_no_lineage(spark):
    df = boxes(spark, {"id": "a"}, {"id": "b", "nr_op_desossa": "OP9", "flag_desossa": True})
    d = deboning(spark, ("d1", "t0", "U1", "OP1", "L1", DAY, "A1"))
    got = by_id(link.link_deboning(df, d), "flag_desossa", "json_desossa", "dt_abate")
    assert got["b"] == (False, None, None)
    assert got["a"][0] is True and got["a"][2] == DAY
    assert json.loads(got["a"][1]) == {
        "id": "d1", "token_cliente": "t0", "nr_unidade_desossa": "U1", "nr_op_desossa": "OP1",
        "lote": "L1", "dt_abate": "2024-03-10", "nr_unidade_abate": "A1",
    }


def test_two_orders_per_key_give_one_row(spark):
    df = boxes(spark, {"id": "a"})
    d = deboning(
        spark, ("d2", "t0", "U1", "OP1", "L2", DAY, "A1"), ("d1", "t0", "U1", "OP1", "L1", DAY, "A1")
    )
    got = link.link_deboning(df, d)
    assert got.count() == 1
    assert json.loads(got.first().json_desossa)["id"] == "d1"


def test_same_key_under_two_tenants(spark):
    df = boxes(spark, {"id": "a"}, {"id": "b", "token_cliente": "t1"})
    d = deboning(
        spark, ("d0", "t0", "U1", "OP1", "L", DAY, "A1"), ("d1", "t1", "U1", "OP1", "L", DAY, "A2")
    )
    scoped = by_id(link.link_deboning(df, d), "nr_unidade_abate")
    assert scoped == {"a": "A1", "b": "A2"}
    shared = by_id(link.link_deboning(df, d, tenant_scoped=False), "nr_unidade_abate")
    assert shared == {"a": "A1", "b": "A1"}
    grouped = by_id(link.link_deboning_grouped(df, d), "nr_unidade_abate")
    assert grouped == scoped


def test_null_keys_never_match(spark):
    df = boxes(spark, {"id": "a", "nr_op_desossa": None})
    d = deboning(spark, ("d1", "t0", "U1", None, "L1", DAY, "A1"))
    assert link.link_deboning(df, d).first().flag_desossa is False


def test_stored_slaughter_day_survives_a_missing_one(spark):
    df = boxes(spark, {"id": "a", "dt_abate": OTHER_DAY, "nr_unidade_abate": "A9"})
    d = deboning(spark, ("d1", "t0", "U1", "OP1", "L1", None, "A1"))
    got = link.link_deboning(df, d).first()
    assert (got.dt_abate, got.nr_unidade_abate) == (OTHER_DAY, "A1")


def test_origin_links_do_not_multiply_boxes(spark):
    df = boxes(
        spark,
        {"id": "both", "dt_abate": DAY, "nr_unidade_abate": "A1"},
        {"id": "animal", "dt_abate": OTHER_DAY, "nr_unidade_abate": "A1"},
        {"id": "none", "dt_abate": None, "nr_unidade_abate": "A1"},
    )
    s = schedule(spark, ("s2", DAY, "A1", "2", None), ("s1", DAY, "A1", "1", "F"))
    a = animals(
        spark, ("a1", "t0", "X", DAY, "A1"), ("a2", "t0", "Y", DAY, "A1"),
        ("a3", "t0", "Z", OTHER_DAY, "A1"),
    )
    both = link.link_origin(df, s, a)
    flags = by_id(both, "flag_propriedades", "flag_animais")
    assert flags == {"both": (True, True), "animal": (False, True), "none": (False, False)}
    assert json.loads(by_id(both, "json_propriedades")["both"])["id"] == "s1"
    one_by_one = link.link_animals(link.link_schedule(df, s), a)
    names = ("id", "flag_propriedades", "flag_animais", "json_propriedades", "json_animais")
    assert rows(one_by_one, *names) == rows(both, *names)


def test_origin_links_keep_tenants_apart(spark):
    place = {"dt_abate": DAY, "nr_unidade_abate": "A1"}
    df = boxes(spark, {"id": "a", **place}, {"id": "b", "token_cliente": "t1", **place})
    a = animals(spark, ("a1", "t1", "X", DAY, "A1"))
    s = schedule(spark, ("s1", DAY, "A1", "1", None))
    got = by_id(link.link_origin(df, s, a), "flag_propriedades", "flag_animais")
    assert got == {"a": (True, False), "b": (True, True)}
    shared = by_id(
        link.link_origin(df, s, a, tenant_scoped=False), "flag_propriedades", "flag_animais"
    )
    assert shared == {"a": (True, True), "b": (True, True)}


def test_both_origin_links_use_the_selection_made_before(spark):
    """The schedule link closes a flag the selection looks at."""
    place = {"dt_abate": DAY, "nr_unidade_abate": "A1"}
    df = boxes(spark, {"id": "a", "flag_propriedades": False, "flag_animais": True, **place})
    a = animals(spark, ("a1", "t0", "X", DAY, "A1"))
    s = schedule(spark, ("s1", DAY, "A1", "1", None))
    got = link.link_origin(df, s, a, where=~F.col("flag_propriedades")).first()
    assert got.flag_propriedades is True and json.loads(got.json_animais)["id"] == "a1"


def test_rows_outside_the_selection_keep_their_values(spark):
    df = boxes(
        spark, {"id": "a"}, {"id": "b", "flag_desossa": True, "json_desossa": "old"}
    )
    d = deboning(spark, ("d1", "t0", "U1", "OP1", "L1", DAY, "A1"))
    got = by_id(
        link.link_deboning(df, d, where=F.col("id") == "a"), "flag_desossa", "json_desossa", "updated_at"
    )
    assert got["b"] == (True, "old", None)
    assert got["a"][0] is True and got["a"][2] is not None


@pytest.mark.parametrize("salt", [1, 7])
def test_lookup_equals_plain_join(spark, salt):
    left = spark.range(500).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k")
    )
    right = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c")], "k long, v string")
    got = left_lookup(left, right, {"k": F.col("k")}, ["v"], salt=salt)
    want = left.join(right, "k", "left").select("id", "k", "v")
    assert rows(got) == rows(want)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                            st.one_of(st.none(), st.sampled_from("ab"))), max_size=8),
    right=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                             st.one_of(st.none(), st.sampled_from("ab"))), max_size=6),
    salt=st.sampled_from([1, 3]),
    how=st.sampled_from(["left", "left_semi", "left_anti"]),
)
def test_lookup_on_any_rows_equals_plain_join(spark, left, right, salt, how):
    a = spark.createDataFrame([(str(i), *r) for i, r in enumerate(left)], "id string, k int, m string")
    b = spark.createDataFrame([(*r, i) for i, r in enumerate(right)], "k2 int, m2 string, v int")
    payload = ["v"] if how == "left" else []
    got = left_lookup(a, b, {"k2": F.col("k"), "m2": F.col("m")}, payload, salt=salt, how=how)
    want = a.join(b, (a.k == b.k2) & (a.m == b.m2), how).select(*a.columns, *payload)
    assert rows(got) == rows(want)


def _partitions(df):
    """Rows per task of the last join, without the runtime changing it."""
    return Counter(r[0] for r in df.select(F.spark_partition_id()).collect())


def test_missing_and_hot_keys_are_spread(spark, conf):
    """A third of the rows lack the key, a third share one."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    n = 9000
    left = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 7)
        .otherwise(F.col("id")).cast("long").alias("k"),
    )
    right = spark.range(0, n).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    got = _partitions(left_lookup(left, right, {"k": F.col("k")}, ["v"], salt=16))
    assert sum(got.values()) == n
    assert max(got.values()) < n / 5
    plain = _partitions(left.join(right, "k", "left"))
    assert max(plain.values()) > n / 4


@pytest.fixture
def small_partitions(conf):
    """Thresholds at which a few thousand rows count as a large partition."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__shuffle__partitions="8",
    )


def hot_boxes(spark, n):
    """A third of the boxes come from one deboning order, and a third of the
    orders from one slaughter day; a tenth have no order at all."""
    i = F.col("id")
    order = F.when(i % 10 == 9, F.lit(None)).when(i % 3 == 0, "HOT").otherwise(i.cast("string"))
    values = {
        "id": F.sha2(i.cast("string"), 256),
        "token_cliente": F.lit("t0"),
        "dt_producao": F.lit(DAY),
        "nr_unidade_desossa": F.concat(F.lit("U"), (i % 1).cast("string")),
        "nr_op_desossa": order,
        "flag_processamento": F.lit(False),
    }
    return spark.range(0, n, 1, 8).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in BOX]
    )


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.index("Initial Plan")]


def test_runtime_splits_hot_keys_of_both_links_of_a_trace(spark, small_partitions):
    n = 60_000
    df = hot_boxes(spark, n)
    d = df.select("nr_unidade_desossa", "nr_op_desossa").dropna().distinct().select(
        F.col("nr_op_desossa").alias("id"), "nr_unidade_desossa", "nr_op_desossa",
        F.when(F.length("nr_op_desossa") % 2 == 1, F.lit(DAY)).otherwise(
            F.date_add(F.lit(DAY), F.length("nr_op_desossa"))
        ).alias("dt_abate"),
        F.lit("A1").alias("nr_unidade_abate"),
    )
    s = schedule(spark, ("s1", DAY, "A1", "1", None))
    a = animals(spark, ("a1", "t0", "X", DAY, "A1")).drop("token_cliente")
    traced = trace_all(df, d, s, a, "t0", reset=True)
    assert traced.count() == n
    assert traced.filter("flag_desossa").count() == n - n // 10
    plan = final_plan(traced.select("id", "flag_desossa", "json_propriedades", "json_animais"))
    assert plan.count("SortMergeJoin(skew=true)") == 2


def test_runtime_splits_a_hot_box_of_many_sales(spark, small_partitions):
    n = 60_000
    i = F.col("id")
    named = spark.range(0, n, 1, 8).select(
        F.sha2(i.cast("string"), 256).alias("registro_id"),
        F.when(i % 3 == 0, "HOT").otherwise(i.cast("string")).alias("caixa_id"),
    )
    sold = named.select(F.col("caixa_id").alias("id"), F.lit("c").alias("codigo")).distinct()
    joined = sale_box_join(named, sold.repartition(4))
    assert joined.count() == n
    assert "skew=true" in final_plan(joined)


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id"))
    one = one_per_key(df, ["k"])
    assert rows(one) == [(0, 0), (1, 1)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_choice_does_not_depend_on_layout(spark):
    df = spark.createDataFrame(
        [("a", 3, None), ("a", 1, "x"), ("a", 1, None), ("a", 2, "y")], "k string, n int, v string"
    )
    results = {rows(one_per_key(df.repartition(i), ["k"]))[0] for i in (1, 2, 5)}
    assert results == {("a", 1, "x")}
