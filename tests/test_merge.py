"""Alignment, merges, duplicates and set operations."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from boxtrail.operators import merge
from boxtrail.schemas import PROC_BOX
from boxtrail.session import materialise
from data import boxes, rows


def stored(df):
    return materialise(df, "merge-test")


def test_newest_row_wins(spark):
    df = boxes(
        spark,
        {"id": "a", "codigo": "old", "updated_at": dt.datetime(2024, 1, 1)},
        {"id": "a", "codigo": "new", "updated_at": dt.datetime(2024, 1, 2)},
        {"id": "a", "codigo": "never"},
        {"id": "b", "codigo": "y"}, {"id": "b", "codigo": "x"},
    )
    assert rows(merge.dedup_by_id(df), "id", "codigo") == [("a", "new"), ("b", "x")]
    assert rows(merge.duplicate_ids(df)) == [("a", 3), ("b", 2)]
    assert rows(merge.duplicate_summary(df)) == [(2, 5)]


def test_align_renames_orders_and_fills(spark):
    df = spark.createDataFrame(
        [("a", "T", "{}", 1)],
        "id string, tipo_unidade_abate_id string, json_habilitacoes string, extra int",
    )
    short = merge.schema_align(df)
    assert short.columns == [
        "id", "tipo_unidade_abate", "json_habilitacoes", "created_at", "updated_at"
    ]
    full = merge.schema_align(df, fill=True)
    assert full.columns == PROC_BOX.fieldNames()
    assert [f.dataType for f in full.schema] == [f.dataType for f in PROC_BOX]


def test_insert_ignore_keeps_stored_rows(spark):
    target = spark.createDataFrame([("a", 1)], "id string, n int")
    source = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "id string, n int")
    assert rows(merge.insert_ignore(target, source, ["id"])) == [("a", 1), ("b", 2)]


def test_slice_is_a_set_difference(spark):
    df = spark.createDataFrame([(i,) for i in (1, 1, 2, 2, 3, 3)], "n int")
    assert rows(merge.slice_except(df, 0, 4, ["n"], stored)) == [(1,), (2,)]
    assert rows(merge.slice_except(df, 3, 6, ["n"], stored)) == [(3,)]
    assert rows(merge.slice_except(df.limit(0), 0, 9, ["n"], stored)) == []


def test_a_deep_slice_needs_no_sort_in_one_task(spark):
    n = 300_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.lit("x").alias("v"))
    got = merge.slice_except(df, 200_000, 200_100, ["k"], stored)
    assert sorted(r.k for r in got.collect()) == list(range(200_000, 200_100))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan
    numbered = merge.numbered_rows(df, ["k"], stored)
    assert numbered.filter("_nr <> k + 1").isEmpty() and numbered.count() == n


def test_chunks_cover_the_table_once(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    chunks = [merge.hash_chunk(df, 4, i) for i in range(4)]
    assert rows(merge.union_groups(*chunks)) == rows(df)
    assert all(c.count() for c in chunks)


_ROWS = st.dictionaries(
    st.sampled_from("abcdef"),
    st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.text("xy", max_size=2))),
    max_size=6,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=_ROWS, source=_ROWS)
def test_upsert_is_a_dictionary_update(spark, target, source):
    schema = "id string, n int, v string"
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], schema)
    s = spark.createDataFrame([(k, *v) for k, v in source.items()], schema)
    merged = {**target, **source}
    assert rows(merge.upsert(t, s)) == sorted([(k, *v) for k, v in merged.items()], key=repr)
    partial = {k: (v[0], target[k][1] if k in target else None) for k, v in source.items()}
    merged = {**target, **partial}
    got = merge.upsert(t, s.select("id", "n"))
    assert rows(got) == sorted([(k, *v) for k, v in merged.items()], key=repr)
