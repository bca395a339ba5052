"""Every registered query against its SQL, over the smallest tables."""

from __future__ import annotations

import ast
import inspect
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from boxtrail.operators import reports
from boxtrail.queries import ORACLES, QUERIES, load_all
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"table_distinct_counts"}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_distinct_counts_are_close(spark, con):
    got = QUERIES["table_distinct_counts"](spark, SF).collect()
    assert {r.tabela for r in got} == {r[0] for r in con.execute("SHOW TABLES").fetchall()}
    for r in got:
        exact = con.execute(f"SELECT count(DISTINCT {r.coluna}) FROM {r.tabela}").fetchone()[0]
        assert abs(r.n_distintos_aprox - exact) <= 0.03 * exact, r


def test_sketches_of_parts_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 30_000).alias("v"))
    parts = [
        reports.distinct_sketches({"t": df.filter(F.col("v") % 2 == i)}) for i in (0, 1, 1)
    ]
    merged = reports.distinct_counts(parts[0].union(parts[1]).union(parts[2])).first()
    assert abs(merged.n_distintos_aprox - 30_000) < 900


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_sql(spark, con, key):
    assert compare(QUERIES[key](spark, SF), con, ORACLES[key]) == []


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_operators_never_collect():
    """No rows on the driver in the code that runs on data."""
    package = Path(inspect.getfile(entry)).parent / "boxtrail"
    for path in [*package.glob("operators/*.py"), *package.glob("functions/*.py"),
                 *package.glob("sources/*.py"), *package.glob("plans/trace.py"),
                 *package.glob("plans/sale_trace.py"), *package.glob("plans/ingest.py")]:
        calls = {
            node.func.attr
            for node in ast.walk(ast.parse(path.read_text()))
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute)
        }
        assert not calls & {"collect", "toPandas", "localCheckpoint", "crossJoin", "first"}, path
