"""Payload files written from the tables: all rows, in few files and folders."""

from __future__ import annotations

import datetime as dt
import gzip
from pathlib import Path

import pytest

from boxtrail import payload_files as pf
from boxtrail.queries import files as queries
from boxtrail.schemas import SIMPLE_ANIMAL
from boxtrail.sources import json_files as src

DAY = dt.datetime(1996, 1, 2)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Keys that repeat, lie far apart or are null."""
    root = tmp_path_factory.mktemp("tabelas")
    keys = [*range(50), 7, 7, None, None, *range(90_000, 90_020)]
    priorities = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None)
    orders = [(k, i % 9, "FOP"[i % 3], 10.5 + i, DAY, priorities[i % 6]) for i, k in enumerate(keys)]
    spark.createDataFrame(
        orders,
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string",
    ).write.parquet(f"{root}/orders.parquet")
    segments = ("MACHINERY", "FURNITURE", "BUILDING", None, "AUTOMOBILE")
    places = [7 if k == 7 else i for i, k in enumerate(keys)]  # repeated rows
    customers = [
        (k, f"C{i}", i % 25, i - 3.5, segments[i % 5])
        for i, k in zip(places, keys, strict=True)
    ]
    spark.createDataFrame(
        customers,
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    ).write.parquet(f"{root}/customer.parquet")
    return str(root)


def _rows(df):
    return sorted(df.collect(), key=repr)


def test_whole_arrays_hold_the_same_animals(spark, tables):
    got = _rows(queries.json_scan_whole(spark, tables))
    assert len(got) == 74 and got == _rows(queries.json_scan(spark, tables))


def test_whole_arrays_hold_one_flat_animal_per_key(spark, tables):
    got = _rows(queries.raw_animal_ingest_whole(spark, tables))
    assert len(got) >= 28 and got == _rows(queries.raw_animal_ingest(spark, tables).distinct())


def test_whole_envelopes_hold_the_same_animals(spark, tables):
    got = queries.json_envelope_scan_whole(spark, tables)
    lines = queries.animal_projection(spark, tables)
    both = [c for c in lines.columns if c in got.columns]
    assert _rows(got.select(both)) == _rows(lines.select(both))


@pytest.mark.parametrize(
    "build", [pf.simple_animal_arrays, pf.animal_envelope_objects, pf.flat_animal_arrays]
)
def test_whole_files_share_folders(spark, tables, monkeypatch, build):
    """Many files, a folder for ten runs of the key and for null keys, all compressed."""
    monkeypatch.setattr(pf, "PER_FILE", 5)
    path = Path(pf._written.__wrapped__("", spark, tables, build))
    found = [p for p in path.rglob("part-*") if not p.name.endswith(".crc")]
    assert {p.parent.name.split("=")[1] for p in found} == {
        "0", "1800", "__HIVE_DEFAULT_PARTITION__"
    }
    assert len(found) >= 15 and all(p.suffix == ".snappy" for p in found)


def test_documents_are_not_sorted_by_folder(spark, tables, conf):
    """Lines go to their folders as they come; the session's setting comes back."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    conf(**{name.replace(".", "__"): "3"})
    with pf._folders_at_once(spark):
        assert spark.conf.get(name) == str(pf.OPEN_FOLDERS)
    assert spark.conf.get(name) == "3"
    path = Path(pf._written.__wrapped__("", spark, tables, pf.animal_envelopes))
    found = list(path.rglob("part-*.json.snappy"))
    assert found and spark.conf.get(name) == "3"
    docs = spark.read.json(str(path))
    assert docs.count() == 74


def test_compressed_files_are_pending_json(spark, tmp_path):
    for name in ("a.JSON", "b.json"):
        (tmp_path / name).write_text('{"id": "1"}\n')
    for name in ("c.json.gz", "d.txt.gz"):
        with gzip.open(tmp_path / name, "wt") as out:
            out.write('{"id": "2"}\n')
    (tmp_path / "e.json.bak").write_text("{}")
    path, names = str(tmp_path), ["a.JSON", "b.json", "c.json.gz"]
    for listing in (src.pending_files, src.every_file):
        assert sorted(r.nome for r in listing(spark, path).collect()) == names
    got = src.scan_json(spark, path, SIMPLE_ANIMAL, multi_line=False)
    assert sorted(r.id for r in got.collect()) == ["1", "1", "2"]
