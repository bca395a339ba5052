"""The lake, listings, and JDBC options (no database is started)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boxtrail.sources import jdbc, lake, listing
from data import rows

CONNECTION = {"url": "jdbc:x://host/db", "user": "u", "password": "p", "driver": "d"}


@pytest.mark.parametrize("fmt", ["csv", "CSV", "parquet", "json"])
def test_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([("001", 1.5, None), ("b", 2.0, "x")], "id string, n double, v string")
    lake.lake_write(df, str(tmp_path), "raw/t", fmt)
    lake.lake_write(df, str(tmp_path), "raw/t", fmt)
    got = lake.lake_read(spark, str(tmp_path), "raw/t", fmt, schema=df.schema)
    assert rows(got) == rows(df)
    assert lake.lake_read(
        spark, str(tmp_path), "raw/t", fmt, schema=df.schema, columns=["id"]
    ).columns == ["id"]


def test_csv_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;x\n2;y\n")
    got = lake.lake_read(spark, str(tmp_path), "a.csv", "csv", schema="a int, b string", sep=";")
    assert rows(got) == [(1, "x"), (2, "y")]


def test_unknown_format_and_missing_path(spark, tmp_path):
    df = spark.range(1)
    with pytest.raises(ValueError):
        lake.lake_write(df, str(tmp_path), "t", "avro")
    with pytest.raises(ValueError):
        lake.lake_read(spark, str(tmp_path), "t", "xml")
    with pytest.raises(FileNotFoundError):
        lake.lake_read(spark, str(tmp_path), "nothing")


def test_columns_are_pruned_in_the_scan(spark, tmp_path):
    lake.lake_write(spark.range(5).withColumn("wide", F.lit("x")), str(tmp_path), "t", "parquet")
    df = lake.lake_read(spark, str(tmp_path), "t", columns=["id"])
    assert "ReadSchema: struct<id:bigint>" in df._jdf.queryExecution().executedPlan().toString()


def test_partitions_are_listed_pruned_and_replaced(spark, tmp_path):
    path = str(tmp_path / "ds")
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 2)), (2, dt.date(2024, 1, 3)), (3, dt.date(2025, 1, 2))],
        "id int, dia_venda date",
    )
    lake.write_partitioned(lake.by_day(df, "dia_venda"), path)
    assert (tmp_path / "ds" / "ano=2024" / "mes=1" / "dia=2").is_dir()
    assert rows(lake.list_partitions(spark, path)) == [(2024, 1, 2), (2024, 1, 3), (2025, 1, 2)]
    one = spark.read.parquet(path).filter("ano = 2025")
    assert "PartitionFilters: [isnotnull(ano" in one._jdf.queryExecution().executedPlan().toString()
    new = lake.by_day(df.filter("id = 3").withColumn("id", F.lit(9)), "dia_venda")
    lake.write_partitioned(new, path, mode="overwrite", dynamic=True)
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,), (9,)]


def test_inventory_searches_below_the_root(spark, tmp_path):
    root = tmp_path / "raiz.a"
    for name in ("raw/animais/x.json", "raw/escalas/y.json", "final/z.csv"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("12345")
    everything = lake.file_inventory(spark, str(root))
    assert rows(everything, "caminho", "tamanho") == [
        ("final/z.csv", 5), ("raw/animais/x.json", 5), ("raw/escalas/y.json", 5)
    ]
    assert rows(lake.file_inventory(spark, str(root), "raw"), "nome") == [("x.json",), ("y.json",)]
    assert rows(lake.file_inventory(spark, str(root), search="escala"), "nome") == [("y.json",)]
    assert lake.file_inventory(spark, str(root), search="raiz").count() == 0


class Recorder:
    """Stands in for a reader or writer and keeps what it was told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **values):
        self.told |= values
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def load(self):
        return self.told

    def save(self):
        self.told["saved"] = True

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "dbtable": table, "predicates": predicates, **properties}


class FakeSpark:
    @property
    def read(self):
        return Recorder()


class FakeFrame:
    def __init__(self):
        self.write = Recorder()


def test_table_read_is_split():
    got = jdbc.read_table(
        FakeSpark(), CONNECTION, "bt_caixas", "dados", split=jdbc.Split("id", "1", "100", 8)
    )
    assert got["dbtable"] == "dados.bt_caixas" and got["format"] == "jdbc"
    assert (got["partitionColumn"], got["numPartitions"]) == ("id", "8")
    assert (got["lowerBound"], got["upperBound"], got["user"]) == ("1", "100", "u")


def test_table_read_by_predicates():
    parts = ["token = 'a'", "token = 'b'"]
    got = jdbc.read_table(FakeSpark(), CONNECTION, "t", predicates=parts)
    assert got["predicates"] == parts and got["dbtable"] == "t" and got["url"] == CONNECTION["url"]


def test_query_read():
    got = jdbc.read_query(FakeSpark(), CONNECTION, "SELECT 1")
    assert got["query"] == "SELECT 1" and "dbtable" not in got
    got = jdbc.read_query(FakeSpark(), CONNECTION, "SELECT 1", split=jdbc.Split("d", "a", "b", 2))
    assert got["dbtable"] == "(SELECT 1) AS q" and "query" not in got


def test_table_write():
    df = FakeFrame()
    jdbc.write_table(df, CONNECTION, "t", "overwrite", connections=4)
    told = df.write.told
    assert (told["mode"], told["batchsize"], told["truncate"]) == ("overwrite", 1000, "false")
    assert told["numPartitions"] == 4 and told["saved"]
    with pytest.raises(ValueError):
        jdbc.write_table(FakeFrame(), CONNECTION, "t", "upsert")


def test_store_switches_between_lake_and_database(spark, tmp_path):
    store = jdbc.Store(root=str(tmp_path))
    store.append(spark.range(2), "t")
    store.append(spark.range(2), "t")
    assert store.read(spark, "t").count() == 4
    assert jdbc.Store(connection=CONNECTION).read(FakeSpark(), "t")["dbtable"] == "t"
    with pytest.raises(ValueError):
        jdbc.Store().read(spark, "t")


def test_bound_parameters_are_values_not_text(spark):
    df = spark.createDataFrame([("a",), ("' OR '1'='1",)], "id string")
    got = jdbc.bound_query(
        spark, "SELECT * FROM {t} WHERE id = :id", {"id": "' OR '1'='1"}, t=df
    )
    assert rows(got) == [("' OR '1'='1",)]


def test_partitions_are_read_from_folder_names(spark, tmp_path):
    df = spark.createDataFrame(
        [(2024, "a b", 1), (2024, "x/y", 2), (2025, None, 3)], "ano int, lote string, v int"
    )
    path = str(tmp_path / "t")
    df.write.partitionBy("ano", "lote").parquet(path)
    got = listing.partition_folders(spark, path, {"ano": "int", "lote": "string"})
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == [(2024, "a b"), (2024, "x/y"), (2025, None)]
    assert rows(lake.list_partitions(spark, path, ("ano",))) == [(2024,), (2025,)]
    assert lake.list_partitions(spark, path, ("mes",)).count() == 0
