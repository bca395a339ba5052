"""Whole runs over a lake on disk, through the command line's entry."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from boxtrail import __main__ as cli
from boxtrail.plans import jobs
from boxtrail.schemas import BOX, STAGE_FLAGS
from boxtrail.sources.lake import lake_path
from data import DAY, ORIGIN, OTHER_DAY, PROPERTY, SALE, SCHEDULE, boxes, by_id, deboning, rows


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path / "lake")

    def put(name, df):
        df.write.mode("overwrite").parquet(lake_path(root, name))

    april = dt.date(2024, 4, 1)
    jobs.write_boxes(
        boxes(
            spark, {"id": "b1", "token_cliente": "007"},
            {"id": "b2", "token_cliente": "007", "nr_op_desossa": "OP2", "dt_producao": april},
            {"id": "b3", "token_cliente": "007", "nr_op_desossa": "OP3", "dt_producao": None},
            {"id": "b4", "token_cliente": "t1"},
        ).withColumn("qtde_pecas", F.lit(3)),
        root,
    )
    put("bt_desossa", deboning(
        spark, ("d1", "007", "U1", "OP1", "L1", DAY, "A1"),
        ("d2", "007", "U1", "OP2", "L2", OTHER_DAY, "A1"),
    ))
    put("bt_escala", spark.createDataFrame([("p1", DAY, "A1", "11", "F")], SCHEDULE))
    put("bt_animais", spark.createDataFrame([("a1", "007", "X", DAY, "A1")], ORIGIN))
    put("bt_propriedades", spark.createDataFrame([("p1", "Fazenda")], PROPERTY))
    jobs.write_sales(
        spark.createDataFrame(
            [
                ("s1", "007", 1, False, None, dt.datetime(2024, 4, 2), '[{"id":"b1"},{"id":"b2"}]'),
                ("s2", "007", 1, False, None, dt.datetime(2024, 4, 3), '[{"id":"b2"}]'),
                ("s3", "t1", 1, False, None, dt.datetime(2024, 4, 3), '[{"id":"b1"}]'),
                ("s4", "007", 2, False, None, dt.datetime(2024, 5, 3), '[{"id":"zz"}]'),
                ("s5", None, 3, False, None, dt.datetime(2024, 5, 3), '[{"id":"b1"}]'),
            ],
            SALE,
        ),
        root,
    )
    return root


def run(spark, lake, *args):
    cli.run(spark, cli.parser().parse_args(["--lake", lake, *args]))


def state(spark, lake):
    return by_id(
        jobs.read_state(spark, lake, "bt_caixas"), "flag_processamento", *STAGE_FLAGS, "flag_rastreavel"
    )


TRACED = {
    "b1": (True, True, True, True, True),
    "b2": (True, True, False, False, None),
    "b3": (False, False, None, None, None),
    "b4": (False, None, None, None, None),
}


def test_trace_all_periods_twice(spark, lake):
    run(spark, lake, "trace", "--token", "007")
    assert state(spark, lake) == TRACED
    proc = spark.read.parquet(lake_path(lake, "proc_caixas"))
    assert rows(proc, "id", "qtde_pecas", "nr_unidade_abate") == [("b1", 3, "A1"), ("b2", 3, "A1")]
    created = by_id(proc, "created_at")
    run(spark, lake, "trace", "--token", "007")
    assert state(spark, lake) == TRACED
    again = spark.read.parquet(lake_path(lake, "proc_caixas"))
    assert by_id(again, "created_at") == created


def test_trace_of_one_period_reads_and_writes_its_month(spark, lake):
    period = ["--dt-producao-de", "2024-03-01", "--dt-producao-ate", "2024-03-31"]
    run(spark, lake, "trace", "--token", "007", *period)
    got = state(spark, lake)
    assert got["b1"] == (True, True, True, True, None)
    assert got["b2"] == (False, None, None, None, None)
    assert len(got) == 4
    proc = spark.read.parquet(lake_path(lake, "proc_caixas"))
    assert rows(proc, "id") == [("b1",)]
    run(spark, lake, "trace", "--token", "007", "--dt-producao-de", "2024-04-01",
        "--dt-producao-ate", "2024-04-30")
    assert rows(spark.read.parquet(lake_path(lake, "proc_caixas")), "id") == [("b1",), ("b2",)]


def move_box(spark, lake, box, day):
    """Give a box another production day and open it again."""
    found = jobs.read_state(spark, lake, "bt_caixas")
    moved = F.col("id") == box
    found = found.drop(jobs.MONTH).withColumns({
        "dt_producao": F.when(moved, F.lit(day)).otherwise(F.col("dt_producao")),
        "flag_processamento": F.when(moved, False).otherwise(F.col("flag_processamento")),
    })
    held = jobs.materialise(found, "moved")
    jobs.write_partitioned(
        jobs.with_month(held, "dt_producao"), lake_path(lake, "bt_caixas"),
        jobs.STATE_PARTITIONS, mode="overwrite",
    )


@pytest.mark.parametrize("tenant", ["007", "a b/c=%2F"])
def test_a_box_that_moves_to_another_month_keeps_one_row(spark, lake, tenant):
    for table in ("bt_caixas", "bt_desossa", "bt_animais"):
        held = spark.read.schema(
            jobs.read_state(spark, lake, table).schema
        ).parquet(lake_path(lake, table)).replace("007", tenant, ["token_cliente"])
        held = jobs.materialise(held, table)
        held.write.mode("overwrite").partitionBy(
            *(jobs.STATE_PARTITIONS if table == "bt_caixas" else ())
        ).option("partitionOverwriteMode", "static").parquet(lake_path(lake, table))

    def proc():
        return jobs.read_state(spark, lake, "proc_caixas")

    run(spark, lake, "trace", "--token", tenant)
    assert rows(proc(), "id", jobs.MONTH) == [("b1", "202403"), ("b2", "202404")]
    created = by_id(proc(), "created_at")
    move_box(spark, lake, "b2", dt.date(2024, 3, 20))
    run(spark, lake, "trace", "--token", tenant, "--dt-producao-de", "2024-03-01",
        "--dt-producao-ate", "2024-03-31")
    assert rows(proc(), "id", jobs.MONTH) == [("b1", "202403"), ("b2", "202403")]
    assert by_id(proc(), "created_at") == created
    # a month left by one box and held by none is written again later
    move_box(spark, lake, "b1", dt.date(2024, 4, 20))
    run(spark, lake, "trace", "--token", tenant)
    assert rows(proc(), "id", jobs.MONTH) == [("b1", "202404"), ("b2", "202403")]


def test_an_id_stored_in_two_months_is_mended(spark, lake):
    run(spark, lake, "trace", "--token", "007")
    path = lake_path(lake, "proc_caixas")
    old = jobs.read_state(spark, lake, "proc_caixas").filter("id = 'b2'")
    old = jobs.materialise(old.withColumn(jobs.MONTH, F.lit("202401")), "old")
    jobs.replace_partitions(old, path)
    run(spark, lake, "trace", "--token", "007", "--reset-flags")
    got = jobs.read_state(spark, lake, "proc_caixas")
    assert rows(got, "id", jobs.MONTH) == [("b1", "202403"), ("b2", "202404")]


def test_months_of_other_boxes_are_not_rewritten(spark, lake):
    run(spark, lake, "trace", "--token", "007")
    found = jobs.read_state(spark, lake, "proc_caixas")
    held = {m: f for m, f in found.select(jobs.MONTH, "_metadata.file_path").collect()}
    run(spark, lake, "trace", "--token", "007", "--reset-flags", "--dt-producao-de", "2024-03-01",
        "--dt-producao-ate", "2024-03-31")
    found = jobs.read_state(spark, lake, "proc_caixas")
    now = {m: f for m, f in found.select(jobs.MONTH, "_metadata.file_path").collect()}
    assert now["202404"] == held["202404"] and now["202403"] != held["202403"]


def test_single_modes(spark, lake):
    run(spark, lake, "trace", "--token", "007", "--modo", "desossa")
    assert state(spark, lake)["b1"] == (False, True, None, None, None)
    run(spark, lake, "trace", "--token", "007", "--modo", "propriedades")
    run(spark, lake, "trace", "--token", "007", "--modo", "proc-caixas")
    assert state(spark, lake)["b1"] == (True, True, True, True, None)
    assert spark.read.parquet(lake_path(lake, "proc_caixas")).count() == 2
    run(spark, lake, "trace", "--token", "007", "--reset-flags", "--no-update-rastreavel")
    assert state(spark, lake)["b1"] == (True, True, True, True, None)


def test_other_tenants_are_not_rewritten(spark, lake, tmp_path):
    folder = tmp_path / "lake" / "bt_caixas" / "token_cliente=t1"
    before = {p.name for p in folder.rglob("*.parquet")}
    run(spark, lake, "trace", "--token", "007")
    assert {p.name for p in folder.rglob("*.parquet")} == before


def test_rows_without_a_day_keep_their_place(spark, lake):
    run(spark, lake, "trace", "--token", "007")
    spark.read.parquet(lake_path(lake, "proc_caixas"))
    deb = deboning(spark, ("d3", "007", "U1", "OP3", "L3", DAY, "A1"))
    deb.write.mode("append").parquet(lake_path(lake, "bt_desossa"))
    run(spark, lake, "trace", "--token", "007")
    run(spark, lake, "trace", "--token", "007", "--modo", "proc-caixas")
    proc = spark.read.parquet(lake_path(lake, "proc_caixas"))
    assert rows(proc, "id") == [("b1",), ("b2",), ("b3",)]


def test_sales_run_twice(spark, lake):
    run(spark, lake, "trace", "--token", "007")
    for _ in range(2):
        run(spark, lake, "sales", "--token", "007", "--limite", "0")
        read = lambda name: spark.read.parquet(lake_path(lake, name))
        assert rows(read("proc_registro_venda"), "id", "destino_pais") == [("s1", "Brasil")]
        assert rows(read("proc_propriedades"), "dt_abate", "prod_cpf_cnpj") == [(DAY, "11")]
        assert rows(read("proc_animais"), "id", "codigo") == [("a1", "X")]
        assert rows(read("proc_cx_venda_propriedade")) == [("p1", "s1")]
        sales = jobs.read_state(spark, lake, "bt_registro_venda")
        assert by_id(sales, "flag_processada") == {
            "s1": True, "s2": False, "s3": False, "s4": False, "s5": False
        }


def test_sales_run_rewrites_only_months_with_a_traced_sale(spark, lake, tmp_path):
    run(spark, lake, "trace", "--token", "007")
    folder = tmp_path / "lake" / "bt_registro_venda"
    files = lambda: {p.relative_to(folder) for p in folder.rglob("*.parquet")}
    before = files()
    run(spark, lake, "sales", "--token", "007")
    changed = {str(p.parent) for p in files() ^ before}
    assert changed == {"token_cliente=007/ano_mes=202404"}


def test_sales_of_a_group_without_a_tenant(spark, lake):
    run(spark, lake, "trace", "--token", "007")
    run(spark, lake, "sales", "--grupo", "3")
    sales = jobs.read_state(spark, lake, "bt_registro_venda")
    assert by_id(sales, "flag_processada") == {
        "s1": False, "s2": False, "s3": False, "s4": False, "s5": True
    }


def test_ingest_and_reports(spark, lake, tmp_path, capsys):
    pending = tmp_path / "pending"
    pending.mkdir()
    (pending / "a.json").write_text(json.dumps({"animais": [{"id": "1", "raca": 2}, {"raca": 3}]}))
    args = ["ingest", "--tipo", "animais", "--pending", str(pending)]
    run(spark, str(tmp_path / "new"), *args)
    log = spark.read.parquet(str(tmp_path / "new" / "log_processamento"))
    assert sorted(r.status for r in log.collect()) == ["finalizado", "iniciado", "sucesso"]
    (pending / "b.json").write_text(json.dumps({"animais": [{"id": "2"}]}))
    run(spark, str(tmp_path / "new"), *args)
    run(spark, str(tmp_path / "new"), *args)
    log = spark.read.parquet(str(tmp_path / "new" / "log_processamento"))
    assert rows(log.filter("status = 'sucesso'"), "nome_arquivo", "registros_invalidos") == [
        ("a.json", 1), ("b.json", 0)
    ]
    # start and end of three runs, the last with nothing to load, and two files
    assert log.count() == 8
    animals = spark.read.parquet(str(tmp_path / "new" / "bt_animais"))
    assert sorted(r.id for r in animals.collect()) == ["1", "2"]
    capsys.readouterr()
    run(spark, str(tmp_path / "new"), "log")
    run(spark, lake, "status", "--token", "007")
    shown = capsys.readouterr().out
    assert "b.json" in shown and "Outros casos" in shown and "caixas_completas" in shown


def test_arguments(spark, lake):
    with pytest.raises(ValueError):
        run(spark, lake, "trace", "--token", "007", "--dt-producao-de", "2024-03-01")
    with pytest.raises(ValueError):
        run(spark, lake, "sales")
    with pytest.raises(ValueError):
        run(spark, lake, "ingest", "--tipo", "abates", "--pending", "x")
    assert jobs.with_columns_of(spark.range(1), BOX).columns == ["id", *BOX.fieldNames()[1:]]


def test_import_and_export(spark, lake, tmp_path, monkeypatch):
    """The database is replaced by a frame and a recorder."""
    told = {}
    stored = boxes(spark, {"id": "n1", "token_cliente": "009"})

    def read_table(session, connection, table, schema, **options):  # reads the current frame
        told["read"] = (connection["url"], table, schema, options["split"])
        return stored

    def write_table(df, connection, table, mode, schema, **options):
        told["write"] = (sorted(r.id for r in df.collect()), df.columns, table, mode, options)

    monkeypatch.setattr(jobs.jdbc, "read_table", read_table)
    monkeypatch.setattr(jobs.jdbc, "write_table", write_table)
    options = tmp_path / "options.json"
    options.write_text('{"url": "jdbc:x"}')
    new = str(tmp_path / "new")
    args = ["--options", str(options), "--table", "bt_caixas"]
    run(spark, new, "import", *args, "--split", "dt_producao", "2024-01-01", "2025-01-01", "12")
    split = jobs.jdbc.Split("dt_producao", "2024-01-01", "2025-01-01", 12)
    assert told["read"] == ("jdbc:x", "bt_caixas", "public", split)
    assert (tmp_path / "new" / "bt_caixas" / "token_cliente=009" / "ano_mes=202403").is_dir()
    stored = boxes(spark, {"id": "n1", "token_cliente": "010"})
    run(spark, new, "import", *args)
    assert not (tmp_path / "new" / "bt_caixas" / "token_cliente=009").exists()
    run(spark, new, "export", *args, "--connections", "4")
    ids, columns, table, mode, more = told["write"]
    assert (ids, table, mode, more) == (["n1"], "bt_caixas", "append", {"connections": 4})
    assert sorted(columns) == sorted(BOX.fieldNames())


# --- ingest: files without rows, failed runs, streams apart ---------------------


def put_json(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))


def log_of(spark, root):
    return spark.read.parquet(f"{root}/log_processamento")


@pytest.mark.parametrize("archived", [False, True])
def test_files_without_rows_are_logged_once(spark, tmp_path, archived):
    pending, root = tmp_path / "pending", str(tmp_path / "new")
    put_json(pending, "good.json", {"animais": [{"id": "1"}]})
    put_json(pending, "list.json", "[]")
    put_json(pending, "none.json", {"animais": []})
    put_json(pending, "other.json", {"outros": [1]})
    put_json(pending, "zero.json", "")
    put_json(pending, "bad.json", '{"animais": [')
    args = ["ingest", "--tipo", "animais", "--pending", str(pending)]
    if archived:
        args += ["--archive", str(tmp_path / "done")]
    for _ in range(2):
        run(spark, root, *args)
    files = rows(log_of(spark, root).filter("nome_arquivo IS NOT NULL"), "nome_arquivo", "status")
    assert files == [
        ("bad.json", "erro"), ("good.json", "sucesso"), ("list.json", "erro"),
        ("none.json", "erro"), ("other.json", "erro"), ("zero.json", "erro"),
    ]
    book = spark.read.parquet(f"{root}/arquivos/animais")
    assert (book.count(), book.filter("erro = 'nenhum registro'").count()) == (6, 4)
    put_json(pending, "late.json", "")
    run(spark, root, *args)
    assert spark.read.parquet(f"{root}/arquivos/animais").count() == 7


def test_a_failed_run_is_logged_and_its_list_kept(spark, tmp_path, monkeypatch):
    pending, root = tmp_path / "pending", str(tmp_path / "new")
    put_json(pending, "good.json", {"animais": [{"id": "1"}]})
    put_json(pending, "zero.json", "")
    args = ["ingest", "--tipo", "animais", "--pending", str(pending)]
    whole = jobs._note_silent

    def broken(*_):
        raise OSError("disco cheio")

    monkeypatch.setattr(jobs, "_note_silent", broken)
    with pytest.raises(OSError):
        run(spark, root, *args)
    log = {(r.status, r.nome_arquivo): r for r in log_of(spark, root).collect()}
    assert set(log) == {("iniciado", None), ("erro", None), ("sucesso", "good.json")}
    details = json.loads(log["erro", None].detalhes)
    assert details == {"exception_type": "OSError", "exception_message": "disco cheio"}
    assert log["erro", None].duracao_ms >= 0
    # the file may be gone when the next run lists the folder
    monkeypatch.setattr(jobs, "_note_silent", whole)
    (pending / "zero.json").unlink()
    run(spark, root, *args)
    files = rows(log_of(spark, root).filter("nome_arquivo IS NOT NULL"), "nome_arquivo", "status")
    assert files == [("good.json", "sucesso"), ("zero.json", "erro")]
    assert spark.read.parquet(f"{root}/bt_animais").count() == 1


def test_a_stream_that_fails_logs_its_error(spark, tmp_path, monkeypatch):
    pending, root = tmp_path / "pending", str(tmp_path / "new")
    put_json(pending, "a.json", [{"nr_unidade_abate": "U1"}])
    payload = jobs.Payload(
        "abates", "bt_abates", *cli.ingest.slaughter_records("t1")[2:5],
        lambda df: df.select(F.raise_error(F.lit("linha ruim")).alias("x")), tenant="t1",
    )
    with pytest.raises(Exception, match="linha ruim"):
        jobs.run_ingest(spark, root, payload, str(pending))
    got = rows(log_of(spark, root), "status")
    assert got == [("erro",), ("iniciado",)]
    # a failed run of one tenant does not hold up another's
    run(spark, root, "ingest", "--tipo", "abates", "--token", "t2", "--pending", str(pending))
    assert rows(spark.read.parquet(f"{root}/bt_abates"), "token_cliente") == [("t2",)]


def test_a_lost_checkpoint_replaces_nothing(spark, tmp_path):
    pending, root = tmp_path / "pending", tmp_path / "new"
    put_json(pending, "a.json", {"animais": [{"id": "1"}]})
    args = ["ingest", "--tipo", "animais", "--pending", str(pending)]
    run(spark, str(root), *args)
    (root / "checkpoint").rename(tmp_path / "lost")
    put_json(pending, "b.json", {"animais": [{"id": "2"}]})
    run(spark, str(root), *args)
    assert rows(spark.read.parquet(f"{root}/bt_animais"), "id") == [("1",), ("2",)]
    book = spark.read.parquet(f"{root}/arquivos/animais")
    assert book.count() == 2 and len(list((root / "bt_animais").glob("lote_carga=*"))) == 2


def test_from_files_to_traced_boxes(spark, tmp_path):
    """Schedules and slaughter records loaded from files are what boxes link to."""
    root = str(tmp_path / "new")
    put_json(tmp_path / "escalas", "e.json", [{
        "dt_abate": str(DAY), "nr_unidade_abate": "A1", "nr_lote_abate": 4, "prod_cpf_cnpj": "11",
        "caminhoes": [{"placa_veiculo": "P1"}, {"placa_veiculo": "P2"}],
        "nfs": [{"numero": "N1", "itens": [{"qtde": 2}]}],
    }])
    put_json(tmp_path / "abates", "a.json", [{
        "dt_abate": str(DAY), "nr_unidade_abate": "A1", "lote_abate": 4, "nr_identificacao": "X9",
    }])
    for kind in ("escalas", "abates"):
        run(spark, root, "ingest", "--tipo", kind, "--token", "007", "--pending", str(tmp_path / kind))
    stored = jobs.read_state(spark, root, "escalas")
    assert rows(stored.groupBy("parte").count()) == [
        ("caminhao", 2), ("escala", 1), ("gta", 1), ("item", 1), ("nf", 1)
    ]
    jobs.write_boxes(boxes(
        spark, {"id": "b1", "token_cliente": "007"},
        {"id": "b2", "token_cliente": "007", "nr_op_desossa": "OP3"},
    ), root)
    deboning(spark, ("d1", "007", "U1", "OP1", "L1", DAY, "A1")).write.parquet(
        lake_path(root, "bt_desossa")
    )
    run(spark, root, "trace", "--token", "007")
    assert state(spark, root) == {
        "b1": (True, True, True, True, True), "b2": (False, False, None, None, None)
    }
    box = jobs.read_state(spark, root, "bt_caixas").filter("id = 'b1'").first()
    assert json.loads(box.json_propriedades)["prod_cpf_cnpj"] == "11"
    assert json.loads(box.json_animais)["codigo"] == "X9"
