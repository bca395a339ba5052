"""Payload files: scans, validation, mapping, the ledger and the stream."""

from __future__ import annotations

import datetime as dt
import gzip
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from boxtrail.functions.payload import iso_timestamp, json_id
from boxtrail.operators import ledger, payloads, validate
from boxtrail.plans import ingest
from boxtrail.schemas import ANIMAL, RAW_ANIMAL, RUN_LOG, SCHEDULE, SIMPLE_ANIMAL, SLAUGHTER_MAPPING
from boxtrail.sources import json_files as src
from boxtrail.streaming.ingest_stream import read_pending, start_ingest_stream
from data import rows


def animal(ident="1", **more):
    return {
        "id": ident, "codigo_fazenda": "f", "raca": 7, "origem": 3, "peso_nascimento": 0,
        "peso_entrada": 88.25, "data_nascimento": "2021-03-04",
        "data_entrada": "2022-05-06T07:08:09Z", "data_criacao": "ontem", "data_exclusao": None,
        "classificacao": {"id": 4, "descricao": "boa"}, "observacoes": {},
        "pelagem": None, "codigo_rastreabilidade": "R-77-b", **more,
    }


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content, indent=2)
    (folder / name).write_text(text)
    return str(folder)


def names(df):
    return {r.arquivo.rsplit("/", 1)[-1]: r for r in df.collect()}


# --- scans ------------------------------------------------------------------


def test_listing_takes_json_files_of_any_case_and_no_folders(spark, tmp_path):
    put(tmp_path, "a.json", {})
    put(tmp_path, "b.JSON", {})
    put(tmp_path, "c.txt", "x")
    put(tmp_path / "sub", "d.json", {})
    got = src.pending_files(spark, str(tmp_path))
    assert sorted(r.nome for r in got.collect()) == ["a.json", "b.JSON"]
    assert got.filter("tamanho > 0 AND modificado_em IS NOT NULL").count() == 2


def test_every_file_adds_those_without_a_byte(spark, tmp_path):
    """Names come out as scans write them, whatever their characters."""
    put(tmp_path, "a b%é+[1].json", {})
    put(tmp_path, "zero.JSON", "")
    put(tmp_path, ".hidden.json", "{}")
    put(tmp_path, "c.txt", "x")
    put(tmp_path / "lote=x y" / "dia=1", "d.json", {})
    put(tmp_path / "lote=x y" / "_tmp", "e.json", {})
    put(tmp_path / "lote=z" / "dia=2", "none.json", "")
    path = str(tmp_path)
    listed = src.every_file(spark, path)
    sizes = {r.nome: r.tamanho for r in listed.collect()}
    assert sizes == {"a b%é+[1].json": 2, "zero.JSON": 0, "d.json": 2, "none.json": 0}
    found = {r[0] for r in src.list_files(spark, f"{path}/lote=x y", src.JSON_GLOB).collect()}
    found |= {r[0] for r in src.scan_json(
        spark, f"{path}/a b%é+?1].json", RAW_ANIMAL, diagnostics=True).select(src.FILE).collect()}
    assert found == {r[0] for r in listed.filter("tamanho > 0").select(src.FILE).collect()}


def test_pretty_printed_object_is_one_row(spark, tmp_path):
    doc = {
        "id_animal": "Q-17", "data_nascimento": "2019-11-02", "peso_nascimento": 41,
        "data_entrada": "2020-01-09",
        "dados_adicionais": {"vacinado": False, "vacinas": [{"data": "2019-12-24"}, {"tipo": "B"}]},
    }
    path = put(tmp_path, "a.json", doc)
    got = src.scan_json(spark, path, RAW_ANIMAL).collect()
    assert len(got) == 1
    assert (got[0].data_nascimento, got[0].peso_nascimento) == (dt.date(2019, 11, 2), 41.0)
    assert got[0].data_saida is None and got[0].dados_adicionais.vacinado is False
    doses = got[0].dados_adicionais.vacinas
    assert [(d.tipo, d.data) for d in doses] == [(None, dt.date(2019, 12, 24)), ("B", None)]


def test_array_gives_a_row_per_element_and_text_fields_keep_nested_json(spark, tmp_path):
    path = put(tmp_path, "a.json", [{"id": "1", "status": {"a": [1, "x"]}}, {"id": "2"}])
    got = src.scan_json(spark, path, SIMPLE_ANIMAL).orderBy("id").collect()
    assert [r.id for r in got] == ["1", "2"]
    assert json.loads(got[0].status) == {"a": [1, "x"]} and got[1].status is None


def test_envelope_with_and_without_its_key(spark, tmp_path):
    put(tmp_path, "a.json", {"animais": [animal("1"), animal("2")]})
    put(tmp_path, "b.json", {"outros": []})
    path = put(tmp_path, "c.json", {"animais": []})
    got = src.scan_envelope(spark, path, ingest.ANIMAL_RAW)
    assert sorted(r.id for r in got.collect()) == ["1", "2"]


def bytes_read(spark):
    found = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in found if s.getScheme() == "file")


def test_array_that_does_not_fit_is_read_once(spark, tmp_path):
    """Not once for each of its rows, whose streams would fill the task's memory."""
    docs = [{"id_animal": str(i), "peso_nascimento": 3 if i % 2 else "n/a"} for i in range(200)]
    path = put(tmp_path, "a.json", docs)
    text = (tmp_path / "a.json").read_text()
    before = bytes_read(spark)
    got = src.scan_json(spark, path, RAW_ANIMAL, diagnostics=True).collect()
    assert sorted(int(r.id_animal) for r in got) == list(range(200))
    assert {r[src.CORRUPT] for r in got} == {text}
    assert 0 < bytes_read(spark) - before < 3 * len(text)


@pytest.mark.parametrize("as_line", [src.AS_ONE_LINE, 60, 0])
def test_whole_files_are_read_as_spark_reads_them(spark, tmp_path, conf, monkeypatch, as_line):
    """Broken, odd and cut files, in any encoding and size, also where tasks begin within one."""
    monkeypatch.setattr(src, "AS_ONE_LINE", as_line)
    good, bad = {"id_animal": "1é", "peso_nascimento": 3}, {"id_animal": "2", "peso_nascimento": "x"}
    both = json.dumps([good, bad], indent=1)
    one = json.dumps([good], indent=1, ensure_ascii=False)
    texts = [
        both, one, json.dumps(good, indent=1), json.dumps(bad) + "\r\n", both[:-9], one[:-4], "", " \n",
        "[]", "{}", "[{}, {}]", "null", "[null]", "7", "[1]", f"[{one}]", "xyz", f"{one}\n{both}",
        one + " xyz", f"{json.dumps(good)}\n{json.dumps(bad)}", '[{"id_animal": "a\nb"}]',
    ]
    raw = [t.encode() for t in texts]
    raw += [c.encode(code) for c in (both, one) for code in ("utf-16", "utf-32-be", "latin-1")]
    raw += ["\ufeff".encode() + one.encode(), one.encode() + b"\0\0"]
    for i, content in enumerate(raw):
        (tmp_path / f"{i}.json").write_bytes(content)
        with gzip.open(tmp_path / f"z{i}.json.gz", "wb") as out:
            out.write(content)
    path = str(tmp_path)
    reader = spark.read.schema(src.with_corrupt(RAW_ANIMAL)).option("multiLine", True)
    want = rows(reader.json(path).withColumn(src.FILE, F.col("_metadata.file_path")))
    conf(spark__sql__files__maxPartitionBytes="40", spark__sql__files__openCostInBytes="1")
    got = src.scan_json(spark, path, RAW_ANIMAL, diagnostics=True)
    assert len(want) > 2 * len(raw) and rows(got) == want


# --- projections ------------------------------------------------------------


def test_animal_has_33_typed_columns(spark, tmp_path):
    path = put(tmp_path, "a.json", {"animais": [animal(observacoes="texto", geracao=[1])]})
    df = payloads.animal_projection(src.scan_envelope(spark, path, ingest.ANIMAL_RAW))
    assert len(df.columns) == 33
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ANIMAL]
    r = df.first()
    assert json.loads(r.classificacao) == {"id": 4, "descricao": "boa"}
    assert (r.observacoes, r.geracao) == ('"texto"', "[1]")
    assert (r.pelagem, r.dados_adicionais) == ("{}", "{}")
    assert (r.raca, r.origem, r.peso_nascimento, r.peso_entrada) == (7, 3, 0.0, 88.25)
    assert r.data_nascimento == dt.datetime(2021, 3, 4)
    assert r.data_entrada == dt.datetime(2022, 5, 6, 7, 8, 9)
    assert r.data_criacao is None and r.data_exclusao is None
    assert r.codigo_rastreabilidade == "R-77-b"


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-01-02", dt.datetime(2024, 1, 2)),
        ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05.250000", dt.datetime(2024, 1, 2, 3, 4, 5, 250000)),
        ("2024-01-02 03:04", dt.datetime(2024, 1, 2, 3, 4)),
        ("2024-01-02T03:04:05-03:00", dt.datetime(2024, 1, 2, 6, 4, 5)),
        ("2024", None), ("", None), (None, None), ("2024-13-01", None), ("2024-01-02 lixo", None),
        ("data-invalida", None),
    ],
)
def test_lenient_dates(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(iso_timestamp(F.col("t"))).first()[0] == want


def test_json_id_of_numbers_and_null(spark):
    df = spark.createDataFrame([('{"id":7}',), ('{"id":null}',), ("x",), (None,)], "j string")
    assert [r[0] for r in df.select(json_id(F.col("j"))).collect()] == ["7", None, None, None]


def test_slaughter_record_maps_to_31_columns(spark, tmp_path):
    record = {
        "habilitacoes_etiqueta": None, "json_certificado": {"a": 1}, "dt_nascimento": "2020-02-03",
        "valor_ph": 5.4, "dt_fechamento_camera_abate": "2024-01-01T10:00:00", "dt_abate": "2024-01-01",
        "lote_abate": 12, "motivos_dif": [1], "nr_banda": 2, "peso_carcaca": 250.123456,
        "flag_contusao": True, "nr_unidade_abate": "007", "cod_barra_abate": "0099",
    }
    other = {"dt_nascimento": "ontem", "nr_banda": 99999, "habilitacoes_etiqueta": {"x": 1}}
    path = put(tmp_path, "a.json", [record, other])
    payload = ingest.slaughter_records("t9")
    got = ingest.ingest(spark, path, payload).rows
    assert got.columns == [target for target, _, _ in SLAUGHTER_MAPPING] and len(got.columns) == 31
    assert dict(got.dtypes) == {target: kind for target, _, kind in SLAUGHTER_MAPPING}
    a, b = got.orderBy(F.col("nr_unidade_abate").desc_nulls_last()).collect()
    assert a.json_habilitacoes == "{}"
    assert (json.loads(a.json_certificado), json.loads(a.json_motivos_dif)) == ({"a": 1}, [1])
    assert (a.nr_lote_abate, a.nr_banda, a.flag_contusao) == (12, 2, 1)
    assert a.dt_nascimento == dt.date(2020, 2, 3)
    assert a.peso_carcaca == Decimal("250.123456")
    assert (a.nr_unidade_abate, a.codigo_barra_etiqueta, a.token_cliente) == ("007", "0099", "t9")
    assert a.created_at is not None and a.created_at == a.updated_at
    assert (b.dt_nascimento, b.nr_banda, b.flag_contusao) == (None, None, None)
    assert json.loads(b.json_habilitacoes) == {"x": 1}


# --- validation and ledger --------------------------------------------------


def test_bad_rows_are_kept_apart_with_their_reasons(spark, tmp_path):
    good, bad = animal("1"), animal(None, raca="abc", peso_atual="x")
    path = put(tmp_path, "a.json", {"animais": [good, bad]})
    run = ingest.ingest(spark, path, ingest.animals())
    assert [r.id for r in run.rows.collect()] == ["1"]
    assert sorted(run.rejected.first()["_errors"]) == [
        "id ausente", "peso_atual invalido", "raca invalido"
    ]
    assert rows(run.stats) == [(1, 1, 0)]


def test_ledger_of_good_bad_empty_and_broken_files(spark, tmp_path):
    put(tmp_path, "good.json", {"animais": [animal("1")]})
    put(tmp_path, "mixed.json", {"animais": [animal("2"), animal(None)]})
    put(tmp_path, "none.json", {"animais": []})
    put(tmp_path, "empty.json", "")
    path = put(tmp_path, "broken.json", '{"animais": [')
    run = ingest.ingest(spark, path, ingest.animals())
    got = {k: (r.n_rows, r.n_bad, r.status, r.erro) for k, r in names(run.ledger).items()}
    assert got == {
        "good.json": (1, 0, "sucesso", None),
        "mixed.json": (2, 1, "sucesso", None),
        "none.json": (0, 0, "erro", "nenhum registro"),
        "empty.json": (0, 0, "erro", "nenhum registro"),
        "broken.json": (1, 1, "erro", "json invalido; id ausente"),
    }
    assert rows(run.stats) == [(5, 2, 3)]
    strict = ingest.ingest(spark, path, ingest.animals(), strict=True)
    assert [r.id for r in strict.rows.collect()] == ["1"]
    assert rows(strict.stats) == [(5, 1, 4)]


def test_loaded_files_are_left_out(spark, tmp_path):
    path = put(tmp_path, "a.json", {"animais": [animal("1")]})
    first = ingest.ingest(spark, path, ingest.animals()).ledger
    done = spark.createDataFrame(first.collect(), first.schema)
    put(tmp_path, "b.json", {"animais": [animal("2")]})
    again = ingest.ingest(spark, path, ingest.animals(), loaded=done)
    assert [r.id for r in again.rows.collect()] == ["2"]
    assert list(names(again.ledger)) == ["b.json"]


def test_simple_animals_keep_two_of_four(spark, tmp_path):
    docs = [
        {"id": "1", "identificacao": "A"}, {"identificacao": "B"}, {"id": "3"},
        {"id": "4", "identificacao": "D", "peso": 10},
    ]
    path = put(tmp_path, "a.json", docs)
    got = ingest.ingest(spark, path, ingest.simple_animals()).rows
    assert sorted(r.id for r in got.collect()) == ["1", "4"]
    assert dict(got.dtypes)["processado_em"] == "timestamp"
    assert got.filter("processado_em IS NULL").count() == 0


def test_no_rules_means_all_valid(spark):
    df = validate.validate_rows(spark.range(3), {})
    assert rows(validate.validation_counts(df)) == [(3, 0)]
    assert validate.invalid_rows(df).count() == 0 and validate.valid_rows(df).count() == 3


def test_run_log_has_14_columns(spark, tmp_path):
    put(tmp_path, "good.json", {"animais": [animal("1")]})
    path = put(tmp_path, "bad.json", {"animais": [animal(None)]})
    book = ingest.ingest(spark, path, ingest.animals()).ledger
    at = [F.lit(f"2024-01-01 00:00:0{i}").cast("timestamp") for i in (0, 2)]
    log = ledger.run_log(book, "animais", "raw", started=at[0], finished=at[1], user="u").unionByName(
        ledger.file_log(book, "animais", "raw", now=at[1], user="u")
    )
    assert log.columns == RUN_LOG.fieldNames() and len(log.columns) == 14
    assert [f.dataType for f in log.schema] == [f.dataType for f in RUN_LOG]
    got = {(r.status, r.nome_arquivo): r for r in log.collect()}
    assert set(got) == {
        ("iniciado", None), ("finalizado", None), ("sucesso", "good.json"), ("erro", "bad.json")
    }
    end = got["finalizado", None]
    assert (end.duracao_ms, end.registros_processados, end.registros_invalidos) == (2000, 1, 1)
    details = json.loads(got["erro", "bad.json"].detalhes)
    assert details["exception_message"] == "id ausente" and details["exception_type"]
    assert "exception_message" not in json.loads(got["sucesso", "good.json"].detalhes)
    assert len({r.id for r in log.collect()}) == 4


# --- schedules --------------------------------------------------------------


def test_schedule_flattens_to_header_and_children(spark, tmp_path):
    base = {
        "dt_abate": "2024-05-01", "nr_unidade_abate": "12", "prod_cpf_cnpj": "00012345678901",
        "prod_nr_rg": "", "qtde_animais": 20,
    }
    full = {
        **base, "nr_lote_abate": 1, "caminhoes": [{"placa_veiculo": "AAA"}, {"placa_veiculo": "BBB"}],
        "gtas": [{"nr_gta": "G1"}],
        "nfs": [{"numero": "N1", "dt_emissao": "2024-05-01T08:00:00", "xml": "zzz",
                 "itens": [{"qtde": 3, "ncm": "01"}, {"qtde": 4, "ncm": "02"}]}],
    }
    bare = {**base, "nr_lote_abate": 2, "caminhoes": [], "gtas": [], "nfs": []}
    payload = src.scan_json(spark, put(tmp_path, "a.json", [full, bare]), SCHEDULE)
    tagged = payloads.schedule_rows(payload)
    assert tagged._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    flat = payloads.flatten_schedule(tagged)
    head = flat.header.orderBy("nr_lote_abate").first()
    assert head.prod_nr_rg is None and head.prod_cpf_cnpj == "00012345678901"
    assert json.loads(head.json_gtas) == [{"nr_gta": "G1"}]
    assert "xml" not in head.json_nfs and json.loads(head.json_nfs)[0]["numero"] == "N1"
    assert rows(flat.trucks, "nr_lote_abate", "placa_veiculo") == [(1, "AAA"), (1, "BBB"), (2, None)]
    assert rows(flat.permits, "nr_lote_abate", "nr_gta") == [(1, "G1"), (2, None)]
    assert rows(flat.invoices, "nr_lote_abate", "numero") == [(1, "N1"), (2, None)]
    assert "xml" not in flat.invoices.columns and "itens" not in flat.invoices.columns
    assert rows(flat.items, "nr_lote_abate", "numero", "qtde") == [
        (1, "N1", 3), (1, "N1", 4), (2, None, None)
    ]


# --- stream -----------------------------------------------------------------


def run_stream(spark, tmp_path, pending, payload, **options):
    start_ingest_stream(
        read_pending(spark, pending, payload, **options), payload,
        table=str(tmp_path / "table"), quarantine=str(tmp_path / "bad"),
        ledger=str(tmp_path / "files"), checkpoint=str(tmp_path / "check"),
    ).awaitTermination()
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    return read("table"), read("bad"), read("files")


def test_stream_loads_each_file_once(spark, tmp_path):
    pending = put(tmp_path / "pending", "a.json", {"animais": [animal("1"), animal(None)]})
    table, bad, files = run_stream(spark, tmp_path, pending, ingest.animals())
    assert (table.count(), bad.count(), files.count()) == (1, 1, 1)
    put(tmp_path / "pending", "b.json", {"animais": [animal("2")]})
    table, bad, files = run_stream(spark, tmp_path, pending, ingest.animals())
    assert sorted(r.id for r in table.collect()) == ["1", "2"]
    assert rows(files.select("status").distinct()) == [("sucesso",)]
    table, _, files = run_stream(spark, tmp_path, pending, ingest.animals())
    assert (table.count(), files.count()) == (2, 2)


def test_batch_run_again_replaces_its_own_rows(spark, tmp_path):
    """A crash after the table write leaves no offset commit behind."""
    pending = put(tmp_path / "pending", "a.json", {"animais": [animal("1")]})
    run_stream(spark, tmp_path, pending, ingest.animals())
    commits = tmp_path / "check" / "commits"
    for name in ("0", ".0.crc"):
        (commits / name).unlink()
    table, _, files = run_stream(spark, tmp_path, pending, ingest.animals())
    assert (table.count(), files.count()) == (1, 1)


def test_stream_archives_finished_files(spark, tmp_path):
    pending = put(tmp_path / "pending", "a.json", {"animais": [animal("1")]})
    archive = str(tmp_path / "done")
    for i in range(3):
        put(tmp_path / "pending", f"more{i}.json", {"animais": [animal(f"m{i}")]})
        table, _, _ = run_stream(spark, tmp_path, pending, ingest.animals(), archive=archive)
    assert sorted(r.id for r in table.collect()) == ["1", "m0", "m1", "m2"]
    assert list((tmp_path / "done").rglob("a.json"))
    assert not (tmp_path / "pending" / "a.json").exists()
