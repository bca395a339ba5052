"""Payload files, the lake and the ledger.

The files are written from the test tables first, so that the rows read back
can be checked against SQL over those tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from boxtrail import bindings as b, payload_files as pf
from boxtrail.operators import filters, ledger, payloads, validate
from boxtrail.plans import ingest
from boxtrail.queries import query
from boxtrail.queries.common import TENANT, clock
from boxtrail.schemas import (
    ANIMAL_RAW,
    SCHEDULE,
    SIMPLE_ANIMAL,
    SIMPLE_ANIMAL_REQUIRED,
    SLAUGHTER,
)
from boxtrail.session import scratch_path
from boxtrail.sources import json_files as src, lake
from boxtrail.streaming.ingest_stream import read_pending, start_ingest_stream


#: Arrays are written as the text of a file.
WHOLE_ARRAYS = "*.txt.snappy"


def _lot(path):
    return F.regexp_extract(path, f"/{pf.LOT}=([^/]*)/", 1)


# --- scans ------------------------------------------------------------------

_SIMPLE = """
simple AS (
  SELECT CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
      THEN CAST(o_orderkey AS VARCHAR) END AS id,
    CASE WHEN NOT (o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED')
      THEN 'B' || CAST(o_custkey AS VARCHAR) END AS identificacao,
    strftime(o_orderdate, '%Y-%m-%d') AS nascimento,
    CASE o_orderstatus WHEN 'F' THEN 'F' ELSE 'M' END AS sexo,
    o_orderpriority AS raca, o_totalprice AS peso, CAST(o_custkey AS VARCHAR) AS propriedade_id,
    '{"codigo":"' || o_orderstatus || '"}' AS status, CAST(NULL AS VARCHAR) AS cadastro
  FROM orders)"""


def _simple_columns(df, *more):
    day = "yyyy-MM-dd"
    return df.select(
        "id", "identificacao", F.date_format("data_nascimento", day).alias("nascimento"), "sexo",
        "raca", "peso", "propriedade_id", "status",
        F.date_format("data_cadastro", day).alias("cadastro"), *more,
    )


@query("json_scan", f"WITH {_SIMPLE} SELECT * FROM simple")
def json_scan(spark, sf):
    path = pf.payload_dir(spark, sf, pf.simple_animals)
    return _simple_columns(src.scan_json(spark, path, SIMPLE_ANIMAL, multi_line=False))


@query("json_scan_whole", f"WITH {_SIMPLE} SELECT * FROM simple")
def json_scan_whole(spark, sf):
    """Files with a pretty-printed top-level array each."""
    path = pf.payload_dir(spark, sf, pf.simple_animal_arrays)
    rows = src.scan_json(spark, path, SIMPLE_ANIMAL, glob=WHOLE_ARRAYS)
    # nested JSON keeps the text of the file, line breaks and all
    return _simple_columns(rows.withColumn("status", F.to_json(F.parse_json("status"))))


@query(
    "required_filter",
    f"WITH {_SIMPLE} SELECT * FROM simple WHERE id IS NOT NULL AND identificacao IS NOT NULL",
)
def required_filter(spark, sf):
    path = pf.payload_dir(spark, sf, pf.simple_animals)
    rows = src.scan_json(spark, path, SIMPLE_ANIMAL, multi_line=False)
    return _simple_columns(filters.with_required(rows, SIMPLE_ANIMAL_REQUIRED))


@query(
    "ingest_simple",
    f"""WITH {_SIMPLE} SELECT *, TRUE AS carimbado FROM simple
    WHERE id IS NOT NULL AND identificacao IS NOT NULL""",
)
def ingest_simple(spark, sf):
    path = pf.payload_dir(spark, sf, pf.simple_animals)
    rows = ingest.ingest(spark, path, ingest.simple_animals(clock()), multi_line=False).rows
    stamped = F.col("processado_em").isNotNull().alias("carimbado")
    return _simple_columns(rows, stamped)


_ANIMALS = """
animals AS (
  SELECT CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
      THEN CAST(o_orderkey AS VARCHAR) || '-' || CAST(n AS VARCHAR) END AS id,
    CAST(o_custkey AS VARCHAR) AS codigo_fazenda, CAST(n AS INTEGER) AS tipo_animal,
    CASE WHEN n = 2 AND o_orderpriority = '2-HIGH' THEN NULL
      ELSE CAST(o_custkey % 10 AS INTEGER) END AS raca,
    strftime(o_orderdate, '%Y-%m-%d') AS nascimento, CAST(NULL AS VARCHAR) AS entrada,
    CAST(n AS VARCHAR) AS classificacao_id, o_orderstatus AS classificacao_descricao,
    CASE n WHEN 1 THEN '{"nota":"' || o_orderstatus || '"}' ELSE '{}' END AS observacoes,
    '{}' AS pelagem, CAST(round(o_totalprice) AS DOUBLE) AS peso_atual,
    n = 2 AND o_orderpriority = '2-HIGH' AS bad_breed,
    o_orderstatus || substr(o_orderpriority, 1, 1) AS lote, o_orderpriority
  FROM orders CROSS JOIN range(1, 3) t(n)
  WHERE o_orderpriority <> '3-MEDIUM')"""
_ANIMAL_OUT = """id, codigo_fazenda, tipo_animal, raca, nascimento, entrada, classificacao_id,
  classificacao_descricao, observacoes, pelagem, peso_atual"""


def _animal_columns(df):
    day = "yyyy-MM-dd"
    return df.select(
        "id", "codigo_fazenda", "tipo_animal", "raca",
        F.date_format("data_nascimento", day).alias("nascimento"),
        F.date_format("data_entrada", day).alias("entrada"),
        F.get_json_object("classificacao", "$.id").alias("classificacao_id"),
        F.get_json_object("classificacao", "$.descricao").alias("classificacao_descricao"),
        "observacoes", "pelagem", "peso_atual",
    )


@query(
    "json_envelope_scan",
    f"WITH {_ANIMALS} SELECT id, codigo_fazenda, CAST(tipo_animal AS VARCHAR) AS tipo_animal, "
    "CASE WHEN bad_breed THEN 'n/a' ELSE CAST(raca AS VARCHAR) END AS raca FROM animals",
)
def json_envelope_scan(spark, sf):
    path = pf.payload_dir(spark, sf, pf.animal_envelopes)
    rows = src.scan_envelope(spark, path, ANIMAL_RAW, multi_line=False)
    return rows.select("id", "codigo_fazenda", "tipo_animal", "raca")


_ANIMAL_ALL = """id, codigo_fazenda, CAST(NULL AS INTEGER) AS origem, tipo_animal, raca,
  nascimento AS data_nascimento, classificacao_id, classificacao_descricao, observacoes,
  peso_atual, 24 AS outros_vazios"""


@query("json_envelope_scan_whole", f"WITH {_ANIMALS} SELECT {_ANIMAL_ALL} FROM animals")
def json_envelope_scan_whole(spark, sf):
    """One pretty-printed envelope per file, projected to all 33 columns."""
    path = pf.payload_dir(spark, sf, pf.animal_envelope_objects)
    rows = payloads.animal_projection(src.scan_envelope(spark, path, ANIMAL_RAW))
    filled = (
        "id", "codigo_fazenda", "tipo_animal", "raca", "data_nascimento", "classificacao",
        "observacoes", "peso_atual", "origem",
    )
    rest = [F.col(c) for c in rows.columns if c not in filled]
    empty = [F.when(c.isNull() | (c.cast("string") == "{}"), 1).otherwise(0) for c in rest]
    return rows.select(
        "id", "codigo_fazenda", "origem", "tipo_animal", "raca",
        F.date_format("data_nascimento", "yyyy-MM-dd").alias("data_nascimento"),
        F.get_json_object("classificacao", "$.id").alias("classificacao_id"),
        F.get_json_object("classificacao", "$.descricao").alias("classificacao_descricao"),
        "observacoes", "peso_atual", sum(empty[1:], empty[0]).alias("outros_vazios"),
    )


@query("animal_projection", f"WITH {_ANIMALS} SELECT {_ANIMAL_OUT} FROM animals")
def animal_projection(spark, sf):
    path = pf.payload_dir(spark, sf, pf.animal_envelopes)
    rows = src.scan_envelope(spark, path, ANIMAL_RAW, multi_line=False)
    return _animal_columns(payloads.animal_projection(rows))


_ANIMAL_ERRORS = f"""
{_ANIMALS}, checked AS (
  SELECT *, CASE WHEN id IS NULL AND bad_breed THEN 'id ausente; raca invalido'
    WHEN id IS NULL THEN 'id ausente' WHEN bad_breed THEN 'raca invalido' ELSE '' END AS erros
  FROM animals)"""


def _validated_animals(spark, sf):
    path = pf.payload_dir(spark, sf, pf.animal_envelopes)
    raw = src.scan_envelope(spark, path, ANIMAL_RAW, multi_line=False, diagnostics=True)
    return validate.validate_rows(raw, payloads.animal_rules()).withColumn(
        pf.LOT, _lot(src.FILE)
    )


@query("validate_rows", f"WITH {_ANIMAL_ERRORS} SELECT lote, id, codigo_fazenda, erros FROM checked")
def validate_rows(spark, sf):
    return _validated_animals(spark, sf).select(
        pf.LOT, "id", "codigo_fazenda", F.array_join(validate.ERRORS, "; ").alias("erros")
    )


@query(
    "validate_rows_strict",
    f"""WITH {_ANIMAL_ERRORS}
    SELECT lote, id, codigo_fazenda FROM checked
    WHERE lote NOT IN (SELECT lote FROM checked WHERE erros <> '')""",
)
def validate_rows_strict(spark, sf):
    kept = validate.reject_files(_validated_animals(spark, sf), pf.LOT)
    return kept.select(pf.LOT, "id", "codigo_fazenda")


_LEDGER = f"""
{_ANIMAL_ERRORS}, counted AS (
  SELECT lote, count(*) AS n_rows, count(*) FILTER (WHERE erros <> '') AS n_bad,
    CASE WHEN count(*) = count(*) FILTER (WHERE erros <> '') THEN 'erro' ELSE 'sucesso' END
      AS status,
    CASE WHEN count(*) = count(*) FILTER (WHERE erros <> '')
      THEN min(CASE WHEN erros <> '' THEN erros END) END AS erro
  FROM checked GROUP BY lote),
every AS (
  SELECT DISTINCT o_orderstatus || substr(o_orderpriority, 1, 1) AS lote FROM orders),
ledger AS (
  SELECT e.lote, coalesce(n_rows, 0) AS n_rows, coalesce(n_bad, 0) AS n_bad,
    coalesce(status, 'erro') AS status,
    CASE WHEN c.lote IS NULL THEN 'nenhum registro' ELSE erro END AS erro
  FROM every e LEFT JOIN counted c ON e.lote = c.lote)"""


def _ledger_by_lot(spark, sf):
    """A status row for every lot listed, with rows or without."""
    path = pf.payload_dir(spark, sf, pf.animal_envelopes)
    lots = src.pending_files(spark, path).select(_lot(src.FILE).alias(pf.LOT)).distinct()
    return ledger.ingest_route(_validated_animals(spark, sf), lots, file=pf.LOT)


@query("ingest_route", f"WITH {_LEDGER} SELECT * FROM ledger")
def ingest_route(spark, sf):
    return _ledger_by_lot(spark, sf)


@query(
    "ingest_stats",
    f"""WITH {_LEDGER} SELECT count(*) AS total,
      count(*) FILTER (WHERE status = 'sucesso') AS success,
      count(*) FILTER (WHERE status = 'erro') AS error FROM ledger""",
)
def ingest_stats(spark, sf):
    return ledger.ingest_stats(_ledger_by_lot(spark, sf))


@query(
    "run_log_append",
    f"""WITH {_LEDGER}
    SELECT 'animais' AS tipo_payload, 'raw' AS camada, lote AS nome_arquivo, status,
      CAST(NULL AS INTEGER) AS duracao_ms, CAST(n_rows - n_bad AS INTEGER) AS registros_processados,
      CAST(n_bad AS INTEGER) AS registros_invalidos, '1' AS versao_script, erro AS exception_message
    FROM ledger
    UNION ALL
    SELECT 'animais', 'raw', NULL, 'iniciado', NULL, NULL, NULL, '1', NULL
    UNION ALL
    SELECT 'animais', 'raw', NULL, 'finalizado', 1500, CAST(sum(n_rows - n_bad) AS INTEGER),
      CAST(sum(n_bad) AS INTEGER), '1', NULL FROM ledger""",
)
def run_log_append(spark, sf):
    """Two appends to one log table, read back."""
    by_lot = _ledger_by_lot(spark, sf)
    path = scratch_path(spark, "log_processamento")
    end = F.lit("2024-06-01 12:00:01.500").cast("timestamp")
    ledger.run_log_append(
        ledger.run_log(by_lot, "animais", "raw", started=clock(), finished=end, version="1"), path
    )
    ledger.run_log_append(
        ledger.file_log(by_lot, "animais", "raw", file=pf.LOT, version="1", now=end), path
    )
    return spark.read.parquet(path).select(
        "tipo_payload", "camada", "nome_arquivo", "status", "duracao_ms",
        "registros_processados", "registros_invalidos", "versao_script",
        F.get_json_object("detalhes", "$.exception_message").alias("exception_message"),
    )


@query(
    "ingest_animals",
    f"WITH {_ANIMAL_ERRORS} SELECT {_ANIMAL_OUT} FROM checked WHERE erros = ''",
)
def ingest_animals(spark, sf):
    path = pf.payload_dir(spark, sf, pf.animal_envelopes)
    return _animal_columns(ingest.ingest(spark, path, ingest.animals(), multi_line=False).rows)


@query(
    "ingest_animals_rejected",
    f"""WITH {_ANIMAL_ERRORS} SELECT codigo_fazenda, lote, erros FROM checked
    WHERE erros <> ''""",
)
def ingest_animals_rejected(spark, sf):
    path = pf.payload_dir(spark, sf, pf.animal_envelopes)
    run = ingest.ingest(spark, path, ingest.animals(), multi_line=False)
    return run.rejected.select(
        "codigo_fazenda", _lot(src.FILE).alias("lote"),
        F.array_join(validate.ERRORS, "; ").alias("erros"),
    )


# --- slaughter records ------------------------------------------------------

_MAPPED = f"""
mapped AS (
  SELECT '{{"id":' || CAST(l_partkey AS VARCHAR) || '}}' AS json_certificado,
    CASE WHEN l_returnflag = 'R' THEN '{{"id":' || CAST(l_suppkey AS VARCHAR) || '}}' ELSE '{{}}' END
      AS json_habilitacoes,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS dt_nascimento,
    l_tax AS valor_ph, strftime(l_shipdate, '%Y-%m-%d') || ' 12:00:00' AS fechamento,
    CAST(l_shipdate AS DATE) AS dt_abate, l_linenumber AS nr_lote_abate,
    CAST(l_suppkey AS INTEGER) AS id_destino_abate, CAST(l_linenumber AS INTEGER) AS nr_banda,
    l_quantity AS peso_vivo, l_extendedprice AS peso_carcaca,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag_contusao, '{TENANT}' AS token_cliente,
    l_linestatus AS nr_unidade_abate, CAST(l_orderkey AS VARCHAR) AS prod_cpf_cnpj,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS nr_identificacao,
    CAST(l_partkey AS VARCHAR) AS codigo_barra_etiqueta, CAST(NULL AS VARCHAR) AS sexo,
    TRUE AS carimbado
  FROM lineitem)"""


def _mapped_columns(df):
    number = {c: F.col(c).cast("double") for c in ("valor_ph", "peso_vivo", "peso_carcaca")}
    small = {c: F.col(c).cast("int") for c in ("nr_banda", "flag_contusao")}
    return df.withColumns({**number, **small}).select(
        "json_certificado", "json_habilitacoes", "dt_nascimento", "valor_ph",
        F.date_format("dt_fechamento_camera_abate", "yyyy-MM-dd HH:mm:ss").alias("fechamento"),
        "dt_abate", "nr_lote_abate", "id_destino_abate", "nr_banda", "peso_vivo", "peso_carcaca",
        "flag_contusao", "token_cliente", "nr_unidade_abate", "prod_cpf_cnpj",
        "nr_identificacao", "codigo_barra_etiqueta", "sexo",
        F.col("created_at").isNotNull().alias("carimbado"),
    )


@query(
    "field_mapping",
    f"""WITH {_MAPPED} SELECT * REPLACE (CASE WHEN nr_lote_abate <> 7 THEN nr_banda END AS nr_banda)
    FROM mapped""",
)
def field_mapping(spark, sf):
    path = pf.payload_dir(spark, sf, pf.slaughter_records)
    rows = src.scan_json(spark, path, SLAUGHTER, multi_line=False)
    stamped = payloads.default_json(payloads.audit_stamp(rows, TENANT, clock()))
    return _mapped_columns(payloads.field_mapping(stamped))


@query("ingest_mapped", f"WITH {_MAPPED} SELECT * FROM mapped WHERE nr_lote_abate <> 7")
def ingest_mapped(spark, sf):
    path = pf.payload_dir(spark, sf, pf.slaughter_records)
    payload = ingest.slaughter_records(TENANT, clock())
    return _mapped_columns(ingest.ingest(spark, path, payload, multi_line=False).rows)


@query(
    "audit_stamp",
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS prod_cpf_cnpj, '{TENANT}' AS token_cliente,
      '2024-06-01 12:00:00' AS criado FROM lineitem""",
)
def audit_stamp(spark, sf):
    path = pf.payload_dir(spark, sf, pf.slaughter_records)
    rows = src.scan_json(spark, path, SLAUGHTER, multi_line=False)
    return payloads.audit_stamp(rows, TENANT, clock()).select(
        "prod_cpf_cnpj", "token_cliente",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("criado"),
    )


@query(
    "default_json",
    """SELECT CAST(l_orderkey AS VARCHAR) AS prod_cpf_cnpj,
      CASE WHEN l_returnflag = 'R' THEN '{"id":' || CAST(l_suppkey AS VARCHAR) || '}' ELSE '{}' END
        AS json_habilitacoes FROM lineitem""",
)
def default_json(spark, sf):
    path = pf.payload_dir(spark, sf, pf.slaughter_records)
    rows = src.scan_json(spark, path, SLAUGHTER, multi_line=False)
    return payloads.default_json(rows).select("prod_cpf_cnpj", "json_habilitacoes")


# --- flat raw animals, batch and stream -------------------------------------

_RAW = """
raw AS (
  SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'A' || CAST(c_custkey AS VARCHAR) END
      AS id_animal,
    DATE '2020-01-01' + c_nationkey AS data_nascimento, c_name AS id_propriedade,
    CASE WHEN c_nationkey % 2 = 0 THEN 'M' ELSE 'F' END AS sexo, c_mktsegment AS raca,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_acctbal END AS peso_nascimento,
    CAST(c_acctbal > 0 AS VARCHAR) AS vacinado, c_name AS observacoes
  FROM customer)"""


def _raw_columns(df):
    return df.select(
        "id_animal", "data_nascimento", "id_propriedade", "sexo", "raca", "peso_nascimento",
        F.get_json_object("dados_adicionais", "$.vacinado").alias("vacinado"),
        F.get_json_object("dados_adicionais", "$.observacoes").alias("observacoes"),
    )


@query(
    "raw_animal_ingest",
    f"WITH {_RAW} SELECT * FROM raw WHERE raca NOT IN ('MACHINERY', 'FURNITURE')",
)
def raw_animal_ingest(spark, sf):
    path = pf.payload_dir(spark, sf, pf.flat_animals)
    return _raw_columns(ingest.ingest(spark, path, ingest.raw_animals(), multi_line=False).rows)


@query(
    "raw_animal_ingest_whole",
    f"WITH {_RAW} SELECT * FROM raw WHERE raca NOT IN ('MACHINERY', 'FURNITURE')",
)
def raw_animal_ingest_whole(spark, sf):
    """Files with a pretty-printed top-level array each."""
    path = pf.payload_dir(spark, sf, pf.flat_animal_arrays)
    run = ingest.ingest(spark, path, ingest.raw_animals(), glob=WHOLE_ARRAYS)
    return _raw_columns(run.rows)


@query(
    "ingest_stream",
    f"""WITH {_RAW}
    SELECT 'tabela' AS destino, id_animal, raca, vacinado FROM raw
    WHERE raca NOT IN ('MACHINERY', 'FURNITURE')
    UNION ALL
    SELECT 'quarentena', id_animal, raca, vacinado FROM raw
    WHERE raca IN ('MACHINERY', 'FURNITURE')""",
)
def ingest_stream(spark, sf):
    """The pending folder loaded by a stream; both tables read back."""
    base = scratch_path(spark, "ingest_stream")
    payload = ingest.raw_animals()
    pending = read_pending(
        spark, pf.payload_dir(spark, sf, pf.flat_animals), payload, multi_line=False
    )
    start_ingest_stream(
        pending,
        payload,
        table=f"{base}/raw_animais",
        quarantine=f"{base}/quarentena",
        ledger=f"{base}/arquivos",
        checkpoint=f"{base}/checkpoint",
    ).awaitTermination()
    loaded = spark.read.parquet(f"{base}/raw_animais")
    rejected = spark.read.parquet(f"{base}/quarentena")
    vaccinated = F.get_json_object("dados_adicionais", "$.vacinado").alias("vacinado")
    return loaded.select(F.lit("tabela").alias("destino"), "id_animal", "raca", vaccinated).union(
        rejected.select(
            F.lit("quarentena"), "id_animal", "raca",
            F.col("dados_adicionais.vacinado").cast("string"),
        )
    )


# --- schedules --------------------------------------------------------------


@query(
    "flatten_schedule",
    """WITH s AS (
      SELECT CAST(o_orderdate AS DATE) AS dt_abate, CAST(o_custkey % 4 AS VARCHAR) AS nr_unidade_abate,
        o_orderkey AS nr_lote_abate, CAST(o_custkey AS VARCHAR) AS cpf, o_orderkey % 4 AS k FROM orders),
    c AS (
      SELECT s.*, n FROM s LEFT JOIN range(1, 4) t(n) ON n <= k)
    SELECT 'escala' AS tabela, dt_abate, nr_unidade_abate, nr_lote_abate,
      'P' || cpf || '/' || cpf || '/-' AS valor FROM s
    UNION ALL SELECT 'caminhao', dt_abate, nr_unidade_abate, nr_lote_abate,
      'T' || CAST(nr_lote_abate AS VARCHAR) || '-' || CAST(n AS VARCHAR) FROM c
    UNION ALL SELECT 'gta', dt_abate, nr_unidade_abate, nr_lote_abate,
      'G' || CAST(nr_lote_abate AS VARCHAR) || '-' || CAST(n AS VARCHAR) FROM c
    UNION ALL SELECT 'nf', dt_abate, nr_unidade_abate, nr_lote_abate,
      'N' || CAST(nr_lote_abate AS VARCHAR) || '-1' FROM s
    UNION ALL SELECT 'item', dt_abate, nr_unidade_abate, nr_lote_abate,
      'N' || CAST(nr_lote_abate AS VARCHAR) || '-1/I' || CAST(nr_lote_abate AS VARCHAR)
      FROM s CROSS JOIN range(0, 2) r(i)""",
)
def flatten_schedule(spark, sf):
    payload = src.scan_json(
        spark, pf.payload_dir(spark, sf, pf.schedules), SCHEDULE, multi_line=False
    )
    flat = payloads.flatten_schedule(payload)
    blank = F.coalesce("prod_nr_ie", F.lit("-"))
    parts = {
        "escala": (flat.header, F.concat_ws("/", "prod_nome_razaosocial", "prod_cpf_cnpj", blank)),
        "caminhao": (flat.trucks, F.col("placa_veiculo")),
        "gta": (flat.permits, F.col("nr_gta")),
        "nf": (flat.invoices, F.col("numero")),
        "item": (flat.items, F.concat_ws("/", "numero", "descricao")),
    }
    out = None
    for name, (df, value) in parts.items():
        part = df.select(F.lit(name).alias("tabela"), *payloads.SCHEDULE_KEYS, value.alias("valor"))
        out = part if out is None else out.unionByName(part)
    return out


_SCHEDULE_KEYS = """'{"dt_abate":"' || strftime(dt_abate, '%Y-%m-%d') || '","nr_unidade_abate":"'
    || nr_unidade_abate || '","nr_lote_abate":' || CAST(nr_lote_abate AS VARCHAR)"""


@query(
    "ingest_schedules",
    f"""WITH s AS (
      SELECT CAST(o_orderdate AS DATE) AS dt_abate, CAST(o_custkey % 4 AS VARCHAR) AS nr_unidade_abate,
        o_orderkey AS nr_lote_abate, CAST(o_custkey AS VARCHAR) AS cpf, o_orderkey % 4 AS k,
        CAST(o_orderkey AS VARCHAR) AS lot FROM orders),
    c AS (SELECT s.*, n FROM s LEFT JOIN range(1, 4) t(n) ON n <= k),
    permits AS (
      SELECT lot AS l, string_agg('{{"nr_gta":"G' || lot || '-' || CAST(n AS VARCHAR) || '"}}', ','
        ORDER BY n) AS gtas FROM c WHERE n IS NOT NULL GROUP BY lot),
    parts AS (
      SELECT s.*, 'escala' AS parte, {_SCHEDULE_KEYS} || ',"prod_nome_razaosocial":"P' || cpf
        || '","prod_cpf_cnpj":"' || cpf || '"}}' AS valor, '[' || coalesce(gtas, '') || ']' AS json_gtas,
        '[{{"numero":"N' || lot || '-1","itens":[{{"qtde":' || lot || ',"descricao":"I' || lot
        || '"}},{{"qtde":' || lot || ',"descricao":"I' || lot || '"}}]}}]' AS json_nfs
      FROM s LEFT JOIN permits ON l = lot
      UNION ALL BY NAME SELECT c.*, 'caminhao' AS parte, CASE WHEN n IS NULL THEN '{{}}'
        ELSE '{{"placa_veiculo":"T' || lot || '-' || CAST(n AS VARCHAR) || '"}}' END AS valor FROM c
      UNION ALL BY NAME SELECT c.*, 'gta' AS parte, CASE WHEN n IS NULL THEN '{{}}'
        ELSE '{{"nr_gta":"G' || lot || '-' || CAST(n AS VARCHAR) || '"}}' END AS valor FROM c
      UNION ALL BY NAME SELECT s.*, 'nf' AS parte, '{{"numero":"N' || lot || '-1"}}' AS valor FROM s
      UNION ALL BY NAME SELECT s.*, 'item' AS parte, '{{"numero":"N' || lot || '-1","qtde":' || lot
        || ',"descricao":"I' || lot || '"}}' AS valor FROM s CROSS JOIN range(0, 2) r(i))
    SELECT dt_abate, nr_unidade_abate, nr_lote_abate, parte, valor, json_gtas, json_nfs,
      '{TENANT}' AS token_cliente FROM parts""",
)
def ingest_schedules(spark, sf):
    """All parts and all their columns from one parse."""
    path = pf.payload_dir(spark, sf, pf.schedules)
    payload = ingest.schedules(TENANT, clock())
    rows = ingest.ingest(spark, path, payload, multi_line=False).rows
    plain = [F.to_json(F.col("escala").dropFields("json_gtas", "json_nfs"))]
    plain += [F.to_json(p) for p in payloads.SCHEDULE_PARTS[1:]]
    return rows.select(
        *payloads.SCHEDULE_KEYS, payloads.SCHEDULE_PART, F.coalesce(*plain).alias("valor"),
        "escala.json_gtas", "escala.json_nfs", "token_cliente",
    )


# --- listings and the lake --------------------------------------------------


@query(
    "pending_listing",
    """SELECT DISTINCT o_orderstatus || substr(o_orderpriority, 1, 1) AS lote,
      TRUE AS com_conteudo FROM orders""",
)
def pending_listing(spark, sf):
    path = pf.payload_dir(spark, sf, pf.simple_animals)
    files = src.pending_files(spark, path)
    return files.groupBy(_lot(src.FILE).alias("lote")).agg(
        (F.min("tamanho") > 0).alias("com_conteudo")
    )


@query(
    "file_inventory",
    """SELECT DISTINCT o_orderstatus || substr(o_orderpriority, 1, 1) AS lote
    FROM orders WHERE o_orderstatus = 'F'""",
)
def file_inventory(spark, sf):
    path = pf.payload_dir(spark, sf, pf.simple_animals)
    return (
        lake.file_inventory(spark, path, search="lote=F")
        .select(_lot(src.FILE).alias("lote"))
        .distinct()
    )


_CUSTOMER = "c_custkey bigint, c_name string, c_acctbal double"


@query(
    "lake_read",
    """SELECT f AS formato, c_custkey, c_name, c_acctbal
    FROM customer CROSS JOIN (VALUES ('csv'), ('json'), ('parquet')) t(f)""",
)
def lake_read(spark, sf):
    """One table in each format, read back with a schema and pruned columns."""
    root = scratch_path(spark, "lake")
    customers = b.table(spark, sf, "customer")
    out = None
    for fmt in ("csv", "json", "parquet"):
        relative = f"processed/clientes_{fmt}"
        lake.lake_write(customers, root, relative, fmt)
        schema = customers.schema if fmt != "json" else _CUSTOMER
        part = lake.lake_read(
            spark, root, relative, fmt, schema=schema,
            columns=["c_custkey", "c_name", "c_acctbal"],
        ).select(F.lit(fmt).alias("formato"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("lake_write", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def lake_write(spark, sf):
    """A semicolon CSV, replaced by a second write."""
    root = scratch_path(spark, "lake")
    suppliers = b.table(spark, sf, "supplier")
    for _ in range(2):
        lake.lake_write(suppliers, root, "raw/fornecedores", "csv", sep=";")
    return lake.lake_read(
        spark, root, "raw/fornecedores", "csv", schema=suppliers.schema, sep=";"
    )


@query(
    "partitioned_dataset",
    """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano,
      CAST(month(o_orderdate) AS INTEGER) AS mes FROM orders""",
)
def partitioned_dataset(spark, sf):
    path = scratch_path(spark, "pedidos")
    orders = lake.by_day(b.table(spark, sf, "orders"), "o_orderdate")
    parts = ("ano", "mes")
    lake.write_partitioned(orders.drop("dia"), path, parts)
    return lake.list_partitions(spark, path, parts)
