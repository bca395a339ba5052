"""Status, distribution, profile and log reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from boxtrail import bindings as b
from boxtrail.operators import reports as rep
from boxtrail.plans import trace
from boxtrail.queries import query
from boxtrail.queries.common import BOXES, TRACED, clock
from boxtrail.sources.jdbc import bound_query

_COUNTS = """count(*) AS total_caixas,
  count(*) FILTER (WHERE flag_rastreavel) AS caixas_rastreaveis,
  count(*) FILTER (WHERE NOT flag_rastreavel) AS caixas_nao_rastreaveis,
  count(*) FILTER (WHERE flag_rastreavel IS NULL) AS caixas_flag_null"""


@query("flag_status", f"WITH {BOXES} SELECT token_cliente, {_COUNTS} FROM boxes GROUP BY 1")
def flag_status(spark, sf):
    return rep.flag_status(b.boxes(spark, sf))


def _completeness(source: str) -> str:
    return f"""SELECT token_cliente, count(*) AS total_caixas,
      count(*) FILTER (WHERE flag_desossa AND flag_propriedades AND flag_animais)
        AS caixas_completas,
      count(*) FILTER (WHERE flag_rastreavel) AS caixas_rastreaveis
    FROM {source} GROUP BY 1"""


@query("completeness_status", f"WITH {BOXES} {_completeness('boxes')}")
def completeness_status(spark, sf):
    return rep.completeness_status(b.boxes(spark, sf))


@query("completeness_after_trace", f"WITH {TRACED} {_completeness('traced')}")
def completeness_after_trace(spark, sf):
    traced = trace.trace_all(
        b.boxes(spark, sf), b.deboning(spark, sf), b.schedule(spark, sf), b.animals(spark, sf),
        None, reset=True, now=clock(),
    )
    return rep.completeness_status(traced)


@query(
    "flag_relationship",
    f"""WITH {BOXES}
    SELECT CASE
        WHEN flag_desossa AND flag_propriedades AND flag_animais THEN 'Todas flags true'
        WHEN flag_desossa AND (NOT flag_propriedades OR NOT flag_animais)
          THEN 'Desossa true, outras false'
        WHEN NOT flag_desossa THEN 'Desossa false'
        ELSE 'Outros casos' END AS status_flags, {_COUNTS}
    FROM boxes GROUP BY 1 ORDER BY 1""",
)
def flag_relationship(spark, sf):
    return rep.flag_relationship(b.boxes(spark, sf))


@query(
    "value_distribution",
    """(SELECT 'raca' AS atributo, p_brand AS valor, count(*) AS total FROM part GROUP BY 2
      ORDER BY total DESC, valor LIMIT 10)
    UNION ALL
    (SELECT 'sexo', p_type, count(*) FROM part GROUP BY 2)""",
)
def value_distribution(spark, sf):
    part = b.table(spark, sf, "part")
    breed = rep.value_distribution(part, "p_brand", 10)
    sex = rep.value_distribution(part, "p_type")
    return breed.select(F.lit("raca").alias("atributo"), "*").unionByName(
        sex.select(F.lit("sexo").alias("atributo"), "*")
    )


@query(
    "top_n",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25",
)
def top_n(spark, sf):
    customers = b.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return rep.top_n(customers, "c_acctbal", 25)


# Columns of the profiled tables, with their types in Spark's names.
_PROFILED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
_KEYS = {
    "lineitem": ("l_orderkey", "l_linenumber"), "conversations": ("conv_id", "turn"),
}


def _keys(name: str) -> tuple[str, ...]:
    """The key of a table: its first column, unless two are needed."""
    return _KEYS.get(name, (_PROFILED[name].split(" ")[0],))


def _profile_sql() -> str:
    parts = []
    for name, columns in _PROFILED.items():
        for entry in columns.split(", "):
            column, kind = entry.split(" ")
            parts.append(
                f"SELECT '{name}' AS tabela, count(*) AS n_linhas, '{column}' AS coluna, "
                f"'{kind}' AS tipo, count(*) - count({column}) AS n_nulos FROM {name}"
            )
    return " UNION ALL ".join(parts)


def _ranking_sql() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, count(*) AS n_linhas FROM {name}" for name in _PROFILED
    )
    return f"SELECT * FROM ({counts}) ORDER BY n_linhas DESC, tabela LIMIT 5"


def _sample_sql() -> str:
    parts = []
    for name in _PROFILED:
        keys = _keys(name)
        key = " || '-' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
        order = f"sha256({key}), {', '.join(keys)}"
        parts.append(
            f"(SELECT '{name}' AS tabela, {key} AS chave FROM {name} ORDER BY {order} LIMIT 5)"
        )
    return " UNION ALL ".join(parts)


@query("table_sample", _sample_sql())
def table_sample(spark, sf):
    """Five rows of each table."""
    parts = []
    for name in _PROFILED:
        key = F.concat_ws("-", *[F.col(k).cast("string") for k in _keys(name)])
        rows = rep.table_sample(b.table(spark, sf, name), _keys(name), 5)
        parts.append(rows.select(F.lit(name).alias("tabela"), key.alias("chave")))
    return reduce(DataFrame.unionByName, parts)


@query("table_distinct_counts")
def table_distinct_counts(spark, sf):
    """Different values of every column, from sketches; no SQL gives the same estimate."""
    return rep.distinct_counts(rep.distinct_sketches({n: b.table(spark, sf, n) for n in _PROFILED}))


@query("table_profile", _profile_sql())
def table_profile(spark, sf):
    return rep.table_profile({n: b.table(spark, sf, n) for n in _PROFILED})


@query("table_ranking", _ranking_sql())
def table_ranking(spark, sf):
    return rep.table_ranking({n: b.table(spark, sf, n) for n in _PROFILED})


@query(
    "log_metrics",
    """SELECT event_type AS tipo_payload, 'raw' AS camada,
      CASE event_type WHEN 'error' THEN 'erro' ELSE 'sucesso' END AS status,
      count(*) AS execucoes, CAST(sum(CAST(floor(value) AS INTEGER)) AS BIGINT) AS duracao_total_ms,
      CAST(sum(CAST(floor(value) AS INTEGER)) AS DOUBLE) / count(*) AS duracao_media_ms,
      CAST(sum(CAST(props->>'$.k' AS INTEGER)) AS BIGINT) AS registros_processados,
      CAST(sum(CASE event_type WHEN 'error' THEN 1 ELSE 0 END) AS BIGINT) AS registros_invalidos
    FROM events GROUP BY 1, 2, 3""",
)
def log_metrics(spark, sf):
    return rep.log_metrics(b.run_log(spark, sf))


@query(
    "latest_log_rows",
    """SELECT event_id AS id, event_type AS tipo_payload, 'u' || CAST(user_id AS VARCHAR) AS nome_arquivo
    FROM events ORDER BY ts DESC, event_id DESC LIMIT 10""",
)
def latest_log_rows(spark, sf):
    return rep.latest_log_rows(b.run_log(spark, sf)).select("id", "tipo_payload", "nome_arquivo")


@query(
    "jdbc_query_read",
    f"""WITH {BOXES}
    SELECT token_cliente, nr_unidade_desossa, count(*) AS n, CAST(sum(peso) AS BIGINT) AS peso
    FROM boxes WHERE peso >= 25 AND token_cliente <> 't0' GROUP BY 1, 2""",
)
def jdbc_query_read(spark, sf):
    """The SQL text entry over frames; a database is not needed to run it."""
    return bound_query(
        spark,
        """SELECT token_cliente, nr_unidade_desossa, count(*) AS n,
          CAST(sum(peso) AS BIGINT) AS peso
        FROM {boxes} WHERE peso >= :least AND token_cliente <> :tenant
        GROUP BY token_cliente, nr_unidade_desossa""",
        {"least": 25.0, "tenant": "t0"},
        boxes=b.boxes(spark, sf),
    )
