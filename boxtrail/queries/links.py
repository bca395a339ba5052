"""Links, merges and the trace stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxtrail import bindings as b
from boxtrail.functions.payload import json_id
from boxtrail.operators import link, merge
from boxtrail.plans import trace
from boxtrail.queries import query
from boxtrail.queries.common import (
    ANY_OPEN,
    BOXES,
    FLAGS,
    FROM,
    LOOKUPS,
    TENANT,
    TO,
    TRACED,
    clock,
    in_period,
    open_flag,
)
from boxtrail.session import materialise

_JOINS = """
  LEFT JOIN deboning d ON b.nr_unidade_desossa = d.nr_unidade_desossa
    AND b.nr_op_desossa = d.nr_op_desossa"""
_ORIGIN_JOINS = """
  LEFT JOIN schedule s ON d.dt_abate = s.dt_abate AND d.nr_unidade_abate = s.nr_unidade_abate
  LEFT JOIN animals a ON d.dt_abate = a.dt_abate AND d.nr_unidade_abate = a.nr_unidade_abate"""


def _lookups(spark, sf):
    return b.deboning(spark, sf), b.schedule(spark, sf), b.animals(spark, sf)


def _parsed(df, **texts: str):
    """JSON texts with some of their fields as structs `_<text>`, each parsed once."""
    return df.withColumns({
        f"_{text}": F.from_json(text, ", ".join(f"{f} string" for f in fields.split()))
        for text, fields in texts.items()
    })


@query(
    "link_deboning",
    f"""WITH {BOXES}, {LOOKUPS}
    SELECT b.id, b.token_cliente, d.id IS NOT NULL AS flag_desossa, d.id AS desossa_id, d.lote,
      CAST(d.dt_abate AS VARCHAR) AS dt_abate_json
    FROM boxes b {_JOINS}""",
)
def link_deboning(spark, sf):
    linked = link.link_deboning(b.boxes(spark, sf), b.deboning(spark, sf), now=clock())
    return _parsed(linked, json_desossa="id lote dt_abate").select(
        "id", "token_cliente", "flag_desossa", F.col("_json_desossa.id").alias("desossa_id"),
        F.col("_json_desossa.lote").alias("lote"),
        F.col("_json_desossa.dt_abate").alias("dt_abate_json"),
    )


@query(
    "link_deboning_grouped",
    f"""WITH {BOXES}, {LOOKUPS}
    SELECT b.id, b.token_cliente, d.id IS NOT NULL AS flag_desossa, d.id AS desossa_id
    FROM boxes b {_JOINS} AND b.token_cliente = d.token_cliente""",
)
def link_deboning_grouped(spark, sf):
    linked = link.link_deboning_grouped(
        b.boxes(spark, sf), b.deboning(spark, sf, with_tenant=True), now=clock()
    )
    return linked.select(
        "id", "token_cliente", "flag_desossa", json_id(F.col("json_desossa")).alias("desossa_id")
    )


@query(
    "link_writeback",
    f"""WITH {BOXES}, {LOOKUPS}
    SELECT b.id, d.id IS NOT NULL AS flag_desossa, d.dt_abate, d.nr_unidade_abate, TRUE AS tocada
    FROM boxes b {_JOINS}""",
)
def link_writeback(spark, sf):
    linked = link.link_deboning(b.boxes(spark, sf), b.deboning(spark, sf), now=clock())
    return linked.select(
        "id", "flag_desossa", "dt_abate", "nr_unidade_abate",
        F.col("updated_at").isNotNull().alias("tocada"),
    )


@query(
    "link_schedule",
    f"""WITH {BOXES}, {LOOKUPS}
    SELECT b.id, s.id IS NOT NULL AS flag_propriedades, s.id AS escala_id, s.codigo AS prod_cpf_cnpj
    FROM boxes b {_JOINS} {_ORIGIN_JOINS}""",
)
def link_schedule(spark, sf):
    deboning, schedule, _ = _lookups(spark, sf)
    boxes = link.link_deboning(b.boxes(spark, sf), deboning)
    linked = _parsed(link.link_schedule(boxes, schedule), json_propriedades="id prod_cpf_cnpj")
    return linked.select(
        "id", "flag_propriedades", F.col("_json_propriedades.id").alias("escala_id"),
        F.col("_json_propriedades.prod_cpf_cnpj").alias("prod_cpf_cnpj"),
    )


@query(
    "link_animals",
    f"""WITH {BOXES}, {LOOKUPS}
    SELECT b.id, a.id IS NOT NULL AS flag_animais, a.id AS animal_id, a.codigo
    FROM boxes b {_JOINS} {_ORIGIN_JOINS}""",
)
def link_animals(spark, sf):
    deboning, _, animals = _lookups(spark, sf)
    boxes = link.link_deboning(b.boxes(spark, sf), deboning)
    linked = _parsed(link.link_animals(boxes, animals), json_animais="id codigo")
    return linked.select(
        "id", "flag_animais", F.col("_json_animais.id").alias("animal_id"),
        F.col("_json_animais.codigo").alias("codigo"),
    )


@query(
    "link_origin",
    f"""WITH {BOXES}, {LOOKUPS}
    SELECT b.id, s.id IS NOT NULL AS flag_propriedades, s.id AS escala_id,
      a.id IS NOT NULL AS flag_animais, a.id AS animal_id
    FROM boxes b {_JOINS} {_ORIGIN_JOINS}""",
)
def link_origin(spark, sf):
    deboning, schedule, animals = _lookups(spark, sf)
    boxes = link.link_deboning(b.boxes(spark, sf), deboning)
    return link.link_origin(boxes, schedule, animals).select(
        "id", "flag_propriedades", json_id(F.col("json_propriedades")).alias("escala_id"),
        "flag_animais", json_id(F.col("json_animais")).alias("animal_id"),
    )


# --- one row per key, merges, sets ------------------------------------------

_PLAIN = "id, token_cliente, dt_producao, nr_op_desossa, codigo, peso"
_DEDUP = f"""
one AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY
      token_cliente NULLS LAST, dt_producao NULLS LAST, nr_unidade_desossa NULLS LAST,
      nr_op_desossa NULLS LAST, codigo NULLS LAST, peso NULLS LAST,
      flag_processamento NULLS LAST, flag_desossa NULLS LAST, flag_propriedades NULLS LAST,
      flag_animais NULLS LAST, flag_rastreavel NULLS LAST) AS rn
    FROM boxes) WHERE rn = 1)"""


@query("dedup_by_id", f"WITH {BOXES}, {_DEDUP} SELECT {_PLAIN}, {', '.join(FLAGS)} FROM one")
def dedup_by_id(spark, sf):
    return merge.dedup_by_id(b.boxes(spark, sf)).select(*_PLAIN.split(", "), *FLAGS)


@query("duplicate_ids", f"WITH {BOXES} SELECT id, count(*) AS n FROM boxes GROUP BY id HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    return merge.duplicate_ids(b.boxes(spark, sf))


@query(
    "duplicate_summary",
    f"""WITH {BOXES}, d AS (SELECT id, count(*) AS n FROM boxes GROUP BY id HAVING count(*) > 1)
    SELECT count(*) AS n_ids, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_linhas FROM d""",
)
def duplicate_summary(spark, sf):
    return merge.duplicate_summary(b.boxes(spark, sf))


@query(
    "schema_align",
    f"""WITH {BOXES}
    SELECT id, token_cliente, nr_unidade_desossa, nr_op_desossa, dt_producao,
      CAST(NULL AS VARCHAR) AS codigo_barras, TRUE AS criada FROM boxes""",
)
def schema_align(spark, sf):
    rows = merge.schema_align(b.boxes(spark, sf), now=clock(), fill=True)
    return rows.select(
        "id", "token_cliente", "nr_unidade_desossa", "nr_op_desossa", "dt_producao",
        "codigo_barras", F.col("created_at").isNotNull().alias("criada"),
    )


@query(
    "upsert_by_id",
    f"""WITH {BOXES}, {_DEDUP},
    t AS (SELECT id, token_cliente, codigo, peso FROM one WHERE flag_desossa),
    s AS (SELECT id, 'novo' AS codigo, peso + 1000 AS peso FROM one WHERE flag_propriedades)
    SELECT coalesce(t.id, s.id) AS id, t.token_cliente,
      CASE WHEN s.id IS NULL THEN t.codigo ELSE s.codigo END AS codigo,
      CASE WHEN s.id IS NULL THEN t.peso ELSE s.peso END AS peso
    FROM t FULL JOIN s ON t.id = s.id""",
)
def upsert_by_id(spark, sf):
    one = merge.dedup_by_id(b.boxes(spark, sf))
    target = one.filter("flag_desossa").select("id", "token_cliente", "codigo", "peso")
    source = one.filter("flag_propriedades").select(
        "id", F.lit("novo").alias("codigo"), (F.col("peso") + 1000).alias("peso")
    )
    return merge.upsert(target, source)


@query(
    "insert_ignore",
    """WITH t AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, 'antigo' AS origem FROM orders
      WHERE o_orderstatus = 'F')
    SELECT id, origem FROM t
    UNION ALL
    SELECT DISTINCT CAST(l_orderkey AS VARCHAR), 'novo' FROM lineitem
    WHERE CAST(l_orderkey AS VARCHAR) NOT IN (SELECT id FROM t)""",
)
def insert_ignore(spark, sf):
    orders = b.deboning(spark, sf)
    target = orders.filter("nr_unidade_desossa = 'F'").select("id", F.lit("antigo").alias("origem"))
    source = b.boxes(spark, sf).select(
        F.col("nr_op_desossa").alias("id"), F.lit("novo").alias("origem")
    )
    return merge.insert_ignore(target, source, ["id"])


@query(
    "slice_except",
    f"""WITH {BOXES}, r AS (SELECT id, token_cliente, codigo, peso FROM boxes
      ORDER BY id, token_cliente, codigo, peso)
    (SELECT * FROM r ORDER BY id, token_cliente, codigo, peso LIMIT 2000)
    EXCEPT
    (SELECT * FROM r ORDER BY id, token_cliente, codigo, peso LIMIT 1000)""",
)
def slice_except(spark, sf):
    boxes = b.boxes(spark, sf).select("id", "token_cliente", "codigo", "peso")
    return merge.slice_except(boxes, 1000, 2000, ["id"], lambda df: materialise(df, "fatia"))


@query(
    "slice_except_deep",
    f"""WITH {BOXES}, r AS (
      SELECT nr_unidade_desossa, codigo, peso,
        row_number() OVER (ORDER BY codigo, nr_unidade_desossa, peso) AS n FROM boxes)
    SELECT nr_unidade_desossa, codigo, peso FROM r WHERE n > 4000 AND n <= 4500
    EXCEPT SELECT nr_unidade_desossa, codigo, peso FROM r WHERE n <= 4000""",
)
def slice_except_deep(spark, sf):
    """Far into a table with many equal rows."""
    boxes = b.boxes(spark, sf).select("nr_unidade_desossa", "codigo", "peso")
    return merge.slice_except(boxes, 4000, 4500, ["codigo"], lambda df: materialise(df, "fatia"))


@query(
    "union_groups",
    f"""WITH {BOXES}
    SELECT id, token_cliente, peso FROM boxes""",
)
def union_groups(spark, sf):
    boxes = b.boxes(spark, sf).select("id", "token_cliente", "peso")
    return merge.union_groups(*[boxes.filter(F.col("token_cliente") == t) for t in ("t0", "t1", "t2")])


@query(
    "distinct_projection",
    f"""WITH {BOXES}
    SELECT DISTINCT token_cliente, nr_unidade_desossa, nr_op_desossa FROM boxes""",
)
def distinct_projection(spark, sf):
    keys = ("token_cliente", *link.DEBONING_KEYS)
    return b.boxes(spark, sf).select(*keys).distinct()


# --- stages -----------------------------------------------------------------


def _outcome(boxes):
    return boxes.select(
        "id", "token_cliente", *FLAGS, "dt_abate",
        json_id(F.col("json_desossa")).alias("desossa_id"),
        json_id(F.col("json_propriedades")).alias("escala_id"),
        json_id(F.col("json_animais")).alias("animal_id"),
    )


_OUTCOME = "id, token_cliente, " + ", ".join(FLAGS) + ", dt_abate, desossa_id, escala_id, animal_id"


@query("trace_all_reset", f"WITH {TRACED} SELECT {_OUTCOME} FROM traced")
def trace_all_reset(spark, sf):
    return _outcome(
        trace.trace_all(b.boxes(spark, sf), *_lookups(spark, sf), None, reset=True, now=clock())
    )


# Stage 1 works on boxes without a deboning order, stage 2 on those with one.
_STAGE1 = f"""
stage1 AS (
  SELECT b.id, b.token_cliente, b.dt_producao, b.flag_processamento, b.flag_propriedades,
    b.flag_animais, b.flag_rastreavel,
    CASE WHEN {open_flag('b.flag_desossa')} THEN d.id IS NOT NULL ELSE b.flag_desossa END
      AS flag_desossa,
    CASE WHEN {open_flag('b.flag_desossa')} THEN d.id END AS desossa_id,
    CASE WHEN {open_flag('b.flag_desossa')} THEN d.dt_abate END AS dt_abate,
    CASE WHEN {open_flag('b.flag_desossa')} THEN d.nr_unidade_abate END AS nr_unidade_abate
  FROM boxes b {_JOINS})"""
_STAGE2 = f"""
stage2 AS (
  SELECT x.id, x.token_cliente, x.dt_producao, x.flag_processamento, x.flag_desossa,
    x.flag_rastreavel, x.desossa_id, x.dt_abate,
    CASE WHEN x.sel THEN s.id IS NOT NULL ELSE x.flag_propriedades END AS flag_propriedades,
    CASE WHEN x.sel THEN a.id IS NOT NULL ELSE x.flag_animais END AS flag_animais,
    CASE WHEN x.sel THEN s.id END AS escala_id,
    CASE WHEN x.sel THEN a.id END AS animal_id
  FROM (SELECT *, flag_desossa AND ({open_flag('flag_propriedades')}
      OR {open_flag('flag_animais')}) AS sel FROM stage1) x
  LEFT JOIN schedule s ON x.dt_abate = s.dt_abate AND x.nr_unidade_abate = s.nr_unidade_abate
  LEFT JOIN animals a ON x.dt_abate = a.dt_abate AND x.nr_unidade_abate = a.nr_unidade_abate)"""


@query(
    "trace_all",
    f"""WITH {BOXES}, {LOOKUPS}, {_STAGE1}, {_STAGE2}
    SELECT id, token_cliente, flag_desossa OR flag_processamento AS flag_processamento,
      flag_desossa, flag_propriedades, flag_animais,
      CASE WHEN flag_desossa AND flag_propriedades AND flag_animais THEN TRUE
        ELSE flag_rastreavel END AS flag_rastreavel,
      dt_abate, desossa_id, escala_id, animal_id
    FROM stage2""",
)
def trace_all(spark, sf):
    return _outcome(trace.trace_all(b.boxes(spark, sf), *_lookups(spark, sf), None, now=clock()))


_PERIOD = f"""
opened AS (
  SELECT *, coalesce({in_period()} AND ({ANY_OPEN} OR NOT flag_processamento), FALSE) AS hit
  FROM boxes)"""


@query(
    "trace_period",
    f"""WITH {BOXES}, {LOOKUPS}, {_PERIOD}
    SELECT b.id, b.token_cliente,
      CASE WHEN hit THEN TRUE ELSE flag_processamento END AS flag_processamento,
      CASE WHEN hit THEN d.id IS NOT NULL ELSE flag_desossa END AS flag_desossa,
      CASE WHEN hit THEN s.id IS NOT NULL ELSE flag_propriedades END AS flag_propriedades,
      CASE WHEN hit THEN a.id IS NOT NULL ELSE flag_animais END AS flag_animais,
      flag_rastreavel,
      CASE WHEN hit THEN d.dt_abate END AS dt_abate, CASE WHEN hit THEN d.id END AS desossa_id,
      CASE WHEN hit THEN s.id END AS escala_id, CASE WHEN hit THEN a.id END AS animal_id
    FROM opened b {_JOINS} {_ORIGIN_JOINS}""",
)
def trace_period(spark, sf):
    return _outcome(
        trace.trace_period(b.boxes(spark, sf), *_lookups(spark, sf), TENANT, FROM, TO, now=clock())
    )


@query(
    "trace_stage_desossa",
    f"""WITH {BOXES}, {LOOKUPS}, {_STAGE1}
    SELECT id, token_cliente, flag_processamento, flag_desossa, flag_propriedades, flag_animais,
      flag_rastreavel, dt_abate, desossa_id, CAST(NULL AS VARCHAR) AS escala_id,
      CAST(NULL AS VARCHAR) AS animal_id
    FROM stage1""",
)
def trace_stage_desossa(spark, sf):
    return _outcome(
        trace.trace_stage("desossa", b.boxes(spark, sf), *_lookups(spark, sf), None, now=clock())
    )


@query(
    "trace_stage_propriedades",
    f"""WITH {BOXES}, {LOOKUPS}, {_STAGE1}, {_STAGE2}
    SELECT {_OUTCOME} FROM stage2""",
)
def trace_stage_propriedades(spark, sf):
    first = trace.trace_stage(
        "desossa", b.boxes(spark, sf), *_lookups(spark, sf), None, now=clock()
    )
    return _outcome(
        trace.trace_stage("propriedades", first, *_lookups(spark, sf), None, now=clock())
    )


@query(
    "trace_stage_proc",
    f"""WITH {TRACED}, kept AS (SELECT * FROM traced WHERE flag_desossa)
    SELECT id, min(nr_unidade_abate) AS nr_unidade_abate, min(dt_abate) AS dt_abate
    FROM kept GROUP BY id""",
)
def trace_stage_proc(spark, sf):
    traced = trace.trace_all(
        b.boxes(spark, sf), *_lookups(spark, sf), None, reset=True, now=clock()
    )
    rows = trace.proc_boxes(trace.proc_candidates(traced, None), now=clock())
    return rows.select("id", "nr_unidade_abate", "dt_abate")
