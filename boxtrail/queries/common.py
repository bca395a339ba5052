"""SQL building blocks and output columns the queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CLOCK = "2024-06-01 12:00:00"
FROM, TO = "1996-01-01", "1997-12-31"
TENANT = "t1"

FLAGS = (
    "flag_processamento", "flag_desossa", "flag_propriedades", "flag_animais",
    "flag_rastreavel",
)

BOXES = """
boxes AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
    't' || CAST(l_suppkey % 3 AS VARCHAR) AS token_cliente,
    CAST(l_shipdate AS DATE) AS dt_producao,
    l_linestatus AS nr_unidade_desossa,
    CAST(l_orderkey AS VARCHAR) AS nr_op_desossa,
    CAST(l_partkey AS VARCHAR) AS codigo,
    l_quantity AS peso,
    l_discount < 0.05 AS flag_processamento,
    CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS flag_desossa,
    CASE l_linenumber % 3 WHEN 0 THEN FALSE WHEN 1 THEN TRUE END AS flag_propriedades,
    CASE WHEN l_quantity >= 25 THEN TRUE WHEN l_quantity >= 5 THEN FALSE END AS flag_animais,
    CASE WHEN l_tax > 0.06 THEN TRUE WHEN l_tax > 0 THEN FALSE END AS flag_rastreavel
  FROM lineitem)"""

LOOKUPS = """
deboning AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS lote,
    't' || CAST(o_custkey % 3 AS VARCHAR) AS token_cliente,
    o_orderstatus AS nr_unidade_desossa, CAST(o_orderkey AS VARCHAR) AS nr_op_desossa,
    CAST(o_orderdate AS DATE) AS dt_abate, CAST(o_custkey % 4 AS VARCHAR) AS nr_unidade_abate
  FROM orders),
origin AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS dt_abate,
    CAST(o_custkey % 4 AS VARCHAR) AS nr_unidade_abate, CAST(o_custkey AS VARCHAR) AS codigo,
    o_orderpriority,
    row_number() OVER (
      PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE), o_custkey % 4
      ORDER BY CAST(o_orderkey AS VARCHAR)) AS rn
  FROM orders),
schedule AS (SELECT * FROM origin WHERE rn = 1 AND o_orderpriority = '1-URGENT'),
animals AS (SELECT * FROM origin WHERE rn = 1 AND o_orderpriority = '2-HIGH')"""

# Every box linked from scratch, for all tenants.
TRACED = f"""
{BOXES}, {LOOKUPS},
linked AS (
  SELECT b.id, b.token_cliente, b.dt_producao, b.codigo, b.peso,
    d.id AS desossa_id, d.lote, d.dt_abate, d.nr_unidade_abate,
    s.id AS escala_id, s.codigo AS prod_cpf_cnpj, a.id AS animal_id, a.codigo AS animal_codigo,
    d.id IS NOT NULL AS flag_processamento,
    d.id IS NOT NULL AS flag_desossa,
    s.id IS NOT NULL AS flag_propriedades,
    a.id IS NOT NULL AS flag_animais,
    b.flag_rastreavel AS old_rastreavel
  FROM boxes b
  LEFT JOIN deboning d ON b.nr_unidade_desossa = d.nr_unidade_desossa
    AND b.nr_op_desossa = d.nr_op_desossa
  LEFT JOIN schedule s ON d.dt_abate = s.dt_abate AND d.nr_unidade_abate = s.nr_unidade_abate
  LEFT JOIN animals a ON d.dt_abate = a.dt_abate AND d.nr_unidade_abate = a.nr_unidade_abate),
traced AS (
  SELECT *, CASE WHEN flag_desossa AND flag_propriedades AND flag_animais THEN TRUE
    ELSE old_rastreavel END AS flag_rastreavel
  FROM linked)"""

SALE_BOXES = """
sale_boxes AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS registro_id,
    't' || CAST(o_custkey % 3 AS VARCHAR) AS token_cliente,
    CAST(o_custkey % 5 AS INTEGER) AS grupo_id,
    CAST(o_orderkey AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS caixa_id,
    CAST(n AS VARCHAR) AS codigo, o_orderstatus
  FROM orders CROSS JOIN range(1, 8) t(n)
  WHERE o_orderpriority <> '4-NOT SPECIFIED'
    AND n <= CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 1 + o_orderkey % 7 END)"""

# One row per traceable box sold, for all sales.
SOLD = f"""
{TRACED}, {SALE_BOXES},
sold AS (
  SELECT sb.registro_id, sb.token_cliente, sb.grupo_id, sb.caixa_id, sb.o_orderstatus,
    t.codigo AS caixa_codigo, t.peso AS caixa_peso, t.dt_producao AS caixa_dt_producao,
    t.dt_abate, t.nr_unidade_abate, t.prod_cpf_cnpj, t.desossa_id, t.lote AS lote_desossa,
    CAST(c.c_custkey AS VARCHAR) AS propriedade_id, c.c_name AS propriedade_nome,
    t.animal_id, t.animal_codigo
  FROM sale_boxes sb
  JOIN traced t ON sb.caixa_id = t.id
    AND t.flag_desossa AND t.flag_propriedades AND t.flag_animais AND t.flag_rastreavel
  LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = t.escala_id)"""


def clock() -> Column:
    return F.lit(CLOCK).cast("timestamp")


def touched() -> Column:
    """Test boxes start without an update time, so one shows a touch."""
    return F.col("updated_at").isNotNull().alias("tocada")


def state(boxes: DataFrame) -> DataFrame:
    return boxes.select("id", "token_cliente", *FLAGS, touched())


def state_sql(values: dict[str, str], where: str, ctes: str = BOXES) -> str:
    """Boxes with new flag values where the predicate holds."""
    columns = ", ".join(
        f"CASE WHEN hit THEN {values[f]} ELSE {f} END AS {f}" if f in values else f
        for f in FLAGS
    )
    return f"""WITH {ctes}, marked AS (
      SELECT *, coalesce({where}, FALSE) AS hit FROM boxes)
    SELECT id, token_cliente, {columns}, hit AS tocada FROM marked"""


def in_period(prefix: str = "") -> str:
    return (
        f"{prefix}token_cliente = '{TENANT}' AND "
        f"{prefix}dt_producao BETWEEN DATE '{FROM}' AND DATE '{TO}'"
    )


def open_flag(name: str) -> str:
    return f"coalesce(NOT {name}, TRUE)"


ANY_OPEN = "(" + " OR ".join(
    open_flag(f) for f in ("flag_desossa", "flag_propriedades", "flag_animais")
) + ")"
