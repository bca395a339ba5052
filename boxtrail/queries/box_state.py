"""Box selections and state changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxtrail import bindings as b
from boxtrail.operators import filters as sel, transitions as st
from boxtrail.queries import query
from boxtrail.queries.common import (
    ANY_OPEN,
    BOXES,
    FLAGS,
    FROM,
    TENANT,
    TO,
    clock,
    in_period,
    open_flag,
    state,
    state_sql,
)

_COLS = "id, token_cliente, dt_producao, codigo, peso, " + ", ".join(FLAGS)
_OUT = _COLS.split(", ")
_WAITING = "flag_processamento = FALSE"


def _where(sql: str) -> str:
    return f"WITH {BOXES} SELECT {_COLS} FROM boxes WHERE {sql}"


@query("tenant_period_filter", _where(in_period()))
def tenant_period_filter(spark, sf):
    return sel.tenant_period(b.boxes(spark, sf), TENANT, FROM, TO).select(*_OUT)


@query("pending_any_flag", _where(f"{in_period()} AND {_WAITING} AND {ANY_OPEN}"))
def pending_any_flag(spark, sf):
    return sel.pending_boxes(b.boxes(spark, sf), TENANT, FROM, TO).select(*_OUT)


@query("pending_any_flag_reprocess", _where(f"{in_period()} AND {_WAITING}"))
def pending_any_flag_reprocess(spark, sf):
    return sel.pending_boxes(b.boxes(spark, sf), TENANT, FROM, TO, reprocess=True).select(*_OUT)


@query(
    "pending_selected_flags",
    _where(f"{in_period()} AND {_WAITING} AND ({open_flag('flag_propriedades')} "
           f"OR {open_flag('flag_rastreavel')})"),
)
def pending_selected_flags(spark, sf):
    flags = ["flag_propriedades", "flag_rastreavel"]
    return sel.pending_by_flags(b.boxes(spark, sf), TENANT, FROM, TO, flags).select(*_OUT)


@query("needs_deboning", _where(open_flag("flag_desossa")))
def needs_deboning(spark, sf):
    return sel.needs_deboning(b.boxes(spark, sf), None).select(*_OUT)


@query(
    "needs_property",
    _where(f"flag_desossa AND ({open_flag('flag_propriedades')} OR {open_flag('flag_animais')})"),
)
def needs_property(spark, sf):
    return sel.needs_origin(b.boxes(spark, sf), None).select(*_OUT)


@query("linked_boxes", _where("flag_desossa"))
def linked_boxes(spark, sf):
    return sel.linked_boxes(b.boxes(spark, sf), None).select(*_OUT)


@query(
    "mark_for_processing",
    state_sql({"flag_processamento": "FALSE"}, f"{in_period()} AND {ANY_OPEN}"),
)
def mark_for_processing(spark, sf):
    return state(st.mark_for_processing(b.boxes(spark, sf), TENANT, FROM, TO, clock()))


@query(
    "reset_flags",
    state_sql({f: "FALSE" for f in FLAGS if f != "flag_rastreavel"}, in_period()),
)
def reset_flags(spark, sf):
    return state(st.reset_flags(b.boxes(spark, sf), TENANT, FROM, TO, clock()))


@query(
    "mark_processed",
    state_sql(
        {"flag_processamento": "TRUE", "flag_desossa": "TRUE", "flag_animais": "FALSE"},
        "id IN (SELECT id FROM boxes WHERE peso >= 25)",
    ),
)
def mark_processed(spark, sf):
    boxes = b.boxes(spark, sf)
    heavy = boxes.filter("peso >= 25").select("id")
    flags = {"flag_desossa": True, "flag_animais": False, "flag_processamento": False}
    return state(st.mark_processed(boxes, heavy, flags, clock()))


@query("touch_period", state_sql({}, in_period()))
def touch_period(spark, sf):
    return state(st.touch_period(b.boxes(spark, sf), TENANT, FROM, TO, clock()))


@query(
    "set_traceable",
    state_sql(
        {"flag_rastreavel": "TRUE"},
        f"flag_desossa AND flag_propriedades AND flag_animais AND {open_flag('flag_rastreavel')}",
    ),
)
def set_traceable(spark, sf):
    return state(st.set_traceable(b.boxes(spark, sf), None, clock()))


_SALES = """
sales AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, 't' || CAST(o_custkey % 3 AS VARCHAR) AS token_cliente,
    CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS flag_processada,
    o_orderdate, o_orderkey
  FROM orders)"""


def _sale_state(sales):
    return sales.select(
        "id", "token_cliente", "flag_processada",
        F.col("data_hora_processada").isNotNull().alias("carimbada"),
    )


@query(
    "mark_sales_processed",
    f"""WITH {_SALES}, listed AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem)
    SELECT id, token_cliente,
      CASE WHEN id IN (SELECT id FROM listed) THEN TRUE ELSE flag_processada END AS flag_processada,
      id IN (SELECT id FROM listed) AS carimbada
    FROM sales""",
)
def mark_sales_processed(spark, sf):
    ids = b.boxes(spark, sf).select(F.col("nr_op_desossa").alias("registro_id"))
    return _sale_state(st.mark_sales_processed(b.sales(spark, sf), ids, clock()))


@query(
    "mark_sales_by_tenant",
    f"""WITH {_SALES}, chosen AS (
      SELECT id FROM sales WHERE token_cliente = '{TENANT}' AND NOT flag_processada
      ORDER BY o_orderdate, id LIMIT 1000)
    SELECT id, token_cliente,
      CASE WHEN id IN (SELECT id FROM chosen) THEN TRUE ELSE flag_processada END AS flag_processada,
      id IN (SELECT id FROM chosen) AS carimbada
    FROM sales""",
)
def mark_sales_by_tenant(spark, sf):
    return _sale_state(st.mark_sales_by_tenant(b.sales(spark, sf), TENANT, 1000, clock()))


@query(
    "insert_rows",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nome FROM customer
    UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name FROM supplier""",
)
def insert_rows(spark, sf):
    more = b.table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_name").alias("nome"),
    )
    return st.insert_rows(b.properties(spark, sf), more)


@query(
    "update_where",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey = 7 THEN 'obra'
      ELSE c_mktsegment END AS c_mktsegment FROM customer""",
)
def update_where(spark, sf):
    customers = b.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    changed = st.update_where(
        customers, {"c_mktsegment": "BUILDING", "c_nationkey": 7}, {"c_mktsegment": "obra"}
    )
    return changed.drop("c_nationkey")


@query(
    "delete_where",
    f"WITH {BOXES} SELECT {_COLS} FROM boxes WHERE coalesce(NOT flag_desossa, TRUE) "
    "OR token_cliente <> 't2'",
)
def delete_where(spark, sf):
    condition = {"flag_desossa": True, "token_cliente": "t2"}
    return st.delete_where(b.boxes(spark, sf), condition).select(*_OUT)


@query(
    "affected_rows",
    f"WITH {BOXES} SELECT count(*) AS n_linhas FROM boxes "
    "WHERE flag_desossa AND token_cliente = 't2'",
)
def affected_rows(spark, sf):
    return st.affected(b.boxes(spark, sf), {"flag_desossa": True, "token_cliente": "t2"})
