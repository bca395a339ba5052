"""Sales and their result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxtrail import bindings as b
from boxtrail.operators import sales as op
from boxtrail.plans import trace
from boxtrail.plans.sale_trace import sale_rows, sale_trace as run_sale_trace
from boxtrail.queries import query
from boxtrail.queries.common import CLOCK, SALE_BOXES, SOLD, TENANT, TRACED, clock


def _traced(spark, sf):
    return trace.trace_all(
        b.boxes(spark, sf), b.deboning(spark, sf), b.schedule(spark, sf), b.animals(spark, sf),
        None, reset=True, now=clock(),
    )


def _lookups(spark, sf):
    return b.deboning(spark, sf), b.properties(spark, sf), b.animals(spark, sf)


def _proc(spark, sf):
    """Result rows of every sale, processed or not."""
    boxes = op.explode_sale_boxes(b.sales(spark, sf))
    lineage = op.sale_lineage(boxes, _traced(spark, sf), *_lookups(spark, sf))
    return op.proc_projection(lineage, clock())


@query(
    "oldest_unprocessed",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, 't' || CAST(o_custkey % 3 AS VARCHAR) AS token_cliente,
      CAST(o_custkey % 5 AS INTEGER) AS grupo_id
    FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 3 = 1 AND o_custkey % 5 = 2
    ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR) LIMIT 1000""",
)
def oldest_unprocessed(spark, sf):
    picked = op.oldest_unprocessed(b.sales(spark, sf), 2, TENANT, 1000)
    return picked.select("id", "token_cliente", "grupo_id")


@query(
    "oldest_unprocessed_limited",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, 't' || CAST(o_custkey % 3 AS VARCHAR) AS token_cliente,
      CAST(o_custkey % 5 AS INTEGER) AS grupo_id
    FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 3 = 1
    ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR) LIMIT 25""",
)
def oldest_unprocessed_limited(spark, sf):
    """Fewer than there are."""
    picked = op.oldest_unprocessed(b.sales(spark, sf), None, TENANT, 25)
    return picked.select("id", "token_cliente", "grupo_id")


@query(
    "optional_column",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(NULL AS INTEGER) AS grupo_id FROM orders""",
)
def optional_column(spark, sf):
    return op.optional_group(b.sales(spark, sf).drop("grupo_id")).select("id", "grupo_id")


@query(
    "explode_sale_boxes",
    f"""WITH {SALE_BOXES}
    SELECT registro_id, token_cliente, grupo_id, caixa_id, codigo FROM sale_boxes""",
)
def explode_sale_boxes(spark, sf):
    return op.explode_sale_boxes(b.sales(spark, sf)).drop("peso")


@query(
    "lineage_lookup",
    f"""WITH {TRACED}
    SELECT t.id, t.codigo, t.peso, t.dt_producao, t.flag_desossa, t.flag_propriedades,
      t.flag_animais, t.flag_rastreavel, t.desossa_id, t.lote AS desossa_lote,
      CAST(c.c_custkey AS VARCHAR) AS propriedade_id, c.c_name AS propriedade_nome,
      t.animal_id, t.animal_codigo
    FROM traced t LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = t.escala_id
    WHERE t.flag_desossa AND t.flag_propriedades AND t.flag_animais AND t.flag_rastreavel""",
)
def lineage_lookup(spark, sf):
    return op.lineage_lookup(_traced(spark, sf), *_lookups(spark, sf))


@query(
    "semi_by_ids",
    f"""WITH {TRACED}, {SALE_BOXES}
    SELECT id, token_cliente, codigo, peso FROM traced
    WHERE id IN (SELECT caixa_id FROM sale_boxes)""",
)
def semi_by_ids(spark, sf):
    boxes = b.boxes(spark, sf).select("id", "token_cliente", "codigo", "peso")
    return op.semi_by_ids(boxes, op.explode_sale_boxes(b.sales(spark, sf)))


@query(
    "sale_box_join",
    f"""WITH {TRACED}, {SALE_BOXES}
    SELECT s.registro_id, s.token_cliente, s.grupo_id, s.caixa_id, t.codigo, t.peso
    FROM sale_boxes s JOIN traced t ON s.caixa_id = t.id""",
)
def sale_box_join(spark, sf):
    named = op.explode_sale_boxes(b.sales(spark, sf)).drop("codigo", "peso")
    return op.sale_box_join(named, b.boxes(spark, sf).select("id", "codigo", "peso"))


@query(
    "sale_box_join_tenant",
    f"""WITH {TRACED}, {SALE_BOXES}
    SELECT s.registro_id, s.token_cliente, s.grupo_id, s.caixa_id, t.codigo, t.peso,
      t.token_cliente AS caixa_token_cliente
    FROM sale_boxes s JOIN traced t ON s.caixa_id = t.id AND s.token_cliente = t.token_cliente""",
)
def sale_box_join_tenant(spark, sf):
    """Only boxes of the sale's own tenant."""
    named = op.explode_sale_boxes(b.sales(spark, sf)).drop("codigo", "peso")
    found = b.boxes(spark, sf).select("id", "codigo", "peso", "token_cliente")
    return op.sale_box_join(named, found, tenant_scoped=True)


@query(
    "collision_rename",
    f"""WITH {TRACED}, {SALE_BOXES}
    SELECT s.caixa_id, s.token_cliente, s.codigo, t.token_cliente AS caixa_token_cliente,
      t.codigo AS caixa_codigo
    FROM sale_boxes s JOIN traced t ON s.caixa_id = t.id""",
)
def collision_rename(spark, sf):
    named = op.explode_sale_boxes(b.sales(spark, sf)).select("caixa_id", "token_cliente", "codigo")
    return op.sale_box_join(named, b.boxes(spark, sf).select("id", "token_cliente", "codigo"))


_PROC = """registro_id, token_cliente, grupo_id, caixa_id, caixa_codigo, caixa_peso,
  caixa_dt_producao, dt_abate, nr_unidade_abate, prod_cpf_cnpj, desossa_id, lote_desossa,
  propriedade_id, animal_id, animal_codigo"""
_PROC_COLS = [c.strip() for c in _PROC.split(",")]


@query("proc_projection", f"WITH {SOLD} SELECT {_PROC} FROM sold")
def proc_projection(spark, sf):
    return _proc(spark, sf).select(*_PROC_COLS)


@query(
    "sale_header_defaults",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, '00000000000000' AS nf_destino_cpf_cnpj,
      DATE '{CLOCK[:10]}' AS dt_venda, 'VENDA' AS nf_natureza, 'Venda' AS nf_origem_nome_razaosocial,
      '' AS nf_numero, '{{}}' AS json_itens, TRUE AS flag_web, 'Brasil' AS destino_pais
    FROM orders""",
)
def sale_header_defaults(spark, sf):
    values = op.sale_header_defaults(clock())
    names = (
        "nf_destino_cpf_cnpj", "dt_venda", "nf_natureza", "nf_origem_nome_razaosocial",
        "nf_numero", "json_itens", "flag_web", "destino_pais",
    )
    return b.sales(spark, sf).select("id", *[values[n].alias(n) for n in names])


@query(
    "proc_sale_header",
    f"""WITH {SOLD}
    SELECT DISTINCT registro_id AS id, token_cliente, DATE '{CLOCK[:10]}' AS nf_dt_pedido,
      '00000000000000' AS nf_origem_cpf_cnpj, 'Brasil' AS destino_pais
    FROM sold""",
)
def proc_sale_header(spark, sf):
    return op.proc_sale_header(_proc(spark, sf), clock()).select(
        "id", "token_cliente", "nf_dt_pedido", "nf_origem_cpf_cnpj", "destino_pais"
    )


@query(
    "proc_property",
    f"""WITH {SOLD}
    SELECT DISTINCT token_cliente, dt_abate, nr_unidade_abate, prod_cpf_cnpj FROM sold""",
)
def proc_property(spark, sf):
    return op.proc_property(_proc(spark, sf)).select(
        "token_cliente", "dt_abate", "nr_unidade_abate", "prod_cpf_cnpj"
    )


@query(
    "proc_animal",
    f"""WITH {SOLD}
    SELECT DISTINCT animal_id AS id, token_cliente, animal_codigo AS codigo FROM sold
    WHERE animal_id IS NOT NULL""",
)
def proc_animal(spark, sf):
    return op.proc_animal(_proc(spark, sf), clock()).drop("dt_processamento")


@query(
    "proc_sale_property",
    f"""WITH {SOLD}
    SELECT DISTINCT propriedade_id, registro_id AS registro_venda_id FROM sold
    WHERE propriedade_id IS NOT NULL""",
)
def proc_sale_property(spark, sf):
    return op.proc_sale_property(_proc(spark, sf))


@query(
    "sale_trace",
    f"""WITH {SOLD} SELECT {_PROC} FROM sold
    WHERE token_cliente = '{TENANT}' AND o_orderstatus = 'O'""",
)
def sale_trace(spark, sf):
    rows = sale_rows(
        b.sales(spark, sf), _traced(spark, sf), *_lookups(spark, sf),
        token=TENANT, limit=None, now=clock(),
    )
    return rows.select(*_PROC_COLS)


@query(
    "sale_trace_marked",
    f"""WITH {SOLD}, done AS (SELECT DISTINCT registro_id FROM sold
      WHERE grupo_id = 2 AND o_orderstatus = 'O')
    SELECT CAST(o_orderkey AS VARCHAR) AS id,
      CASE WHEN CAST(o_orderkey AS VARCHAR) IN (SELECT registro_id FROM done) THEN TRUE
        WHEN o_orderstatus = 'F' THEN TRUE WHEN o_orderstatus = 'O' THEN FALSE END
        AS flag_processada,
      CAST(o_orderkey AS VARCHAR) IN (SELECT registro_id FROM done) AS carimbada
    FROM orders""",
)
def sale_trace_marked(spark, sf):
    run = run_sale_trace(
        b.sales(spark, sf), _traced(spark, sf), *_lookups(spark, sf),
        grupo_id=2, limit=None, now=clock(),
    )
    return run.sales.select(
        "id", "flag_processada", F.col("data_hora_processada").isNotNull().alias("carimbada")
    )


@query(
    "proc_sale_header_all",
    f"""WITH {SOLD}
    SELECT DISTINCT registro_id AS id, token_cliente,
      '00000000000000' AS nf_destino_cpf_cnpj, '00000000000000' AS cnpj_local_estoque,
      DATE '{CLOCK[:10]}' AS dt_venda, DATE '{CLOCK[:10]}' AS dt_expedicao,
      '00000000000000' AS cnpj_transportadora, '' AS nf_numero, 'VENDA' AS nf_natureza,
      'Venda' AS nf_origem_nome_razaosocial, '00000000000000' AS nf_origem_cpf_cnpj,
      DATE '{CLOCK[:10]}' AS nf_dt_compra, DATE '{CLOCK[:10]}' AS nf_dt_emissao,
      DATE '{CLOCK[:10]}' AS nf_dt_pedido, '{CLOCK}' AS data_hora_processada,
      '{{}}' AS json_itens, '{{}}' AS json_caixas, TRUE AS flag_web, 'Brasil' AS destino_pais,
      '{CLOCK}' AS created_at, '{CLOCK}' AS updated_at
    FROM sold""",
)
def proc_sale_header_all(spark, sf):
    """All 21 columns of the header."""
    header = op.proc_sale_header(_proc(spark, sf), clock())
    stamps = ("data_hora_processada", "created_at", "updated_at")
    return header.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps})
