"""The domain tables, derived from the generated test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxtrail.schemas import BOX


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _tenant(column: str) -> Column:
    return F.concat(F.lit("t"), (F.col(column) % 3).cast("string"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber") % 3
    flag = F.col("l_returnflag")
    quantity, tax = F.col("l_quantity"), F.col("l_tax")
    known = {
        "id": F.concat(_text("l_orderkey"), F.lit("-"), _text("l_linenumber")),
        "token_cliente": _tenant("l_suppkey"),
        "dt_producao": F.col("l_shipdate").cast("date"),
        "nr_unidade_desossa": F.col("l_linestatus"),
        "nr_op_desossa": _text("l_orderkey"),
        "codigo": _text("l_partkey"),
        "peso": quantity,
        "flag_processamento": F.col("l_discount") < 0.05,
        "flag_desossa": F.when(flag == "R", True).when(flag == "A", False),
        "flag_propriedades": F.when(line == 0, False).when(line == 1, True),
        "flag_animais": F.when(quantity >= 25, True).when(quantity >= 5, False),
        "flag_rastreavel": F.when(tax > 0.06, True).when(tax > 0, False),
    }
    return table(spark, sf_dir, "lineitem").select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in BOX]
    )


def _slaughter_keys() -> list[Column]:
    return [
        F.col("o_orderdate").cast("date").alias("dt_abate"),
        (F.col("o_custkey") % 4).cast("string").alias("nr_unidade_abate"),
    ]


def deboning(spark: SparkSession, sf_dir: str, with_tenant: bool = False) -> DataFrame:
    tenant = [_tenant("o_custkey").alias("token_cliente")] if with_tenant else []
    return table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("id"),
        _text("o_custkey").alias("lote"),
        *tenant,
        F.col("o_orderstatus").alias("nr_unidade_desossa"),
        _text("o_orderkey").alias("nr_op_desossa"),
        *_slaughter_keys(),
    )


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return rows.select(
        _text("o_orderkey").alias("id"), *_slaughter_keys(), _text("o_custkey").alias("prod_cpf_cnpj")
    )


def animals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "2-HIGH")
    return rows.select(
        _text("o_orderkey").alias("id"),
        _text("o_custkey").alias("codigo"),
        *_slaughter_keys(),
    )


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("id"), F.col("c_name").alias("nome")
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sales. Each names a few boxes of its own order number, so the
    list is built from the row alone; the priority decides how it is written."""
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")

    def box(pad: str):
        def one(n: Column) -> Column:
            name = F.concat(F.lit(pad), key.cast("string"), F.lit("-"), n.cast("string"), F.lit(pad))
            return F.struct(name.alias("id"), n.cast("string").alias("codigo"))
        return one

    lines = F.sequence(F.lit(1), (F.lit(1) + key % 7).cast("int"))
    plain = F.to_json(F.transform(lines, box("")))
    padded = F.to_json(F.transform(lines, box(" ")))
    single = F.to_json(box("")(F.lit(1)))
    text = (
        F.when(priority == "2-HIGH", padded)
        .when(priority == "3-MEDIUM", single)
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("["), single))
        .otherwise(plain)
    )
    return table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("id"),
        _tenant("o_custkey").alias("token_cliente"),
        (F.col("o_custkey") % 5).cast("int").alias("grupo_id"),
        F.when(status == "F", True).when(status == "O", False).alias("flag_processada"),
        F.lit(None).cast("timestamp").alias("data_hora_processada"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        text.alias("json_caixas"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    bad = F.col("event_type") == "error"
    return rows.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("data_hora"),
        F.col("event_type").alias("tipo_payload"),
        F.lit("raw").alias("camada"),
        F.concat(F.lit("u"), _text("user_id")).alias("nome_arquivo"),
        F.when(bad, "erro").otherwise("sucesso").alias("status"),
        F.lit(None).cast("string").alias("mensagem"),
        F.col("props").alias("detalhes"),
        F.floor("value").cast("int").alias("duracao_ms"),
        F.get_json_object("props", "$.k").cast("int").alias("registros_processados"),
        F.when(bad, 1).otherwise(0).alias("registros_invalidos"),
    )
