"""JSON payload files derived from the generated test tables.

Each document is built from one source row, so writing them needs no
grouping. Files lie in folders ``lote=...``, as they would arrive in batches.
Whole files hold the documents of a run of keys. All are compressed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from boxtrail.bindings import table
from boxtrail.session import scratch_path

LOT = "lote"

#: Where a document takes its columns from: the row, or a struct that holds one.
Source = Callable[[str], Column]


def _text(name: str, c: Source = F.col) -> Column:
    return c(name).cast("string")


def _number_or_text(bad: Column, number: Column) -> Column:
    """A JSON number, or a text where a number belongs."""
    return F.parse_json(F.when(bad, F.lit('"n/a"')).otherwise(number.cast("string")))


def _order_lot() -> Column:
    return F.concat("o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias(LOT)


def _simple_animal(c: Source) -> list[Column]:
    status, priority = c("o_orderstatus"), c("o_orderpriority")
    return [
        F.when(~((status == "P") & (priority == "5-LOW")), _text("o_orderkey", c)).alias("id"),
        F.when(
            ~((status == "O") & (priority == "4-NOT SPECIFIED")),
            F.concat(F.lit("B"), _text("o_custkey", c)),
        ).alias("identificacao"),
        F.date_format(c("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss").alias("data_nascimento"),
        F.when(status == "F", "F").otherwise("M").alias("sexo"),
        priority.alias("raca"),
        c("o_totalprice").alias("peso"),
        _text("o_custkey", c).alias("propriedade_id"),
        F.struct(status.alias("codigo")).alias("status"),
    ]


def simple_animals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-field animals; some lack the id or the tag."""
    return table(spark, sf_dir, "orders").select(*_simple_animal(F.col), _order_lot())


def _envelope(c: Source) -> Column:
    priority, status = c("o_orderpriority"), c("o_orderstatus")
    no_id = (status == "P") & (priority == "5-LOW")

    def animal(n: int) -> Column:
        bad_breed = F.lit(n == 2) & (priority == "2-HIGH")
        day = F.date_format(c("o_orderdate"), "yyyy-MM-dd")
        return F.struct(
            F.when(~no_id, F.concat(_text("o_orderkey", c), F.lit(f"-{n}"))).alias("id"),
            _text("o_custkey", c).alias("codigo_fazenda"),
            F.lit(n).alias("tipo_animal"),
            _number_or_text(bad_breed, c("o_custkey") % 10).alias("raca"),
            (day if n == 1 else F.concat(day, F.lit("T03:00:00Z"))).alias("data_nascimento"),
            F.lit("sem data").alias("data_entrada"),
            F.struct(F.lit(n).alias("id"), status.alias("descricao")).alias("classificacao"),
            F.when(F.lit(n == 1), F.struct(status.alias("nota"))).alias("observacoes"),
            F.round(c("o_totalprice"), 0).cast("bigint").alias("peso_atual"),
        )

    return F.when(priority != "3-MEDIUM", F.array(animal(1), animal(2)))


def animal_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two animals per document. In one lot every id is missing; with one
    priority the second animal has a text for its breed; with another the
    document has no animals at all."""
    return table(spark, sf_dir, "orders").select(_envelope(F.col).alias("animais"), _order_lot())


def slaughter_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """28-field records; line 7 carries a text where a number belongs."""
    return table(spark, sf_dir, "lineitem").select(
        F.struct(F.col("l_partkey").alias("id")).alias("json_certificado"),
        F.when(
            F.col("l_returnflag") == "R", F.struct(F.col("l_suppkey").alias("id"))
        ).alias("habilitacoes_etiqueta"),
        F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise("nao informada").alias("dt_nascimento"),
        F.col("l_tax").alias("valor_ph"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T12:00:00")).alias(
            "dt_fechamento_camera_abate"
        ),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt_abate"),
        F.col("l_linenumber").alias("lote_abate"),
        F.col("l_suppkey").alias("id_destino_abate"),
        _number_or_text(F.col("l_linenumber") == 7, F.col("l_linenumber")).alias("nr_banda"),
        F.col("l_quantity").alias("peso_vivo"),
        F.col("l_extendedprice").alias("peso_carcaca"),
        (F.col("l_returnflag") == "R").alias("flag_contusao"),
        F.col("l_linestatus").alias("nr_unidade_abate"),
        _text("l_orderkey").alias("prod_cpf_cnpj"),
        F.concat(_text("l_orderkey"), F.lit("-"), _text("l_linenumber")).alias("nr_identificacao"),
        _text("l_partkey").alias("cod_barra_abate"),
        F.col("l_returnflag").alias(LOT),
    )


def _flat_animal(c: Source) -> list[Column]:
    segment = c("c_mktsegment")
    return [
        F.when(
            segment != "MACHINERY", F.concat(F.lit("A"), _text("c_custkey", c))
        ).alias("id_animal"),
        F.date_format(
            F.date_add(F.lit("2020-01-01").cast("date"), c("c_nationkey")), "yyyy-MM-dd"
        ).alias("data_nascimento"),
        c("c_name").alias("id_propriedade"),
        F.when(c("c_nationkey") % 2 == 0, "M").otherwise("F").alias("sexo"),
        segment.alias("raca"),
        _number_or_text(segment == "FURNITURE", c("c_acctbal")).alias("peso_nascimento"),
        F.lit("ativo").alias("status"),
        F.struct(
            (c("c_acctbal") > 0).alias("vacinado"),
            F.array(F.struct(F.lit("V1").alias("tipo"), F.lit("2020-02-02").alias("data"))).alias(
                "vacinas"
            ),
            c("c_name").alias("observacoes"),
        ).alias("dados_adicionais"),
    ]


def flat_animals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat raw animals; one segment lacks the id, another has a bad weight."""
    return table(spark, sf_dir, "customer").select(
        *_flat_animal(F.col), F.col("c_mktsegment").alias(LOT)
    )


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slaughter schedules with none to three trucks and permits."""
    key = F.col("o_orderkey")
    n = (key % 4).cast("int")

    def children(build) -> Column:
        some = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), build)
        return F.slice(some, F.lit(1), n)

    def label(prefix: str, i: Column) -> Column:
        return F.concat(F.lit(prefix), key.cast("string"), F.lit("-"), i.cast("string"))

    item = F.struct(
        key.alias("qtde"), F.concat(F.lit("I"), key.cast("string")).alias("descricao")
    )
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt_abate"),
        (F.col("o_custkey") % 4).cast("string").alias("nr_unidade_abate"),
        key.alias("nr_lote_abate"),
        F.concat(F.lit("P"), _text("o_custkey")).alias("prod_nome_razaosocial"),
        _text("o_custkey").alias("prod_cpf_cnpj"),
        F.lit("").alias("prod_nr_ie"),
        children(lambda i: F.struct(label("T", i).alias("placa_veiculo"))).alias("caminhoes"),
        children(lambda i: F.struct(label("G", i).alias("nr_gta"))).alias("gtas"),
        F.array(
            F.struct(
                label("N", F.lit(1)).alias("numero"),
                F.lit("documento").alias("xml"),
                F.array(item, item).alias("itens"),
            )
        ).alias("nfs"),
        _order_lot(),
    )


#: Documents in one pretty-printed file: a few megabytes, as making and opening a file
#: takes as long as writing or reading some hundreds of documents.
PER_FILE = 2000
FILE_NR = "nr"
#: Pretty-printed files in one folder. One task writes a folder, one task lists it.
PER_FOLDER = 10
FOLDER = "pasta"
#: Documents in one file with a document per line. Compressed files cannot be split.
PER_LINES_FILE = 100_000
#: Folders a task writes to at once, before it sorts its rows by folder instead.
OPEN_FOLDERS = 32


def _by_file(rows: DataFrame, key: str, *more: str) -> DataFrame:
    """One row per file, with its rows as the array ``d``, ordered by folder.

    Files hold runs of the key, so that none gets more than ``PER_FILE`` different
    ones. The rows are moved and sorted as they are; documents, which are many times
    as large, are to be made of ``d`` afterwards.
    """
    nr = F.floor(F.col(key).cast("bigint") / PER_FILE)
    placed = rows.select(
        F.struct(*rows.columns).alias("r"),
        nr.alias(FILE_NR),
        F.floor(nr / PER_FOLDER).alias(FOLDER),
        *more,
    )
    files = placed.repartition(FOLDER).groupBy(FOLDER, FILE_NR, *more)
    return files.agg(F.collect_list("r").alias("d")).sortWithinPartitions(FOLDER)


def _pretty(documents: Column) -> Column:
    return F.to_json(documents, {"pretty": "true"}).alias("value")


def simple_animal_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-field animals as pretty-printed top-level arrays, the text of a file each."""
    files = _by_file(table(spark, sf_dir, "orders"), "o_orderkey")
    animals = F.transform("d", lambda r: F.struct(*_simple_animal(r.getField)))
    return files.select(_pretty(animals), FOLDER)


def animal_envelope_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per file, with the animals of many orders."""
    files = _by_file(table(spark, sf_dir, "orders"), "o_orderkey")
    both = F.array_compact(F.transform("d", lambda r: _envelope(r.getField)))
    return files.select(F.flatten(both).alias("animais"), FOLDER)


def flat_animal_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat animals of one segment as a pretty-printed array, the text of a file each.

    There is one animal per key, as where each has a file named after its key. What does
    not fit the schema makes its whole array unreadable. Bad weights, which are those of
    one segment, are therefore in files of their own.
    """
    customers = table(spark, sf_dir, "customer").dropDuplicates(["c_custkey"])
    files = _by_file(customers, "c_custkey", "c_mktsegment")
    animals = F.transform("d", lambda r: F.struct(*_flat_animal(r.getField)))
    return files.select(_pretty(animals), FOLDER)


@contextmanager
def _folders_at_once(spark: SparkSession) -> Iterator[None]:
    """Tasks write to all their folders as rows come, instead of sorting documents."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(name, None)
    spark.conf.set(name, OPEN_FOLDERS)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


@cache
def _written(app: str, spark: SparkSession, sf_dir: str, build) -> str:
    path = scratch_path(spark, build.__name__)
    rows = build(spark, sf_dir)
    writer = rows.write.mode("error").option("compression", "snappy")
    if LOT in rows.columns:
        with _folders_at_once(spark):
            writer.partitionBy(LOT).option("maxRecordsPerFile", PER_LINES_FILE).json(path)
        return path
    # each row is a file
    writer = writer.partitionBy(FOLDER).option("maxRecordsPerFile", 1)
    if rows.columns == ["value", FOLDER]:
        writer.text(path)
    else:
        writer.option("pretty", True).json(path)
    return path


def payload_dir(spark: SparkSession, sf_dir: str, build) -> str:
    """The folder with the payload files, written once per session."""
    return _written(spark.sparkContext.applicationId, spark, sf_dir, build)
