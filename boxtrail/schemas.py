"""Declared schemas and the value tables every stage agrees on.

Payloads are always read with a declared schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, STAMP, FLAG = T.DateType(), T.TimestampType(), T.BooleanType()
JSON = T.VariantType()


def _struct(*runs: tuple[T.DataType, str]) -> T.StructType:
    """A schema from runs of neighbouring columns of one type."""
    return T.StructType([T.StructField(name, kind) for kind, names in runs for name in names.split()])


# --- fixed values: column names and types of the tables and payloads ---------

# One element of the animal envelope, as read. Scalars are read as text and
# cast later, so that one bad value costs its row and not its file. The five
# nested fields are read as variants and come out as JSON text.
ANIMAL_RAW = _struct(
    (TEXT,
     "id codigo_fazenda codigo_animal tipo_animal raca codigo_lote codigo_piquete "
     "data_nascimento data_entrada categoria origem"),
    (JSON, "classificacao"),
    (TEXT,
     "lote_anterior brinco numero sexo pai peso_nascimento peso_entrada "
     "data_ultima_pesagem status"),
    (JSON, "observacoes dados_adicionais"),
    (TEXT, "codigo_rastreabilidade"),
    (JSON, "pelagem geracao"),
    (TEXT,
     "grau_sangue peso_atual data_ultima_movimentacao data_entrada_lote data_criacao "
     "data_atualizacao data_exclusao"),
)

ANIMAL = _struct(
    (TEXT, "id codigo_fazenda codigo_animal"),
    (INT, "tipo_animal raca"),
    (TEXT, "codigo_lote codigo_piquete"),
    (STAMP, "data_nascimento data_entrada"),
    (INT, "categoria origem"),
    (TEXT, "classificacao lote_anterior brinco"),
    (INT, "numero"),
    (TEXT, "sexo pai"),
    (DOUBLE, "peso_nascimento peso_entrada"),
    (STAMP, "data_ultima_pesagem"),
    (INT, "status"),
    (TEXT, "observacoes dados_adicionais codigo_rastreabilidade pelagem geracao grau_sangue"),
    (DOUBLE, "peso_atual"),
    (STAMP,
     "data_ultima_movimentacao data_entrada_lote data_criacao data_atualizacao "
     "data_exclusao"),
)

# One flat animal object per file (raw layer).
RAW_ANIMAL = _struct(
    (TEXT, "id_animal"),
    (DATE, "data_nascimento"),
    (TEXT, "id_propriedade sexo raca"),
    (DOUBLE, "peso_nascimento"),
    (DATE, "data_entrada data_saida"),
    (TEXT, "status"),
    (_struct(
        (FLAG, "vacinado"),
        (T.ArrayType(_struct((TEXT, "tipo"), (DATE, "data"))), "vacinas"),
        (TEXT, "observacoes"),
    ), "dados_adicionais"),
)
RAW_ANIMAL_REQUIRED = (
    "id_animal", "data_nascimento", "id_propriedade", "sexo", "raca", "status",
)

SIMPLE_ANIMAL = _struct(
    (TEXT, "id identificacao"),
    (STAMP, "data_nascimento"),
    (TEXT, "sexo raca"),
    (DOUBLE, "peso"),
    (TEXT, "propriedade_id status"),
    (STAMP, "data_cadastro data_atualizacao"),
)
SIMPLE_ANIMAL_REQUIRED = ("id", "identificacao")

SLAUGHTER = _struct(
    (TEXT,
     "json_certificado json_classificacao_ia json_caracteristicas "
     "habilitacoes_etiqueta dt_nascimento"),
    (DOUBLE, "valor_ph"),
    (STAMP, "dt_fechamento_camera_abate dt_abertura_camera_abate"),
    (DATE, "dt_compra dt_abate"),
    (INT, "lote_abate id_destino_abate"),
    (TEXT, "motivos_dif"),
    (INT, "nr_sequencial nr_banda"),
    (DOUBLE, "peso_vivo peso_carcaca"),
    (STAMP, "hr_ultima_pesagem"),
    (FLAG, "flag_contusao"),
    (TEXT,
     "cnpj_industria_abate tipo_unidade_abate nr_unidade_abate prod_cpf_cnpj "
     "prod_nr_ie sexo nr_identificacao nr_chip cod_barra_abate"),
)

# Slaughter record: target column, source column, target type.
SLAUGHTER_MAPPING = (
    ("json_certificado", "json_certificado", "string"),
    ("json_classificacao_ia", "json_classificacao_ia", "string"),
    ("json_caracteristicas", "json_caracteristicas", "string"),
    ("json_habilitacoes", "json_habilitacoes", "string"),
    ("dt_nascimento", "dt_nascimento", "date"),
    ("valor_ph", "valor_ph", "decimal(18,6)"),
    ("dt_fechamento_camera_abate", "dt_fechamento_camera_abate", "timestamp"),
    ("dt_abertura_camera_abate", "dt_abertura_camera_abate", "timestamp"),
    ("created_at", "created_at", "timestamp"),
    ("updated_at", "updated_at", "timestamp"),
    ("dt_compra", "dt_compra", "date"),
    ("dt_abate", "dt_abate", "date"),
    ("nr_lote_abate", "lote_abate", "int"),
    ("id_destino_abate", "id_destino_abate", "int"),
    ("json_motivos_dif", "motivos_dif", "string"),
    ("nr_sequencial", "nr_sequencial", "int"),
    ("nr_banda", "nr_banda", "smallint"),
    ("peso_vivo", "peso_vivo", "decimal(18,6)"),
    ("peso_carcaca", "peso_carcaca", "decimal(18,6)"),
    ("hr_ultima_pesagem", "hr_ultima_pesagem", "timestamp"),
    ("flag_contusao", "flag_contusao", "smallint"),
    ("token_cliente", "token_cliente", "string"),
    ("cnpj_industria_abate", "cnpj_industria_abate", "string"),
    ("tipo_unidade_abate", "tipo_unidade_abate", "string"),
    ("nr_unidade_abate", "nr_unidade_abate", "string"),
    ("prod_cpf_cnpj", "prod_cpf_cnpj", "string"),
    ("prod_nr_ie", "prod_nr_ie", "string"),
    ("sexo", "sexo", "string"),
    ("nr_identificacao", "nr_identificacao", "string"),
    ("nr_chip", "nr_chip", "string"),
    ("codigo_barra_etiqueta", "cod_barra_abate", "string"),
)

SCHEDULE = _struct(
    (LONG, "cod_empresa"),
    (DATE, "dt_abate"),
    (TEXT, "cnpj_industria_abate tipo_unidade_abate nr_unidade_abate"),
    (LONG, "nr_lote_abate"),
    (TEXT, "nr_op"),
    (LONG, "nr_seq_abate"),
    (TEXT, "nr_currais nr_ordem_compra"),
    (LONG, "qtde_animais"),
    (DATE, "dt_compra"),
    (TEXT,
     "cnpj_empresa_ambiental hash_analise_ambiental hash_lista_ibama hash_lista_te "
     "prod_nome_razaosocial"),
    (LONG, "id_fornecedor"),
    (TEXT,
     "prod_cpf_cnpj prod_nr_ie prod_nr_rg prod_tipo prod_endereco prod_cidade "
     "prod_estado prod_cep"),
    (LONG, "faz_id"),
    (TEXT, "faz_nome faz_endereco faz_cidade faz_estado faz_cep"),
    (DOUBLE, "faz_geo_latitude faz_geo_longitude"),
    (TEXT,
     "faz_nr_car faz_nr_incra faz_nr_nirf faz_nr_sisbov faz_nr_lar_lau "
     "faz_nr_licenca_ambiental faz_nr_licenca_operacao status_analise_propriedade"),
    (T.ArrayType(_struct((TEXT, "placa_veiculo"))), "caminhoes"),
    (T.ArrayType(_struct((TEXT, "nr_gta"))), "gtas"),
    (T.ArrayType(_struct(
        (TEXT,
         "numero natureza origem_nome_razaosocial origem_cpf_cnpj origem_estado "
         "destino_nome_razaosocial destino_cpf_cnpj destino_estado destino_pais"),
        (STAMP, "dt_compra dt_emissao"),
        (TEXT, "chave xml"),
        (T.ArrayType(_struct(
            (LONG, "qtde"), (TEXT, "descricao un_medida"), (LONG, "total"), (TEXT, "ncm"),
        )), "itens"),
    )), "nfs"),
)

BOX = _struct(
    (TEXT, "id token_cliente"),
    (DATE, "dt_producao"),
    (TEXT, "nr_unidade_desossa nr_op_desossa"),
    (DATE, "dt_abate"),
    (TEXT, "nr_unidade_abate codigo"),
    (DOUBLE, "peso"),
    (TEXT, "json_desossa json_propriedades json_animais"),
    (FLAG, "flag_processamento flag_desossa flag_propriedades flag_animais flag_rastreavel"),
    (STAMP, "updated_at"),
)

STAGE_FLAGS = ("flag_desossa", "flag_propriedades", "flag_animais")

PROC_BOX = _struct(
    (TEXT,
     "id proc_resgistro_venda_id token_cliente tipo_unidade_desossa nr_unidade_desossa "
     "cnpj_industria_desossa nr_op_desossa nr_unidade_abate tipo_unidade_abate "
     "cnpj_industria_abate"),
    (DATE, "dt_abate dt_producao dt_embalagem dt_validade"),
    (STAMP, "dt_hora_inicio_desossa"),
    (INT, "qtde_pecas"),
    (DOUBLE, "peso_liquido peso_bruto"),
    (TEXT, "tipo_embalagem"),
    (DOUBLE, "tara_primaria tara_total"),
    (TEXT, "codigo_rastreabilidade_ind cogido_palete tipo_armazenamento"),
    (STAMP, "dt_hora_pesagem"),
    (TEXT, "codigo_barras json_habilitacoes"),
    (STAMP, "created_at updated_at"),
    (TEXT, "tipo_caixa_id"),
)
PROC_BOX_RENAMES = {
    "tipo_unidade_desossa_id": "tipo_unidade_desossa",
    "tipo_unidade_abate_id": "tipo_unidade_abate",
}

SALE_BOXES = T.ArrayType(_struct((TEXT, "id codigo peso")))

PROPERTY_COLUMNS = (
    "token_cliente", "dt_abate", "nr_unidade_abate", "nr_lote_abate",
    "prod_nome_razaosocial", "prod_cpf_cnpj", "faz_nome", "faz_cidade",
    "faz_estado", "faz_nr_car", "json_certificados", "json_gtas", "json_nfs",
)
PROPERTY_REQUIRED = ("token_cliente", "dt_abate", "nr_unidade_abate", "prod_cpf_cnpj")

# Sale header: constant columns, in table order around the date columns.
SALE_HEADER_ZERO_IDS = (
    "nf_destino_cpf_cnpj", "cnpj_local_estoque", "cnpj_transportadora",
    "nf_origem_cpf_cnpj",
)
SALE_HEADER_ZERO_ID = "00000000000000"
SALE_HEADER_DATES = (
    "dt_venda", "dt_expedicao", "nf_dt_compra", "nf_dt_emissao", "nf_dt_pedido",
)
SALE_HEADER_TEXT = {
    "nf_numero": "",
    "nf_natureza": "VENDA",
    "nf_origem_nome_razaosocial": "Venda",
    "json_itens": "{}",
    "json_caixas": "{}",
    "destino_pais": "Brasil",
}
SALE_HEADER_COLUMNS = (
    "token_cliente", "nf_destino_cpf_cnpj", "cnpj_local_estoque", "dt_venda",
    "dt_expedicao", "cnpj_transportadora", "nf_numero", "nf_natureza",
    "nf_origem_nome_razaosocial", "nf_origem_cpf_cnpj", "nf_dt_compra",
    "nf_dt_emissao", "nf_dt_pedido", "data_hora_processada", "json_itens",
    "json_caixas", "flag_web", "destino_pais",
)

RUN_LOG = _struct(
    (LONG, "id"),
    (STAMP, "data_hora"),
    (TEXT, "tipo_payload camada nome_arquivo status mensagem detalhes"),
    (INT, "duracao_ms registros_processados registros_invalidos"),
    (TEXT, "usuario hostname versao_script"),
)
STATUS_OK = "sucesso"
STATUS_ERROR = "erro"
STATUS_WARNING = "alerta"
STATUS_STARTED = "iniciado"
STATUS_FINISHED = "finalizado"

# Labels of the flag relationship report.
LABEL_COMPLETE = "Todas flags true"
LABEL_LINKED_ONLY = "Desossa true, outras false"
LABEL_UNLINKED = "Desossa false"
LABEL_OTHER = "Outros casos"

LAKE_PARTITIONS = ("ano", "mes", "dia")
LAKE_FORMATS = ("csv", "parquet", "json")
# --- end of fixed values ------------------------------------------------------
