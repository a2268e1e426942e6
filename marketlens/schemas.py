"""Table layouts, fixed code tables and tunable parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The positional layouts of the public registry dump, one per file kind.
LAYOUTS: dict[str, tuple[str, ...]] = {
    "estabelecimentos": (
        "cnpj_basico",
        "cnpj_ordem",
        "cnpj_dv",
        "identificador_matriz_filial",
        "nome_fantasia",
        "situacao_cadastral",
        "data_situacao_cadastral",
        "motivo_situacao_cadastral",
        "nome_cidade_exterior",
        "pais",
        "data_inicio_atividade",
        "cnae_fiscal_principal",
        "cnae_fiscal_secundaria",
        "tipo_logradouro",
        "logradouro",
        "numero",
        "complemento",
        "bairro",
        "cep",
        "uf",
        "municipio",
        "ddd_1",
        "telefone_1",
        "ddd_2",
        "telefone_2",
        "ddd_fax",
        "fax",
        "correio_eletronico",
        "situacao_especial",
        "data_situacao_especial",
    ),
    "empresas": (
        "cnpj_basico",
        "razao_social",
        "natureza_juridica",
        "qualificacao_responsavel",
        "capital_social",
        "porte_empresa",
        "ente_federativo_responsavel",
    ),
    "cnaes": ("cnae", "descricao_cnae"),
    "municipios": ("codigo_municipio_receita", "nome_municipio_receita"),
    "naturezas": ("natureza_juridica", "descricao_natureza_juridica"),
    "motivos": ("motivo_situacao_cadastral", "descricao_motivo_situacao_cadastral"),
    "simples": (
        "cnpj_basico",
        "opcao_simples",
        "data_opcao_simples",
        "data_exclusao_simples",
        "opcao_mei",
        "data_opcao_mei",
        "data_exclusao_mei",
    ),
}

INDICATOR_COLUMNS = (
    "municipio_norm",
    "codigo_municipio_ibge",
    "cnae_principal",
    "populacao",
    "pib_per_capita",
)

# Size-class codes of the registry.
PORTE_LABELS = {
    "00": "Nao informado",
    "01": "Microempresa",
    "03": "Empresa de pequeno porte",
    "05": "Demais",
}

ACTIVE_CODES = ("02", "2")
RAW_SEPARATOR = ";"
RAW_ENCODING = "ISO-8859-1"
PARTS_PER_KIND = 10

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("cnpj_basico", T.StringType()),
        T.StructField("cnpj_ordem", T.StringType()),
        T.StructField("cnpj_dv", T.StringType()),
        T.StructField("cnpj_completo", T.StringType()),
        T.StructField("razao_social", T.StringType()),
        T.StructField("nome_fantasia", T.StringType()),
        T.StructField("situacao_cadastral", T.StringType()),
        T.StructField("uf", T.StringType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("codigo_municipio_receita", T.StringType()),
        T.StructField("codigo_municipio_ibge", T.StringType()),
        T.StructField("cnae_fiscal_principal", T.StringType()),
        T.StructField("cnae_principal", T.StringType()),
        T.StructField("descricao_cnae", T.StringType()),
        T.StructField("natureza_juridica", T.StringType()),
        T.StructField("descricao_natureza_juridica", T.StringType()),
        T.StructField("porte_empresa", T.StringType()),
        T.StructField("capital_social", T.DoubleType()),
        T.StructField("data_inicio_atividade", T.DateType()),
        T.StructField("idade_empresa_anos", T.LongType()),
        T.StructField("opcao_simples", T.StringType()),
        T.StructField("opcao_mei", T.StringType()),
        T.StructField("populacao", T.DoubleType()),
        T.StructField("pib_per_capita", T.DoubleType()),
    ]
)

MUNICIPIO_CNAE_SCHEMA = T.StructType(
    [
        T.StructField("uf", T.StringType()),
        T.StructField("municipio", T.StringType()),
        T.StructField("cnae_principal", T.StringType()),
        T.StructField("descricao_cnae", T.StringType()),
        T.StructField("total_empresas_ativas", T.LongType()),
        T.StructField("participacao_cnae_no_municipio", T.DoubleType()),
        T.StructField("empresas_por_10k_habitantes", T.DoubleType()),
        T.StructField("capital_social_total", T.DoubleType()),
        T.StructField("capital_social_mediano", T.DoubleType()),
        T.StructField("idade_media_empresas", T.DoubleType()),
        T.StructField("idade_mediana_empresas", T.DoubleType()),
    ]
)

RANKING_MUNICIPIOS_SCHEMA = T.StructType(
    [
        T.StructField("municipio", T.StringType()),
        T.StructField("populacao", T.DoubleType()),
        T.StructField("pib_per_capita", T.DoubleType()),
        T.StructField("total_empresas_ativas", T.LongType()),
        T.StructField("total_cnaes_distintos", T.LongType()),
        T.StructField("empresas_por_10k_habitantes", T.DoubleType()),
        T.StructField("capital_social_total", T.DoubleType()),
        T.StructField("score_oportunidade", T.DoubleType()),
        T.StructField("posicao_ranking", T.LongType()),
    ]
)

RANKING_CNAES_SCHEMA = T.StructType(
    [
        T.StructField("cnae_principal", T.StringType()),
        T.StructField("descricao_cnae", T.StringType()),
        T.StructField("total_empresas_ativas", T.LongType()),
        T.StructField("total_municipios_com_presenca", T.LongType()),
        T.StructField("capital_social_total", T.DoubleType()),
        T.StructField("idade_media_empresas", T.DoubleType()),
        T.StructField("score_relevancia", T.DoubleType()),
    ]
)

QUALITY_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("validacao", "valor", "status", "detalhe")]
)

GOLD_SCHEMAS = {
    "gold_empresas_ativas": SILVER_SCHEMA,
    "gold_municipio_cnae": MUNICIPIO_CNAE_SCHEMA,
    "gold_ranking_municipios": RANKING_MUNICIPIOS_SCHEMA,
    "gold_ranking_cnaes": RANKING_CNAES_SCHEMA,
    "gold_qualidade_dados": QUALITY_SCHEMA,
}

# Weights of the two scores, normalised feature -> weight.
MUNICIPIO_WEIGHTS = {
    "n_populacao": 0.20,
    "n_pib": 0.20,
    "n_empresas": 0.20,
    "n_densidade": 0.15,
    "n_diversidade": 0.15,
    "n_capital": 0.10,
}
CNAE_WEIGHTS = {"n_empresas": 0.45, "n_presenca": 0.35, "n_capital": 0.20}


@dataclass(frozen=True)
class Thresholds:
    """Limits of the blocking rules; the defaults are the published ones."""

    min_ativos: int = 100_000
    min_municipios: int = 100
    min_cnaes_descritos: int = 1_000
    min_match_empresas: float = 80.0
    min_match_cnaes: float = 80.0
    min_registros_uf: int = 100_000
    top_ufs: int = 10
    max_estranhas_abs: int = 1_000
    max_estranhas_fracao: float = 0.01
    top_estranhas: int = 20


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
