"""The wide table of active establishments with company, dimension and indicator columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.text import age_years, cnpj_key, empty_to_null, parse_br_number, parse_yyyymmdd, porte_label
from marketlens.operators.keys import dedup_dim
from marketlens.schemas import INDICATOR_COLUMNS, SILVER_SCHEMA
from marketlens.session import broadcast_if_small, durable


def establishments(estab: DataFrame) -> DataFrame:
    return estab.select(
        "cnpj_basico",
        "cnpj_ordem",
        "cnpj_dv",
        cnpj_key("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj_completo"),
        "nome_fantasia",
        "situacao_cadastral",
        parse_yyyymmdd("data_inicio_atividade").alias("data_inicio_atividade"),
        F.col("cnae_fiscal_principal").alias("cnae_principal"),
        "uf",
        F.col("municipio").alias("codigo_municipio_receita"),
    )


def companies(emp: DataFrame, style: str = "br") -> DataFrame:
    return emp.select(
        "cnpj_basico",
        "razao_social",
        "natureza_juridica",
        porte_label("porte_empresa").alias("porte_empresa"),
        parse_br_number("capital_social", style).alias("capital_social"),
    )


def indicator_rollup(indicators: DataFrame, style: str = "br") -> DataFrame:
    """Code, population and GDP per head of each normalised municipality name."""
    return indicators.groupBy("municipio_norm").agg(
        F.max(empty_to_null("codigo_municipio_ibge")).alias("codigo_municipio_ibge"),
        F.max(parse_br_number("populacao", style)).alias("populacao"),
        F.max(parse_br_number("pib_per_capita", style)).alias("pib_per_capita"),
    )


def last_per_code(df: DataFrame, value: str, seq: str = "seq") -> DataFrame:
    """The last row of each municipality code in the order of `seq`."""
    last = df.filter(F.coalesce(F.col("codigo_municipio_ibge"), F.lit("")) != "").groupBy("codigo_municipio_ibge").agg(
        F.max_by(F.struct("municipio_norm", value), F.col(seq)).alias("row")
    )
    return last.select("codigo_municipio_ibge", "row.municipio_norm", f"row.{value}")


def merge_indicators(pib: DataFrame, pop: DataFrame) -> DataFrame:
    """GDP and population tables as one indicator table, one row per code on either side;
    the GDP side names the municipality where it has the code."""
    a = last_per_code(pib, "pib_per_capita")
    b = last_per_code(pop, "populacao").withColumnRenamed("municipio_norm", "pop_norm")
    joined = a.join(b, "codigo_municipio_ibge", "full_outer")
    return joined.select(
        F.coalesce("municipio_norm", "pop_norm", F.lit("")).alias("municipio_norm"),
        "codigo_municipio_ibge",
        F.lit("").alias("cnae_principal"),
        F.coalesce("populacao", F.lit("")).alias("populacao"),
        F.coalesce("pib_per_capita", F.lit("")).alias("pib_per_capita"),
    ).select(*INDICATOR_COLUMNS)


def owners(emp: DataFrame, naturezas: DataFrame, simples: DataFrame, style: str = "br") -> DataFrame:
    """Companies with their legal form and tax regime."""
    nat = broadcast_if_small(
        dedup_dim(naturezas.select("natureza_juridica", "descricao_natureza_juridica"), "natureza_juridica")
    )
    regimes = dedup_dim(simples.select("cnpj_basico", "opcao_simples", "opcao_mei"), "cnpj_basico")
    return companies(emp, style).join(regimes, "cnpj_basico", "left").join(nat, "natureza_juridica", "left")


def build_silver(
    estab: DataFrame,
    emp: DataFrame,
    municipios: DataFrame,
    cnaes: DataFrame,
    naturezas: DataFrame,
    simples: DataFrame,
    indicators: DataFrame,
    as_of,
    style: str = "br",
    stored_owners: DataFrame | None = None,
) -> DataFrame:
    """Join active establishments with their companies (inner) and the five dimensions (left).

    Tax regimes go to the companies first, which are stored. The one large join is then
    between two scans, which AQE splits where a company holds many of the establishments.
    The code tables are broadcast if the sizes of their files allow it; nothing is run for that.
    Storing the companies is the only job before the plan's own; `stored_owners` are `owners` that
    are stored already, for instance by key as the establishments are, and then nothing is shuffled."""
    mun = dedup_dim(municipios.select("codigo_municipio_receita", "nome_municipio_receita", "municipio_norm"), "codigo_municipio_receita")
    places = broadcast_if_small(
        mun.join(indicator_rollup(indicators, style), "municipio_norm", "left").select(
            "codigo_municipio_receita",
            F.col("nome_municipio_receita").alias("municipio"),
            "codigo_municipio_ibge",
            "populacao",
            "pib_per_capita",
        )
    )
    cnae = broadcast_if_small(
        dedup_dim(cnaes.select(F.col("cnae").alias("cnae_principal"), "descricao_cnae"), "cnae_principal")
    )
    owned = durable(owners(emp, naturezas, simples, style)) if stored_owners is None else stored_owners
    return (
        establishments(estab)
        .join(owned, "cnpj_basico", "inner")
        .join(places, "codigo_municipio_receita", "left")
        .join(cnae, "cnae_principal", "left")
        .withColumn("cnae_fiscal_principal", F.col("cnae_principal"))
        .withColumn("idade_empresa_anos", age_years("data_inicio_atividade", as_of))
        .select(*SILVER_SCHEMA.fieldNames())
    )
