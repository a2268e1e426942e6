"""Gold tables: municipality x industry profile and the two scored rankings.

Each is made from the rows of the market table, or with `of=STATES` from its `market_states`: those
read the table once for all three."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.aggregates import grouped_medians, ratio
from marketlens.operators.ranking import global_rank, minmax, share_of_parent, weighted_score
from marketlens.operators.states import ROWS, STATES, partial_states
from marketlens.schemas import (
    CNAE_WEIGHTS,
    MUNICIPIO_CNAE_SCHEMA,
    MUNICIPIO_WEIGHTS,
    RANKING_CNAES_SCHEMA,
    RANKING_MUNICIPIOS_SCHEMA,
)
from marketlens.session import durable

_CELL = ("uf", "municipio", "cnae_principal", "descricao_cnae")


def market_states(silver: DataFrame) -> DataFrame:
    """Partial states of the market table, from which all gold tables are rolled up."""
    return partial_states(silver, _CELL, ["capital_social"], ["idade_empresa_anos"], ["populacao", "pib_per_capita"])


def municipio_cnae(silver: DataFrame, parent: Sequence[str] = ("municipio",), of=ROWS) -> DataFrame:
    """Counts, share of the municipality, density, capital and age per municipality and
    industry."""
    cells = silver.groupBy(*_CELL).agg(
        of.count().alias("total_empresas_ativas"),
        of.money("capital_social").alias("capital_social_total"),
        of.mean("idade_empresa_anos").alias("idade_media_empresas"),
        F.max("populacao").alias("populacao"),
    )
    rows = F.sum("n") if of is STATES else None
    medians = grouped_medians(silver, _CELL, ("capital_social", "idade_empresa_anos"), rows).select(
        F.struct(*_CELL).alias("_cell"),
        F.col("capital_social").alias("capital_social_mediano"),
        F.col("idade_empresa_anos").alias("idade_mediana_empresas"),
    )
    joined = cells.withColumn("_cell", F.struct(*_CELL)).join(medians, "_cell", "left").drop("_cell")
    shared = share_of_parent(joined, "total_empresas_ativas", parent, "participacao_cnae_no_municipio")
    return shared.withColumn(
        "empresas_por_10k_habitantes", ratio(F.col("total_empresas_ativas") * F.lit(10000.0), F.col("populacao"))
    ).select(*MUNICIPIO_CNAE_SCHEMA.fieldNames())


def municipio_features(silver: DataFrame, of=ROWS) -> DataFrame:
    """One row per municipality with the six raw features."""
    base = silver.groupBy("municipio").agg(
        F.max("populacao").alias("populacao"),
        F.max("pib_per_capita").alias("pib_per_capita"),
        of.count().alias("total_empresas_ativas"),
        F.count_distinct("cnae_principal").alias("total_cnaes_distintos"),
        of.money("capital_social").alias("capital_social_total"),
    )
    return base.withColumn(
        "empresas_por_10k_habitantes", ratio(F.col("total_empresas_ativas") * F.lit(10000.0), F.col("populacao"))
    )


def minmax_municipios(silver: DataFrame, of=ROWS) -> DataFrame:
    return minmax(
        durable(municipio_features(silver, of)),
        {
            "n_populacao": "populacao",
            "n_pib": "pib_per_capita",
            "n_empresas": "total_empresas_ativas",
            "n_densidade": "empresas_por_10k_habitantes",
            "n_diversidade": "total_cnaes_distintos",
            "n_capital": "capital_social_total",
        },
    )


def ranking_municipios(silver: DataFrame, weights: Mapping[str, float] = MUNICIPIO_WEIGHTS, of=ROWS) -> DataFrame:
    """Municipalities by opportunity score, best first; equal scores rank by name."""
    scored = minmax_municipios(silver, of).withColumn("score_oportunidade", weighted_score(weights))
    columns = [c for c in RANKING_MUNICIPIOS_SCHEMA.fieldNames() if c != "posicao_ranking"]
    order = [F.desc_nulls_last("score_oportunidade"), F.asc_nulls_last("municipio")]
    return global_rank(scored.select(*columns), order, "posicao_ranking").orderBy("posicao_ranking")


def cnae_features(silver: DataFrame, of=ROWS) -> DataFrame:
    """One row per industry with its raw features."""
    return silver.groupBy("cnae_principal", "descricao_cnae").agg(
        of.count().alias("total_empresas_ativas"),
        F.count_distinct("municipio").alias("total_municipios_com_presenca"),
        of.money("capital_social").alias("capital_social_total"),
        of.mean("idade_empresa_anos").alias("idade_media_empresas"),
    )


def minmax_cnaes(silver: DataFrame, of=ROWS) -> DataFrame:
    return minmax(
        durable(cnae_features(silver, of)),
        {
            "n_empresas": "total_empresas_ativas",
            "n_presenca": "total_municipios_com_presenca",
            "n_capital": "capital_social_total",
        },
    )


def cnae_order() -> list[Column]:
    """Best score first, then by code."""
    return [F.desc_nulls_last("score_relevancia"), F.asc_nulls_last("cnae_principal"), F.asc_nulls_last("descricao_cnae")]


def ranking_cnaes(silver: DataFrame, weights: Mapping[str, float] = CNAE_WEIGHTS, of=ROWS) -> DataFrame:
    """Industries by relevance score, best first."""
    scored = minmax_cnaes(silver, of).withColumn("score_relevancia", weighted_score(weights))
    return scored.select(*RANKING_CNAES_SCHEMA.fieldNames()).orderBy(*cnae_order())
