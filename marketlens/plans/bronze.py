"""From raw rows to the active establishments of one state and what belongs to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketlens.functions.text import empty_to_null, normalize_text
from marketlens.operators.aggregates import histogram, with_empty
from marketlens.operators.keys import keep_known_numbers
from marketlens.schemas import ACTIVE_CODES, LAYOUTS


def in_state(target_uf: str, column: str = "uf") -> Column:
    return F.coalesce(F.upper(F.trim(F.col(column))) == F.lit(target_uf), F.lit(False))


def is_active(active_codes: Sequence[str] = ACTIVE_CODES) -> Column:
    return F.coalesce(F.col("situacao_cadastral").isin(*active_codes), F.lit(False))


def filter_uf(estab: DataFrame, target_uf: str) -> DataFrame:
    return estab.filter(in_state(target_uf))


def filter_active(estab: DataFrame, active_codes: Sequence[str] = ACTIVE_CODES) -> DataFrame:
    return estab.filter(F.col("situacao_cadastral").isin(*active_codes))


def filter_target(estab: DataFrame, target_uf: str, active_codes: Sequence[str] = ACTIVE_CODES) -> DataFrame:
    return filter_active(filter_uf(estab, target_uf), active_codes)


def counted(estab: DataFrame, target_uf: str, observation: Observation, active_codes: Sequence[str] = ACTIVE_CODES) -> DataFrame:
    """The same rows; the funnel counts arrive with whatever action reads them."""
    return estab.observe(
        observation,
        F.count(F.lit(1)).alias("lidos"),
        F.count_if(in_state(target_uf)).alias("na_uf"),
        F.count_if(in_state(target_uf) & is_active(active_codes)).alias("ativos"),
    )


def ingest_funnel(estab: DataFrame, target_uf: str, active_codes: Sequence[str] = ACTIVE_CODES) -> DataFrame:
    """Rows read, in the state, active, and the distinct keys among the active: one row.

    Distinct counts run on the filtered rows only, so that the full scan is one pass of
    plain counters over two columns."""
    target = filter_target(estab, target_uf, active_codes)
    distinct = target.agg(
        F.struct(
            F.count_distinct(empty_to_null("cnpj_basico")).alias("empresas_unicas"),
            F.count_distinct(empty_to_null("municipio")).alias("municipios"),
            F.count_distinct(empty_to_null("cnae_fiscal_principal")).alias("cnaes"),
        ).alias("distinct")
    )
    counters = estab.agg(
        F.count(F.lit(1)).alias("lidos"),
        F.count_if(in_state(target_uf)).alias("na_uf"),
        F.count_if(in_state(target_uf) & is_active(active_codes)).alias("ativos"),
    )
    return counters.withColumn("_d", distinct.scalar()).select("lidos", "na_uf", "ativos", "_d.*")


def rows_by_source(df: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Rows of each source, 0 for those of `sources` (column source) that have none."""
    counts = histogram(df, "source", "source")
    return counts if sources is None else with_empty(counts, sources)


def status_histogram(estab: DataFrame, target_uf: str) -> DataFrame:
    """Rows per status, in the whole file and in the state, from one pass."""
    status = F.coalesce(F.col("situacao_cadastral"), F.lit(""))
    counts = estab.groupBy(status.alias("situacao_cadastral")).agg(
        F.count(F.lit(1)).alias("todos"), F.count_if(in_state(target_uf)).alias("uf")
    )
    long = counts.select(
        F.explode(
            F.array(
                F.struct(F.lit("todos").alias("escopo"), "situacao_cadastral", F.col("todos").alias("n")),
                F.struct(F.lit("uf").alias("escopo"), "situacao_cadastral", F.col("uf").alias("n")),
            )
        ).alias("row")
    )
    return long.select("row.*").filter(F.col("n") > 0)


def bronze_companies(emp: DataFrame, keys: DataFrame) -> DataFrame:
    """Companies owning an active establishment, given the stored keys of those."""
    return keep_known_numbers(emp, keys).select(*LAYOUTS["empresas"])


def bronze_simples(simples: DataFrame, keys: DataFrame) -> DataFrame:
    """Tax-regime rows of those companies."""
    return keep_known_numbers(simples, keys).select(*LAYOUTS["simples"])


def bronze_municipios(municipios: DataFrame) -> DataFrame:
    return municipios.select(
        *LAYOUTS["municipios"],
        empty_to_null(normalize_text("nome_municipio_receita")).alias("municipio_norm"),
    )
