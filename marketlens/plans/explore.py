"""Interactive questions on the gold tables: filters, search, facets, KPIs and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.display import code_label, fmt_br_money, fmt_br_number, label_code
from marketlens.operators.aggregates import histogram, histogram_medians, money_parts, ratio, sum_money, top
from marketlens.session import durable

# Display names of the three tables shown to users.
FRIENDLY_EMPRESAS = {
    "cnpj_completo": "CNPJ",
    "razao_social": "Razao social",
    "nome_fantasia": "Nome fantasia",
    "municipio": "Municipio",
    "cnae_principal": "CNAE principal",
    "descricao_cnae": "Descricao CNAE",
    "porte_empresa": "Porte",
    "capital_social": "Capital social",
    "idade_empresa_anos": "Idade da empresa",
}
FRIENDLY_MUNICIPIOS = {
    "municipio": "Municipio",
    "populacao": "Populacao",
    "pib_per_capita": "PIB per capita",
    "total_empresas_ativas": "Empresas ativas",
    "total_cnaes_distintos": "CNAEs distintos",
    "empresas_por_10k_habitantes": "Empresas por 10 mil hab.",
    "capital_social_total": "Capital social total",
    "score_oportunidade": "Score oportunidade",
    "posicao_ranking": "Posicao",
}
FRIENDLY_CNAES = {
    "cnae_principal": "CNAE principal",
    "descricao_cnae": "Descricao CNAE",
    "total_empresas_ativas": "Empresas ativas",
    "total_municipios_com_presenca": "Municipios com presenca",
    "capital_social_total": "Capital social total",
    "idade_media_empresas": "Idade media",
    "score_relevancia": "Score relevancia",
}

SEARCHED = ("razao_social", "nome_fantasia", "municipio", "descricao_cnae")
FACETS = ("municipio", "porte_empresa", "descricao_natureza_juridica", "opcao_simples", "opcao_mei")


@dataclass(frozen=True)
class Filters:
    """A user's selection. An empty choice or a missing range filters nothing; `cnae` takes
    `code - text` labels or plain codes."""

    municipio: Sequence[str] = ()
    cnae: Sequence[str] = ()
    porte: Sequence[str] = ()
    natureza: Sequence[str] = ()
    simples: Sequence[str] = ()
    mei: Sequence[str] = ()
    idade: tuple[float, float] | None = None
    capital: tuple[float, float] | None = None


def apply_filters(silver: DataFrame, f: Filters) -> DataFrame:
    choices = {
        "municipio": f.municipio,
        "cnae_principal": [label.split(" - ")[0] for label in f.cnae],
        "porte_empresa": f.porte,
        "descricao_natureza_juridica": f.natureza,
        "opcao_simples": f.simples,
        "opcao_mei": f.mei,
    }
    for column, chosen in choices.items():
        if chosen:
            silver = silver.filter(F.col(column).isin(*chosen))
    for column, bounds in {"idade_empresa_anos": f.idade, "capital_social": f.capital}.items():
        if bounds is not None:
            silver = silver.filter(F.coalesce(F.col(column), F.lit(0)).between(*bounds))
    return silver


def search(silver: DataFrame, term: str) -> DataFrame:
    """Rows holding `term` literally, upper-cased, in a name, municipality or industry."""
    if not term:
        return silver
    wanted = F.lit(term.upper())
    hit: Column = F.coalesce("cnae_principal", F.lit("")).contains(wanted)
    for column in SEARCHED:
        hit = hit | F.upper(F.coalesce(column, F.lit(""))).contains(wanted)
    return silver.filter(hit)


def kpis(silver: DataFrame) -> DataFrame:
    """Headline figures in one row. The mean GDP is over establishments, as shown to users.

    All of them come from one stored count per municipality, industry and age."""
    age = "idade_empresa_anos"
    cells = durable(
        silver.groupBy("municipio", "cnae_principal", age).agg(
            F.count(F.lit(1)).alias("n"),
            F.count("pib_per_capita").alias("n_pib"),
            *[part.alias(name) for c in ("pib_per_capita", "capital_social") for name, part in money_parts(c).items()],
        )
    )
    ages = cells.groupBy(F.lit("all").alias("group"), F.lit(age).alias("measure"), F.col(age).cast("double").alias("value"))
    median = histogram_medians(ages.agg(F.sum("n").alias("n")), ["group"]).select("median")

    def total(c: str) -> Column:
        return F.coalesce(F.sum(f"{c}_exact").cast("double"), F.lit(0.0)) + F.coalesce(F.sum(f"{c}_rest"), F.lit(0.0))

    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("empresas"),
        F.count_distinct("municipio").alias("municipios"),
        F.count_distinct("cnae_principal").alias("cnaes"),
        ratio(total("pib_per_capita"), F.sum("n_pib")).alias("pib_medio"),
        total("capital_social").alias("capital_total"),
    ).withColumn("idade_mediana", median.scalar())


def kpi_cards(values: DataFrame) -> DataFrame:
    """The figures of `kpis` as display text."""
    return values.select(
        fmt_br_number("empresas").alias("empresas"),
        fmt_br_number("municipios").alias("municipios"),
        fmt_br_number("cnaes").alias("cnaes"),
        fmt_br_money("pib_medio").alias("pib_medio"),
        fmt_br_money("capital_total", compact=True).alias("capital_total"),
        fmt_br_money("capital_total").alias("capital_total_completo"),
        fmt_br_number("idade_mediana", 1).alias("idade_mediana"),
    )


def municipio_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("municipio").agg(
        F.count("cnpj_completo").alias("total_empresas_ativas"),
        sum_money("capital_social").alias("capital_social_total"),
        F.max("populacao").alias("populacao"),
        F.max("pib_per_capita").alias("pib_per_capita"),
    )


def top_municipios(silver: DataFrame, n: int = 30) -> DataFrame:
    return top(municipio_summary(silver), "total_empresas_ativas", ["municipio"], n)


def cnae_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("cnae_principal", "descricao_cnae").agg(
        F.count("cnpj_completo").alias("total_empresas_ativas"),
        sum_money("capital_social").alias("capital_social_total"),
    )


def top_cnaes(silver: DataFrame, n: int = 30) -> DataFrame:
    return top(cnae_summary(silver), "total_empresas_ativas", ["cnae_principal", "descricao_cnae"], n)


def value_counts(df: DataFrame, column: str, missing: str, name: str, n: int | None = None) -> DataFrame:
    """Rows per value, nulls under a label; the n largest when asked."""
    counts = histogram(df, F.coalesce(column, F.lit(missing)), name, "total")
    return counts if n is None else top(counts, "total", [name], n)


def facets(silver: DataFrame, columns: Sequence[str] = FACETS) -> DataFrame:
    """The non-null values of each column in order, one pass over the table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("faceta"), F.col(c).alias("valor")) for c in columns])
    values = silver.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("valor").isNotNull()).distinct()
    return values.orderBy("faceta", "valor")


def cnae_labels(silver: DataFrame) -> DataFrame:
    distinct = silver.filter(F.col("cnae_principal").isNotNull()).select("cnae_principal", "descricao_cnae").distinct()
    return distinct.select(code_label("cnae_principal", "descricao_cnae").alias("label")).orderBy("label")


def filter_by_labels(silver: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows whose industry code heads one of the labels of a table."""
    codes = labels.select(label_code("label").alias("cnae_principal")).distinct()
    return silver.join(codes, "cnae_principal", "left_semi")


def range_bounds(silver: DataFrame) -> DataFrame:
    """Upper ends of the two sliders, at least 1."""
    upper = lambda c: F.greatest(F.coalesce(F.max(c), F.lit(0)), F.lit(1))
    return silver.agg(
        upper("idade_empresa_anos").cast("long").alias("idade_max"), upper("capital_social").cast("double").alias("capital_max")
    )


def pivot_counts(df: DataFrame, row: str, column: str, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Sum of `value` per row key, one column per key of `column` that occurs (or that is
    listed, for a chosen few), 0 where there is none. Null keys are left out. A table can't be wider
    than spark.sql.pivotMaxValues (10,000) of them; beyond that it is an error."""
    known = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    table = known.groupBy(row).pivot(column, None if columns is None else list(columns)).agg(F.sum(value))
    return table.na.fill(0)


def unpivot_counts(wide: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """`pivot_counts` in long form: a row per cell, also those of 0."""
    return wide.unpivot(row, None, column, value)


def friendly(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
