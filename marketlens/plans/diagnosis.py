"""Ingestion diagnosis: what was read, how well it matches, and the blocking rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.text import is_strange_uf
from marketlens.operators.aggregates import top, with_empty
from marketlens.operators.keys import distinct_keys, keep_known, key_overlap, missing_keys, stored_keys, union_parts
from marketlens.plans.bronze import filter_target, in_state, is_active
from marketlens.plans.quality import rule
from marketlens.schemas import ACTIVE_CODES, PARTS_PER_KIND, Thresholds
from marketlens.session import durable

_PART_KINDS = {"estabelecimentos": "Estabelecimentos", "empresas": "Empresas"}


class IngestionBlocked(RuntimeError):
    """The diagnosis stops the build; the message lists the rules."""


def required_parts(spark: SparkSession) -> DataFrame:
    """The numbered parts every dump must have."""
    kinds = spark.createDataFrame(list(_PART_KINDS.items()), "tipo string, prefixo string")
    return _numbered(kinds)


def _numbered(df: DataFrame) -> DataFrame:
    """Each row once per part number, with the part's name in `parte`."""
    numbers = F.transform(F.sequence(F.lit(0), F.lit(PARTS_PER_KIND - 1)), lambda i: F.concat("prefixo", i.cast("string")))
    return df.withColumn("parte", F.explode(numbers)).drop("prefixo")


def found_parts(catalog: DataFrame) -> DataFrame:
    """Parts named in the labels (any case) of a catalogue with columns kind and label."""
    labels = catalog.select(F.col("kind").alias("tipo"), "label").distinct()
    prefix = None
    for kind, text in _PART_KINDS.items():
        prefix = F.when(F.col("tipo") == kind, text) if prefix is None else prefix.when(F.col("tipo") == kind, text)
    numbered = _numbered(labels.filter(F.col("tipo").isin(*_PART_KINDS)).withColumn("prefixo", prefix))
    return numbered.filter(F.lower("label").contains(F.lower("parte"))).select("tipo", "parte").distinct()


def missing_parts(catalog: DataFrame) -> DataFrame:
    return missing_keys(required_parts(catalog.sparkSession), found_parts(catalog), ("tipo", "parte"))


def part_lists(catalog: DataFrame) -> DataFrame:
    """Expected, found and missing parts per kind as sorted lists of at most ten names."""
    required = required_parts(catalog.sparkSession)
    found = found_parts(catalog).withColumn("ok", F.lit(True))
    names = lambda condition: F.array_sort(F.collect_list(F.when(condition, F.col("parte"))))
    return required.join(found, ["tipo", "parte"], "left").groupBy("tipo").agg(
        names(F.lit(True)).alias("esperados"),
        names(F.col("ok")).alias("encontrados"),
        names(F.col("ok").isNull()).alias("faltantes"),
    )


def ingest_counts(estab: DataFrame) -> DataFrame:
    """Rows per source, state and status: the one pass over all rows that the counts of the
    diagnosis come from. A few rows per source unless the layout is shifted."""
    return estab.groupBy("source", "uf", "situacao_cadastral").agg(F.count(F.lit(1)).alias("n"))


def uf_histogram(counts: DataFrame, active_codes: Sequence[str] = ACTIVE_CODES) -> DataFrame:
    """Rows and active rows per cleaned state code, from `ingest_counts`."""
    uf = F.upper(F.trim(F.coalesce(F.col("uf"), F.lit(""))))
    active = F.coalesce(F.sum(F.when(is_active(active_codes), F.col("n"))), F.lit(0))
    return counts.groupBy(uf.alias("uf")).agg(F.sum("n").alias("n"), active.alias("ativos"))


def rows_by_source(counts: DataFrame) -> DataFrame:
    return counts.groupBy("source").agg(F.sum("n").alias("n"))


def target_keys(estab: DataFrame, target_uf: str) -> DataFrame:
    """The keys of the active establishments in the state."""
    return filter_target(estab, target_uf).select("cnpj_basico", "municipio", "cnae_fiscal_principal")


def owner_keys(emp: DataFrame, target: DataFrame) -> DataFrame:
    """Key and legal form of the companies owning one of them."""
    return keep_known(emp, stored_keys(target, "cnpj_basico")).select("cnpj_basico", "natureza_juridica")


def top_ufs(hist: DataFrame, n: int = 10) -> DataFrame:
    return top(hist.select("uf", "n"), "n", ["uf"], n)


def strange_ufs(hist: DataFrame, n: int = 20) -> DataFrame:
    return top(hist.filter(is_strange_uf("uf")).select("uf", "n"), "n", ["uf"], n)


def sample_codes(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The first codes in sort order."""
    return distinct_keys(df, column).orderBy(column).limit(n)


def sample_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first `n` rows (a few) in a given order.

    The first key is read alone, for the largest value that can be among them; whole rows are then
    read up to that value, which the scan's statistics rule out in most of the table."""
    first = F.col(order[0])
    least = [r[0] for r in df.select(first).orderBy(first).limit(n).collect()]
    if len(least) == n:
        df = df.filter(first.isNull() if least[-1] is None else first.isNull() | (first <= least[-1]))
    return df.orderBy(*order).limit(n)


def key_matches(target: DataFrame, owners: DataFrame, municipios: DataFrame, cnaes: DataFrame, naturezas: DataFrame) -> DataFrame:
    """Share of the active establishments' distinct keys known to each other table, from the
    stored `target_keys` and `owner_keys`."""
    return (
        key_overlap(target, owners, "cnpj_basico", "cnpj_basico", "empresas")
        .unionByName(key_overlap(target, municipios, "municipio", "codigo_municipio_receita", "municipios"))
        .unionByName(key_overlap(target, cnaes, "cnae_fiscal_principal", "cnae", "cnaes"))
        .unionByName(key_overlap(owners, naturezas, "natureza_juridica", "natureza_juridica", "naturezas"))
    )


def facts(
    hist: DataFrame, matches: DataFrame, cnaes: DataFrame, catalog: DataFrame, rows_read: DataFrame, target_uf: str, t: Thresholds
) -> DataFrame:
    """Everything the rules look at, in one row. `rows_read` has one row per source read."""

    def matched(name: str, column: str) -> Column:
        return F.max(F.when(F.col("dimensao") == name, F.col(column)))

    def in_target(column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("uf") == target_uf, F.col(column))), F.lit(0))

    match_row = matches.agg(
        F.struct(
            matched("empresas", "percentual_match").alias("empresas"),
            matched("municipios", "distintos").alias("municipios"),
            matched("cnaes", "com_match").alias("cnaes"),
        )
    )
    missing_row = missing_parts(catalog).agg(
        F.struct(
            F.count_if(F.col("tipo") == "estabelecimentos").alias("estab"), F.count_if(F.col("tipo") == "empresas").alias("emp")
        )
    )
    files = catalog.filter(F.col("kind") == "estabelecimentos").select("label").distinct().agg(F.count(F.lit(1)))
    return hist.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        in_target("n").alias("registros_uf"),
        in_target("ativos").alias("ativos"),
    ).withColumns(
        {
            "uf_no_top": top_ufs(hist, t.top_ufs).agg(F.count_if(F.col("uf") == target_uf)).scalar(),
            "estranhas": strange_ufs(hist, t.top_estranhas).agg(F.coalesce(F.sum("n"), F.lit(0))).scalar(),
            "match": match_row.scalar(),
            "cnae_presente": distinct_keys(cnaes, "cnae").limit(1).agg(F.count(F.lit(1))).scalar(),
            "faltam": missing_row.scalar(),
            "encontrados": files.scalar(),
            "processados": rows_read.agg(F.count(F.lit(1))).scalar(),
        }
    )


def blockers(facts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """The ten rules with value, limit and verdict."""
    c = F.col
    strange_limit = F.greatest(F.lit(float(t.max_estranhas_abs)), F.lit(t.max_estranhas_fracao) * c("total"))
    rows = [
        rule("minimo_ativos", c("ativos"), t.min_ativos, c("ativos") < t.min_ativos),
        rule("minimo_municipios", c("match.municipios"), t.min_municipios, c("match.municipios") < t.min_municipios),
        rule(
            "minimo_cnaes_descritos",
            c("match.cnaes"),
            t.min_cnaes_descritos,
            (c("cnae_presente") > 0) & (c("match.cnaes") < t.min_cnaes_descritos),
        ),
        rule("match_empresas", c("match.empresas"), t.min_match_empresas, c("match.empresas") < t.min_match_empresas),
        rule(
            "uf_relevante",
            c("registros_uf"),
            t.min_registros_uf,
            (c("uf_no_top") == 0) & (c("registros_uf") < t.min_registros_uf),
        ),
        rule("arquivos_processados", c("processados"), 2, (c("encontrados") > 2) & (c("processados") <= 2)),
        rule("partes_estabelecimentos", c("faltam.estab"), 0, c("faltam.estab") > 0),
        rule("partes_empresas", c("faltam.emp"), 0, c("faltam.emp") > 0),
        rule("ufs_estranhas", c("estranhas"), strange_limit, c("estranhas") > strange_limit),
        rule("situacao_ativa_presente", c("ativos"), 1, c("ativos") < 1),
    ]
    return facts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def presence_blockers(catalog: DataFrame) -> DataFrame:
    """The rules checked before any file is read: both mandatory kinds and all their parts."""
    missing = missing_parts(catalog).agg(
        F.struct(
            F.count_if(F.col("tipo") == "estabelecimentos").alias("estab"), F.count_if(F.col("tipo") == "empresas").alias("emp")
        )
    )
    facts = catalog.agg(
        F.count_if(F.col("kind") == "estabelecimentos").alias("estab"), F.count_if(F.col("kind") == "empresas").alias("emp")
    ).withColumn("faltam", missing.scalar())
    rows = [
        rule("fontes_estabelecimentos", F.col("estab"), 1, F.col("estab") < 1),
        rule("fontes_empresas", F.col("emp"), 1, F.col("emp") < 1),
        rule("partes_estabelecimentos", F.col("faltam.estab"), 0, F.col("faltam.estab") > 0),
        rule("partes_empresas", F.col("faltam.emp"), 0, F.col("faltam.emp") > 0),
    ]
    return facts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def diagnose(
    estab: DataFrame,
    emp: DataFrame,
    municipios: DataFrame,
    cnaes: DataFrame,
    naturezas: DataFrame,
    catalog: DataFrame,
    target_uf: str,
    thresholds: Thresholds = Thresholds(),
) -> dict[str, DataFrame]:
    """The whole diagnosis as named DataFrames. `estab` and `emp` carry a `source` column; `catalog`
    is the whole catalogue, with what is ignored and why. A source without rows was read too."""
    used = catalog.filter("processed")

    def read(kind: str) -> DataFrame:
        return used.filter(F.col("kind") == kind).select(F.col("label").alias("source"))

    def size(kind: str, table: DataFrame) -> DataFrame:
        return table.agg(F.lit(kind).alias("tabela"), F.count(F.lit(1)).alias("n"))

    counts = durable(ingest_counts(estab))
    target = durable(target_keys(estab, target_uf))
    owners = durable(owner_keys(emp, target))
    hist = uf_histogram(counts)
    matches = durable(key_matches(target, owners, municipios, cnaes, naturezas))
    by_file = durable(with_empty(rows_by_source(counts), read("estabelecimentos")))
    tables = {"municipios": municipios, "cnaes": cnaes, "naturezas": naturezas, "empresas_com_estabelecimento": owners}
    sizes = [size(kind, table) for kind, table in tables.items()]
    status = counts.filter(in_state(target_uf)).groupBy(F.coalesce("situacao_cadastral", F.lit("")).alias("situacao_cadastral"))
    return {
        "catalogo": catalog,
        "partes": part_lists(used),
        "linhas_estabelecimentos": by_file,
        "linhas_empresas": with_empty(emp.groupBy("source").agg(F.count(F.lit(1)).alias("n")), read("empresas")),
        "linhas_tabelas": union_parts(sizes),
        "top_ufs": top_ufs(hist),
        "ufs_estranhas": strange_ufs(hist),
        "situacao_uf": status.agg(F.sum("n").alias("n")),
        "matches": matches,
        "amostra_estabelecimentos": sample_rows(estab, ("cnpj_basico", "cnpj_ordem", "cnpj_dv"), 5),
        "amostra_empresas": sample_rows(emp, ("cnpj_basico",), 5),
        "amostra_municipios": sample_rows(municipios, ("codigo_municipio_receita",), 10),
        "amostra_cnaes": sample_rows(cnaes, ("cnae",), 10),
        "codigos_municipios": sample_codes(target, "municipio"),
        "bloqueios": blockers(facts(hist, matches, cnaes, used, by_file, target_uf, thresholds), thresholds),
    }


def blocked(rules: DataFrame) -> DataFrame:
    """The rules of the table that block."""
    return rules.filter("bloqueado")


def gate(rules: DataFrame) -> None:
    """Raise when a rule of the table (ten rows at most) blocks."""
    found = blocked(rules).collect()
    if found:
        raise IngestionBlocked("; ".join(f"{r.regra}: {r.valor} (limite {r.limite})" for r in found))
