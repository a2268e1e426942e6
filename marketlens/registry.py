"""Registered queries: one per operator, on the relations of `tpch_views`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import text as T
from marketlens.functions.display import fmt_br_money, fmt_br_number, fmt_br_percent
from marketlens.operators.keys import dedup_dim, duplicate_keys, union_parts
from marketlens.operators.states import STATES
from marketlens.plans import bronze, diagnosis, explore, gold, quality, silver
from marketlens.plans.pipeline import metrics_table
from marketlens.schemas import LAYOUTS, QUALITY_SCHEMA, RAW_ENCODING, RAW_SEPARATOR, Thresholds
from marketlens.session import durable, scratch_path
from marketlens.sources import readers, sinks
from marketlens.sources.catalog import catalog, classify_kind, find_indicator_file, sources_of_kind
from marketlens.sources.tables import Tables
from marketlens.tpch_views import AS_OF, TARGET_UF, Views, views

_ESTAB_KEY = ("cnpj_basico", "cnpj_ordem", "cnpj_dv")
_EXPLORED = ("cnpj_completo", "municipio", "cnae_principal", "porte_empresa", "idade_empresa_anos", "capital_social")
# Published thresholds scaled to the size of the test tables.
_THRESHOLDS = Thresholds(min_ativos=5_000, min_cnaes_descritos=300, min_registros_uf=5_000)

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def classify_kind_(v: Views) -> DataFrame:
    return v.file_names.select(
        "label", classify_kind("label").alias("kind"), classify_kind("label", "path").alias("kind_by_path")
    )


@query
def union_parts_(v: Views) -> DataFrame:
    def part(name: str, p: str) -> DataFrame:
        key = F.concat(F.lit(p.upper()), F.col("_1").cast("string")).alias("chave")
        rows = v.table(name).select(F.col(f"{p}_{'supp' if p == 's' else 'cust'}key").alias("_1"), f"{p}_name", f"{p}_nationkey", f"{p}_acctbal")
        return rows.select(key, F.col(f"{p}_name").alias("nome"), F.col(f"{p}_nationkey").alias("pais"), F.col(f"{p}_acctbal").alias("saldo"))

    return union_parts([part("supplier", "s"), part("customer", "c")])


@query
def headerless_files(v: Views) -> DataFrame:
    """Companies written as a raw dump and read back: quoted cells, Latin-1, no header."""
    path = scratch_path(v.spark)
    rows = v.emp.select(*LAYOUTS["empresas"])
    rows.write.options(sep=RAW_SEPARATOR, quoteAll=True, encoding=RAW_ENCODING, nullValue="", emptyValue="").csv(path)
    return readers.read_files(v.spark, "empresas", [path]).drop("source")


@query
def quoted_line_breaks(v: Views) -> DataFrame:
    """Documents written with their line breaks in quoted cells and read back in small splits."""
    path = scratch_path(v.spark)
    text = F.concat(F.replace(F.col("text"), F.lit(" "), F.lit("\n")), F.lit('\r\n"end";'))
    rows = v.table("documents").select(F.col("doc_id").cast("string").alias("cnae"), text.alias("descricao_cnae"))
    rows.write.options(sep=RAW_SEPARATOR, quoteAll=True, escape='"', encoding="UTF-8", ignoreLeadingWhiteSpace=False).csv(path)
    return readers.read_files(v.spark, "cnaes", [path], "UTF-8", split_bytes=1 << 20).drop("source")


@query
def headered_files(v: Views) -> DataFrame:
    """Indicators written with a header and read back by the names of their columns."""
    path = scratch_path(v.spark)
    names = {"municipio_norm": "Nome_Municipio", "pib_per_capita": "PIB per capita", "populacao": "População", "codigo_municipio_ibge": "IBGE"}
    table = v.indicators.select(*[F.col(c).alias(n) for c, n in names.items()])
    sinks.write_csv(table, path)
    return readers.read_indicators(v.spark, path, encoding="UTF-8")


@query
def exported_gold(v: Views) -> DataFrame:
    """A gold table's CSV export, read where its Parquet files are missing."""
    folder = scratch_path(v.spark)
    sinks.write_csv(gold.ranking_cnaes(v.silver), f"{folder}/csv/gold_ranking_cnaes")
    return readers.load_table(v.spark, folder, "gold_ranking_cnaes")


@query
def found_sources(v: Views) -> DataFrame:
    """Dumps written into a folder per source, listed, known by their paths and chosen by kind."""
    path = scratch_path(v.spark)
    keys = v.estab.select("source", "cnpj_basico").unionByName(v.emp.select("source", "cnpj_basico"))
    keys.write.partitionBy("source").csv(path)
    known = durable(catalog(v.spark, [path], scope="path"))
    kinds = [sources_of_kind(known, kind) for kind in ("estabelecimentos", "empresas")]
    folder = F.regexp_extract("root_path", "/source=([^/]+)/", 1)
    return union_parts(kinds).select("kind", folder.alias("source"), F.element_at(F.split("label", "::"), -1).endswith(".csv").alias("csv")).filter("csv").drop("csv").distinct()


@query
def found_indicators(v: Views) -> DataFrame:
    """The indicator file, found among others by its header and read."""
    path = scratch_path(v.spark)
    names = {"municipio_norm": "Municipio", "pib_per_capita": "PIB per capita", "populacao": "Populacao", "codigo_municipio_ibge": "IBGE"}
    sinks.write_csv(v.indicators.select(*[F.col(c).alias(n) for c, n in names.items()]).coalesce(1), f"{path}/b")
    sinks.write_csv(v.cnaes, f"{path}/a")
    found = find_indicator_file(v.spark, catalog(v.spark, [path]), [path])
    return readers.read_indicators(v.spark, found, encoding="UTF-8")


@query
def repaired_records(v: Views) -> DataFrame:
    """Records that are short or long by some cells, read in the layout of their kind."""
    path = scratch_path(v.spark)
    key, code = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    longer = F.concat_ws(";", code, "p_name", F.lit("mais"), F.lit(""))
    line = F.when(key == 0, code).when(key == 1, longer).when(key == 2, F.concat(code, F.lit(";"))).otherwise(F.concat_ws(";", code, "p_name"))
    v.table("part").select(line).write.text(path)
    return readers.read_files(v.spark, "cnaes", [path]).drop("source")


@query
def clean_export(v: Views) -> DataFrame:
    """Cells cleaned on their way to a CSV with the columns asked for, one of which is missing."""
    path = scratch_path(v.spark)
    rows = v.municipios.withColumn("nome_municipio_receita", F.concat(F.lit("\ufeff \t"), "nome_municipio_receita", F.lit("\u00a0")))
    sinks.write_clean_csv(rows, path, ["codigo_municipio_receita", "nome_municipio_receita", "uf"])
    return readers.read_headered(v.spark, path, encoding="UTF-8")


@query
def exported_both(v: Views) -> DataFrame:
    """A table's two exports, from the same rows."""
    folder = scratch_path(v.spark)
    table = sinks.export(quality.porte_histogram(v.market), folder, "porte", ["porte"])
    again = v.spark.read.schema(table.schema).options(header=True, escape='"').csv(f"{folder}/csv/porte")
    return table.withColumn("formato", F.lit("parquet")).unionByName(again.withColumn("formato", F.lit("csv")))


@query
def exported_quality(v: Views) -> DataFrame:
    path = scratch_path(v.spark)
    sinks.write_csv(quality_checks(v), path)
    return v.spark.read.schema(QUALITY_SCHEMA).options(header=True, escape='"').csv(path)


@query
def exported_selection(v: Views) -> DataFrame:
    """What a user chose, under its display names, as they find it in the file."""
    path = scratch_path(v.spark)
    chosen = explore.apply_filters(v.market, explore.Filters(porte=("Microempresa",), simples=("S",)))
    sinks.write_selection(explore.friendly(chosen.select(*explore.FRIENDLY_EMPRESAS), explore.FRIENDLY_EMPRESAS), path)
    return readers.read_headered(v.spark, path, encoding="UTF-8").drop("Capital social")


@query
def stored_companies(v: Views) -> DataFrame:
    """The bronze companies as the next layer reads them."""
    return sinks.write_table(v.active_companies, scratch_path(v.spark))


def _metrics(v: Views) -> DataFrame:
    sources = v.catalog_of(v.estab).withColumn("processed", F.lit(True))
    read = {"estabelecimentos": v.estab, "empresas": v.emp}
    return metrics_table(read, {"empresas": v.active_companies}, bronze.ingest_funnel(v.estab, TARGET_UF), sources, "tabelas")


@query
def run_metrics(v: Views) -> DataFrame:
    path = scratch_path(v.spark)
    sinks.write_json(_metrics(v), path)
    return v.spark.read.schema("metric string, key string, value string").json(path)


@query
def marked_metrics(v: Views) -> DataFrame:
    return quality.marked(_metrics(v), "empresas3")


@query
def without_indicators(v: Views) -> DataFrame:
    """The wide table where no indicator file is there: a table without rows stands in."""
    none = readers.empty_indicators(v.spark)
    wide = silver.build_silver(v.active, v.active_companies, v.municipios, v.cnaes, v.naturezas, v.active_simples, none, AS_OF)
    return wide.select("cnpj_completo", "municipio", "populacao", "pib_per_capita")


@query
def rows_by_source(v: Views) -> DataFrame:
    return bronze.rows_by_source(v.estab.select("source").unionByName(v.emp.select("source")), v.source_names)


@query
def filter_uf(v: Views) -> DataFrame:
    return bronze.filter_uf(v.estab, TARGET_UF).select(*_ESTAB_KEY, "uf", "situacao_cadastral")


@query
def filter_active(v: Views) -> DataFrame:
    return bronze.filter_active(v.estab).select(*_ESTAB_KEY, "uf", "situacao_cadastral")


@query
def ingest_funnel(v: Views) -> DataFrame:
    return bronze.ingest_funnel(v.estab, TARGET_UF)


@query
def status_hist(v: Views) -> DataFrame:
    return bronze.status_histogram(v.estab, TARGET_UF)


@query
def semi_empresas(v: Views) -> DataFrame:
    return v.active_companies


@query
def semi_simples(v: Views) -> DataFrame:
    return v.active_simples


@query
def dim_dedup(v: Views) -> DataFrame:
    return dedup_dim(v.cnaes, "cnae")


@query
def indicator_rollup(v: Views) -> DataFrame:
    return silver.indicator_rollup(v.indicators)


@query
def indicator_merge(v: Views) -> DataFrame:
    return silver.merge_indicators(v.pib, v.pop)


@query
def join_dims(v: Views) -> DataFrame:
    return v.silver_plan.select(
        "cnpj_completo", "municipio", "descricao_cnae", "descricao_natureza_juridica", "opcao_simples"
    )


@query
def silver_market(v: Views) -> DataFrame:
    return v.silver_plan


@query
def silver_by_key(v: Views) -> DataFrame:
    """The wide table from establishments and companies stored in buckets of the company's key."""
    with Tables(v.spark, scratch_path(v.spark)).replacing() as new:
        owned = silver.owners(v.active_companies, v.naturezas, v.active_simples)
        parts = new.write_by_key({"estabelecimentos": durable(v.active), "proprietarios": durable(owned)}, "cnpj_basico")
    return silver.build_silver(
        parts["estabelecimentos"], v.active_companies, v.municipios, v.cnaes, v.naturezas, v.active_simples, v.indicators, AS_OF,
        stored_owners=parts["proprietarios"],
    )


@query
def current_tables(v: Views) -> DataFrame:
    """A ranking replaced twice, the second time by a build that fails; found by its name."""
    tables = Tables(v.spark, scratch_path(v.spark))
    ranking = durable(gold.ranking_cnaes(v.silver))
    with tables.replacing() as new:
        new.write(ranking, "ranking_cnaes_atual")
    try:
        with tables.replacing() as new:
            new.write(ranking.limit(1), "ranking_cnaes_atual")
            raise InterruptedError
    except InterruptedError:
        tables.register()
    return v.spark.table("ranking_cnaes_atual")


@query
def municipio_cnae(v: Views) -> DataFrame:
    return gold.municipio_cnae(v.silver)


@query
def ranking_municipios(v: Views) -> DataFrame:
    return gold.ranking_municipios(v.silver)


@query
def ranking_cnaes(v: Views) -> DataFrame:
    return gold.ranking_cnaes(v.silver)


@query
def municipio_cnae_rollup(v: Views) -> DataFrame:
    """The profile from partial states, which the rankings below share."""
    return gold.municipio_cnae(v.market_states, of=STATES)


@query
def ranking_municipios_rollup(v: Views) -> DataFrame:
    return gold.ranking_municipios(v.market_states, of=STATES)


@query
def ranking_cnaes_rollup(v: Views) -> DataFrame:
    return gold.ranking_cnaes(v.market_states, of=STATES)


@query
def minmax_municipios(v: Views) -> DataFrame:
    return gold.minmax_municipios(v.silver).select(
        "municipio", "n_populacao", "n_pib", "n_empresas", "n_densidade", "n_diversidade", "n_capital"
    )


@query
def minmax_cnaes(v: Views) -> DataFrame:
    return gold.minmax_cnaes(v.silver).select(
        "cnae_principal", "descricao_cnae", "n_empresas", "n_presenca", "n_capital"
    )


@query
def quality_checks(v: Views) -> DataFrame:
    status = bronze.status_histogram(v.estab, TARGET_UF).filter("escopo = 'todos'")
    return quality.quality_checks(v.silver, bronze.ingest_funnel(v.estab, TARGET_UF), v.active_companies, status)


@query
def validate_summary(v: Views) -> DataFrame:
    return quality.validation_summary(quality_checks(v))


@query
def porte_hist(v: Views) -> DataFrame:
    return quality.porte_histogram(v.market)


@query
def duplicate_keys_(v: Views) -> DataFrame:
    return duplicate_keys(v.market, ["cnpj_completo"])


@query
def audit_layers(v: Views) -> DataFrame:
    return quality.audit_layers(
        v.active, v.active_companies, v.silver, gold.ranking_municipios(v.silver), gold.ranking_cnaes(v.silver)
    )


def _uf_histogram(v: Views) -> DataFrame:
    return diagnosis.uf_histogram(diagnosis.ingest_counts(v.dirty_estab))


@query
def diag_top_uf(v: Views) -> DataFrame:
    return diagnosis.top_ufs(_uf_histogram(v))


@query
def diag_strange_uf(v: Views) -> DataFrame:
    return diagnosis.strange_ufs(_uf_histogram(v))


def _matches(v: Views) -> DataFrame:
    target = durable(diagnosis.target_keys(v.dirty_estab, TARGET_UF))
    owners = durable(diagnosis.owner_keys(v.emp, target))
    return diagnosis.key_matches(target, owners, v.municipios, v.cnaes, v.naturezas)


@query
def diag_match(v: Views) -> DataFrame:
    return _matches(v)


@query
def diag_missing_parts(v: Views) -> DataFrame:
    return diagnosis.missing_parts(v.catalog_of(v.estab))


@query
def diag_presence(v: Views) -> DataFrame:
    return diagnosis.presence_blockers(v.catalog_of(v.estab))


@query
def diag_part_lists(v: Views) -> DataFrame:
    lists = diagnosis.part_lists(v.catalog_of(v.estab))
    return lists.select("tipo", *[F.array_join(c, ",").alias(c) for c in ("esperados", "encontrados", "faltantes")])


@query
def audit_rules(v: Views) -> DataFrame:
    missing = diagnosis.missing_parts(v.catalog_of(v.estab))
    return quality.audit_blockers(durable(audit_layers(v)), missing, durable(_matches(v)), _THRESHOLDS)


@query
def blocked_rules(v: Views) -> DataFrame:
    """What the gate finds in the stored rules, with limits that no table here meets."""
    path = scratch_path(v.spark)
    strict = Thresholds(min_ativos=10**9, min_municipios=10**6)
    missing = diagnosis.missing_parts(v.catalog_of(v.estab))
    sinks.write_json(quality.audit_blockers(durable(audit_layers(v)), missing, durable(_matches(v)), strict), path)
    return diagnosis.blocked(v.spark.read.schema("regra string, valor double, limite double, bloqueado boolean").json(path))


@query
def diag_sample_rows(v: Views) -> DataFrame:
    """The first companies by legal form and key, which no file is ordered by."""
    return diagnosis.sample_rows(v.emp, ("natureza_juridica", "cnpj_basico"), 10).select("natureza_juridica", "cnpj_basico", "razao_social")


@query
def diag_sample_codes(v: Views) -> DataFrame:
    return diagnosis.sample_codes(diagnosis.target_keys(v.dirty_estab, TARGET_UF), "municipio")


@query
def diag_blockers(v: Views) -> DataFrame:
    counts = durable(diagnosis.ingest_counts(v.dirty_estab))
    facts = diagnosis.facts(
        diagnosis.uf_histogram(counts),
        durable(_matches(v)),
        v.cnaes,
        durable(v.catalog_of(counts)),
        diagnosis.rows_by_source(counts),
        TARGET_UF,
        _THRESHOLDS,
    )
    return diagnosis.blockers(facts, _THRESHOLDS)


@query
def explore_filter(v: Views) -> DataFrame:
    chosen = explore.Filters(
        porte=("Microempresa", "Demais"), simples=("S",), natureza=("Natureza O", "Natureza F")
    )
    labels = explore.cnae_labels(v.silver).filter(F.col("label").contains(" - small "))
    return explore.filter_by_labels(explore.apply_filters(v.silver, chosen), labels).select(*_EXPLORED)


@query
def explore_range(v: Views) -> DataFrame:
    chosen = explore.Filters(idade=(0, 25), capital=(0.0, 250_000.0))
    return explore.apply_filters(v.market, chosen).select(*_EXPLORED)


@query
def search_text(v: Views) -> DataFrame:
    return explore.search(v.market, "sé#00000002").select("cnpj_completo", "razao_social", "municipio", "descricao_cnae")


@query
def indexed_filter(v: Views) -> DataFrame:
    """A selection through the bitmaps of the stored index."""
    chosen = explore.Filters(porte=("Microempresa", "Demais"), simples=("S",), natureza=("Natureza O", "Natureza F"), idade=(0, 30))
    return v.market_index.filtered(chosen).select(*_EXPLORED)


@query
def facet_counts(v: Views) -> DataFrame:
    """Counts of all facet values under a selection, from bitmaps alone."""
    return v.market_index.facet_counts({"porte_empresa": ["Microempresa", "Demais"], "opcao_simples": ["S"]})


@query
def indexed_search(v: Views) -> DataFrame:
    return v.market_index.search("sé#00000002").select("cnpj_completo", "razao_social", "municipio", "descricao_cnae")


@query
def kpi_cards(v: Views) -> DataFrame:
    return explore.kpis(v.market)


@query
def top_municipios(v: Views) -> DataFrame:
    return explore.top_municipios(v.market)


@query
def top_cnaes(v: Views) -> DataFrame:
    return explore.top_cnaes(v.market)


@query
def top_naturezas(v: Views) -> DataFrame:
    return explore.value_counts(v.market, "descricao_natureza_juridica", "Sem descricao", "natureza_juridica", 20)


@query
def pivot_municipio_cnae(v: Views) -> DataFrame:
    """A row per municipality and description, those without a company included."""
    wide = explore.pivot_counts(
        durable(gold.municipio_cnae(v.silver)), "municipio", "descricao_cnae", "total_empresas_ativas"
    )
    return explore.unpivot_counts(wide, "municipio", "descricao_cnae", "total_empresas_ativas")


@query
def facet_values(v: Views) -> DataFrame:
    return explore.facets(v.market)


@query
def cnae_facets(v: Views) -> DataFrame:
    return explore.cnae_labels(v.market)


@query
def range_bounds(v: Views) -> DataFrame:
    return explore.range_bounds(v.market)


@query
def friendly_export(v: Views) -> DataFrame:
    return explore.friendly(v.market.select(*explore.FRIENDLY_EMPRESAS), explore.FRIENDLY_EMPRESAS)


@query
def clean_cell(v: Views) -> DataFrame:
    lead = F.when(F.col("doc_id") % 3 == 0, F.lit(" \u00a0")).otherwise(F.lit("\t"))
    dirty = F.concat(F.lit("\ufeff"), lead, "text", F.lit("\n"))
    return v.table("documents").select("doc_id", T.clean_cell(dirty).alias("value"))


@query
def normalize_text(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", T.normalize_text("text").alias("value"))


@query
def only_digits(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", T.only_digits("text").alias("value"))


@query
def parse_br_number(v: Views) -> DataFrame:
    return v.emp.select("cnpj_basico", T.parse_br_number("capital_social").alias("value"))


@query
def parse_date(v: Views) -> DataFrame:
    return v.estab.select(*_ESTAB_KEY, T.parse_yyyymmdd("data_inicio_atividade").alias("value"))


@query
def age_years(v: Views) -> DataFrame:
    return v.estab.select(*_ESTAB_KEY, T.age_years(T.parse_yyyymmdd("data_inicio_atividade"), AS_OF).alias("value"))


@query
def porte_label(v: Views) -> DataFrame:
    return v.emp.select("cnpj_basico", T.porte_label("porte_empresa").alias("value"))


@query
def cnpj_key(v: Views) -> DataFrame:
    return v.estab.select(T.cnpj_key(*_ESTAB_KEY).alias("value"))


@query
def fmt_br_number_(v: Views) -> DataFrame:
    return v.table("orders").select("o_orderkey", fmt_br_number("o_totalprice", 2).alias("value"))


@query
def fmt_br_money_(v: Views) -> DataFrame:
    key: Column = F.col("o_orderkey") % 4
    scale = F.when(key == 0, 1e-3).when(key == 1, 1.0).when(key == 2, 1e2).otherwise(1e4)
    price = F.col("o_totalprice")
    return v.table("orders").select(
        "o_orderkey",
        fmt_br_money(price).alias("value"),
        fmt_br_money(price * scale, compact=True).alias("compact"),
        fmt_br_percent(price / F.lit(7e3)).alias("percent"),
    )


@query
def scan_invisible(v: Views) -> DataFrame:
    kind, text = F.col("doc_id") % 4, F.col("text")
    dirty = (
        F.when(kind == 0, F.concat(text, F.lit("\u00a0x\u00a0\n\x01a\x01")))
        .when(kind == 1, F.concat(F.lit("\u200b"), text, F.lit("\ufeff")))
        .when(kind == 2, F.concat(text, F.lit("\x85\x1f\u200d")))
        .otherwise(text)
    )
    return quality.scan_invisible(v.table("documents").select("doc_id", dirty.alias("text")), "doc_id", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(views(spark, sf_dir))

    return {name.rstrip("_"): bound(build) for name, build in QUERIES.items()}
