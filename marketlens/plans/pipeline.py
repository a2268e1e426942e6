"""The batch build: raw folders to raw, bronze, silver and gold tables, with its gates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.text import normalize_name
from marketlens.operators.keys import distinct_keys
from marketlens.operators.states import STATES
from marketlens.plans import bronze, diagnosis, gold, quality, silver
from marketlens.schemas import LAYOUTS, RAW_ENCODING, Thresholds
from marketlens.session import durable, release, tune, written
from marketlens.sources import readers, sinks
from marketlens.sources.catalog import catalog, find_indicator_file, list_files
from marketlens.sources.tables import Replacement, Tables

MANDATORY = ("estabelecimentos", "empresas")
LOADED = ("estabelecimentos", "empresas", "municipios", "cnaes", "naturezas", "simples")


def read_merged_indicators(spark: SparkSession, paths: Sequence[str], target_uf: str, encoding: str) -> DataFrame | None:
    """The official GDP and population tables (CSV exports named PIB* or POP*) merged by code;
    None when there is neither."""
    sides: dict[str, list[DataFrame]] = {"pib_per_capita": [], "populacao": []}
    for row in list_files(spark, paths).filter(F.lower("path").endswith(".csv")).orderBy("path").collect():
        name = normalize_name(row.path.rsplit("/", 1)[-1])
        if "PIB" in name:
            out, roles = "pib_per_capita", readers.PIB_ROLES
        elif "POP" in name:
            out, roles = "populacao", readers.POP_ROLES
        else:
            continue
        table = readers.read_headered(spark, row.path, encoding=encoding)
        side = readers.indicator_side(table, roles, out, target_uf)
        if side is not None:
            # A later file wins over an earlier one, a later row over an earlier one.
            sides[out].append(side.withColumn("seq", F.struct(F.lit(len(sides[out])).alias("file"), "seq")))
    if not any(sides.values()):
        return None

    def one(out: str) -> DataFrame:
        empty = f"codigo_municipio_ibge string, municipio_norm string, {out} string, seq struct<file:int,seq:bigint>"
        table = spark.createDataFrame([], empty)
        for side in sides[out]:
            table = table.unionByName(side)
        return table

    merged = silver.merge_indicators(one("pib_per_capita"), one("populacao"))
    return merged.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in merged.columns])


def land(spark: SparkSession, sources: DataFrame, folder: str, **options) -> dict[str, DataFrame]:
    """Parse every raw source once and keep it as Parquet; all later steps read columns of it."""
    return {
        kind: sinks.write_table(readers.read_receita(spark, kind, sources, **options), f"{folder}/raw/{kind}")
        for kind in LOADED
    }


def indicators_for(
    spark: SparkSession, sources: DataFrame, paths: Sequence[str], target_uf: str, encoding: str
) -> tuple[DataFrame, str]:
    """The indicator table and where it came from."""
    merged = read_merged_indicators(spark, paths, target_uf, encoding)
    if merged is not None:
        return merged, "tabelas de PIB/populacao"
    path = find_indicator_file(spark, sources, paths)
    if path is None:
        return readers.empty_indicators(spark), "arquivo nao encontrado"
    return readers.read_indicators(spark, path, encoding=encoding), path


def run_diagnosis(
    sources: DataFrame,
    raw: dict[str, DataFrame],
    folder: str,
    target_uf: str,
    thresholds: Thresholds = Thresholds(),
) -> dict[str, DataFrame]:
    """Diagnose the landed tables and store every section as JSON."""
    report = diagnosis.diagnose(
        raw["estabelecimentos"],
        raw["empresas"],
        raw["municipios"],
        raw["cnaes"],
        raw["naturezas"],
        sources,
        target_uf,
        thresholds,
    )
    for section, table in report.items():
        sinks.write_json(table, f"{folder}/diagnostico/{section}")
    return report


def metrics_table(raw: dict[str, DataFrame], kept: dict[str, DataFrame], funnel: DataFrame, sources: DataFrame, origin: str) -> DataFrame:
    """Run metrics in long form: metric, key, value."""

    def rows(df: DataFrame, metric: str, key, value) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), key.cast("string").alias("key"), value.cast("string").alias("value"))

    spark = sources.sparkSession
    parts = [rows(sources.filter("processed"), "fontes_descobertas", F.col("kind"), F.col("label"))]
    for kind, table in raw.items():
        names = sources.filter(F.col("processed") & (F.col("kind") == kind)).select(F.col("label").alias("source"))
        parts.append(rows(bronze.rows_by_source(table, names), f"registros_{kind}_por_arquivo", F.col("source"), F.col("n")))
    for kind, table in kept.items():
        parts.append(rows(table.agg(F.count(F.lit(1)).alias("n")), f"registros_{kind}_mantidos", F.lit(""), F.col("n")))
    parts += [rows(funnel, name, F.lit(""), F.col(name)) for name in ("lidos", "na_uf", "ativos", "empresas_unicas")]
    parts.append(rows(spark.range(1), "consolidado_pib_populacao", F.lit(""), F.lit(origin)))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def run_pipeline(
    spark: SparkSession,
    paths: Sequence[str],
    folder: str,
    target_uf: str = "SC",
    as_of: date | str | None = None,
    skip_diagnostic: bool = False,
    thresholds: Thresholds = Thresholds(),
    style: str = "br",
    encoding: str = RAW_ENCODING,
    multiline: bool | None = None,
    spread: int | None = None,
) -> dict[str, DataFrame]:
    """Build all tables under `folder` and return the gold ones.

    Raises `IngestionBlocked` when a rule of the diagnosis blocks (unless skipped) and
    `FileNotFoundError` when a mandatory kind has no source."""
    tune(spark)
    before = written()
    try:
        return _build(spark, paths, folder, target_uf, str(as_of or date.today()), skip_diagnostic, thresholds, style, encoding, multiline, spread)
    finally:
        release(spark, before)


def _build(
    spark: SparkSession,
    paths: Sequence[str],
    folder: str,
    target_uf: str,
    as_of: str,
    skip_diagnostic: bool,
    thresholds: Thresholds,
    style: str,
    encoding: str,
    multiline: bool | None,
    spread: int | None,
) -> dict[str, DataFrame]:
    sources = sinks.write_table(catalog(spark, paths), f"{folder}/catalogo")
    if not skip_diagnostic:
        early = {
            "catalogo": sources,
            "partes": diagnosis.part_lists(sources.filter("processed")),
            "bloqueios": diagnosis.presence_blockers(sources.filter("processed")),
        }
        for section, rows in early.items():
            sinks.write_json(rows, f"{folder}/diagnostico/{section}")
        diagnosis.gate(spark.read.json(f"{folder}/diagnostico/bloqueios"))
    for kind in MANDATORY:
        if sources.filter((F.col("kind") == kind) & F.col("processed")).isEmpty():
            raise FileNotFoundError(f"no source of kind {kind!r} under {list(paths)}")

    raw = land(spark, sources, folder, encoding=encoding, multiline=multiline, spread=spread)
    if not skip_diagnostic:
        run_diagnosis(sources, raw, folder, target_uf, thresholds)
        diagnosis.gate(spark.read.json(f"{folder}/diagnostico/bloqueios"))

    tables = Tables(spark, folder)
    with tables.replacing() as new:  # all of them, or none if anything fails
        gold_tables = _replace(new, sources, raw, folder, paths, target_uf, as_of, style, encoding)
    for name, order in GOLD_ORDER.items():
        sinks.export_csv(gold_tables[name], folder, name, order())
    tables.register()  # SQL users find them by name, as those of any later session who register them
    return gold_tables


#: Gold tables and the order of their CSV exports.
GOLD_ORDER = {
    "gold_empresas_ativas": list,
    "gold_municipio_cnae": list,
    "gold_ranking_municipios": lambda: ["posicao_ranking"],
    "gold_ranking_cnaes": gold.cnae_order,
    "gold_qualidade_dados": list,
}


def _replace(
    new: Replacement,
    sources: DataFrame,
    raw: dict[str, DataFrame],
    folder: str,
    paths: Sequence[str],
    target_uf: str,
    as_of: str,
    style: str,
    encoding: str,
) -> dict[str, DataFrame]:
    """New versions of the silver and gold tables; the gold ones."""
    spark = sources.sparkSession
    active = durable(bronze.filter_target(raw["estabelecimentos"], target_uf).select(*LAYOUTS["estabelecimentos"]))
    keys = durable(distinct_keys(active, "cnpj_basico"))
    emp = new.write(bronze.bronze_companies(raw["empresas"], keys), "silver_empresas")
    simples = new.write(bronze.bronze_simples(raw["simples"], keys), "silver_simples")
    municipios = new.write(bronze.bronze_municipios(raw["municipios"]), "silver_municipios")
    table, origin = indicators_for(spark, sources, paths, target_uf, encoding)
    indicators = new.write(table, "silver_indicadores")
    owned = durable(silver.owners(emp, raw["naturezas"], simples, style))
    by_key = new.write_by_key({"silver_estabelecimentos_ativos": active, "silver_proprietarios": owned}, "cnpj_basico")
    estab, owned = by_key["silver_estabelecimentos_ativos"], by_key["silver_proprietarios"]
    wide = silver.build_silver(estab, emp, municipios, raw["cnaes"], raw["naturezas"], simples, indicators, as_of, style, owned)
    market = new.write(wide, "gold_empresas_ativas")
    funnel = sinks.write_table(bronze.ingest_funnel(raw["estabelecimentos"], target_uf), f"{folder}/metricas/funil")
    status = bronze.status_histogram(raw["estabelecimentos"], target_uf).filter("escopo = 'todos'")
    states = gold.market_states(market)
    gold_tables = {
        "gold_empresas_ativas": market,
        "gold_municipio_cnae": new.write(gold.municipio_cnae(states, of=STATES), "gold_municipio_cnae"),
        "gold_ranking_municipios": new.write(gold.ranking_municipios(states, of=STATES), "gold_ranking_municipios"),
        "gold_ranking_cnaes": new.write(gold.ranking_cnaes(states, of=STATES), "gold_ranking_cnaes"),
        "gold_qualidade_dados": new.write(quality.quality_checks(market, funnel, emp, status, style), "gold_qualidade_dados"),
    }
    kept = {"empresas": emp, "simples": simples, "municipios": municipios, "indicadores": indicators}
    sinks.write_json(metrics_table(raw, kept, funnel, sources, origin), f"{folder}/metricas/execucao")
    return gold_tables


def audit(spark: SparkSession, folder: str, thresholds: Thresholds = Thresholds()) -> tuple[DataFrame, DataFrame]:
    """Counts of the stored layers and the audit's rules over them. A diagnosis that was
    skipped leaves its match percentages at 100 and no missing parts."""
    names = ("silver_estabelecimentos_ativos", "silver_empresas", "gold_empresas_ativas", "gold_ranking_municipios", "gold_ranking_cnaes")
    stored = {name: readers.load_table(spark, folder, name) for name in names}
    counts = quality.audit_layers(
        stored["silver_estabelecimentos_ativos"],
        stored["silver_empresas"],
        stored["gold_empresas_ativas"],
        stored["gold_ranking_municipios"],
        stored["gold_ranking_cnaes"],
    )
    diagnosed = not list_files(spark, [f"{folder}/diagnostico/matches"]).isEmpty()
    if diagnosed:
        matches = spark.read.schema("dimensao string, percentual_match double").json(f"{folder}/diagnostico/matches")
        missing = diagnosis.missing_parts(spark.read.parquet(f"{folder}/catalogo").filter("processed"))
    else:
        matches = spark.createDataFrame([], "dimensao string, percentual_match double")
        missing = spark.createDataFrame([], "tipo string, parte string")
    return counts, quality.audit_blockers(counts, missing, matches, thresholds)

