import json
import os

import pytest
from conftest import FILE_NAMES, SAMPLE, raw_text
from pyspark.sql import Observation
from pyspark.sql import functions as F

from marketlens.plans import bronze, diagnosis, explore, gold, pipeline, quality
from marketlens.schemas import GOLD_SCHEMAS, Thresholds
from marketlens.session import checkpoint_folder
from marketlens.sources import sinks
from marketlens.sources.readers import load_table


def shape(schema):
    return [(f.name, f.dataType) for f in schema]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    for kind, rows in SAMPLE.items():
        (raw / FILE_NAMES[kind]).write_bytes(raw_text(rows).encode("latin-1"))
    from conftest import INDICATORS

    (raw / "consolidado_pib_populacao.csv").write_text(INDICATORS)
    out = str(tmp_path_factory.mktemp("out"))
    return pipeline.run_pipeline(spark, [str(raw)], out, as_of="2024-01-01", skip_diagnostic=True), out


def test_silver_values(built):
    tables, _ = built
    market = {r.cnpj_completo: r for r in tables["gold_empresas_ativas"].collect()}
    assert set(market) == {"00000001000101", "00000002000102"}
    a, b = market["00000001000101"], market["00000002000102"]
    assert (a.municipio, a.porte_empresa, a.capital_social, a.idade_empresa_anos) == ("FLORIANÓPOLIS", "Microempresa", 150000.0, 6)
    assert (a.populacao, a.pib_per_capita, a.opcao_simples, a.opcao_mei) == (537211.0, 7450010.0, "S", "N")
    assert (b.porte_empresa, b.capital_social, b.idade_empresa_anos, b.pib_per_capita) == ("Empresa de pequeno porte", 90000.0, 5, 6800030.0)


def test_gold_values(built):
    tables, _ = built
    cells = {r.municipio: r for r in tables["gold_municipio_cnae"].collect()}
    a = cells["FLORIANÓPOLIS"]
    assert (a.total_empresas_ativas, a.participacao_cnae_no_municipio, a.capital_social_mediano, a.idade_mediana_empresas) == (1, 1.0, 150000.0, 6.0)
    assert a.empresas_por_10k_habitantes == pytest.approx(0.018614659789)
    assert cells["JOINVILLE"].empresas_por_10k_habitantes == pytest.approx(0.016225258509)
    ranks = [(r.municipio, round(r.score_oportunidade, 9), r.posicao_ranking) for r in tables["gold_ranking_municipios"].orderBy("posicao_ranking").collect()]
    assert ranks == [("FLORIANÓPOLIS", 45.0, 1), ("JOINVILLE", 20.0, 2)]
    assert {r.cnae_principal: r.score_relevancia for r in tables["gold_ranking_cnaes"].collect()} == {"6201501": 20.0, "4711302": 0.0}


def test_contract_of_gold_tables(spark, built):
    tables, out = built
    for name, table in tables.items():
        assert shape(table.schema) == shape(GOLD_SCHEMAS[name])
        assert load_table(spark, out, name).count() == table.count()


def test_quality_report(built):
    tables, _ = built
    rows = {r.validacao: r for r in tables["gold_qualidade_dados"].collect()}
    assert len(rows) == 14
    assert rows["registros_lidos_estabelecimentos"].valor == "4"
    assert rows["estabelecimentos_sc"].valor == "3" and rows["estabelecimentos_ativos_sc"].valor == "2"
    assert rows["cnpj_basico_unicos_sc"].valor == "2" and rows["empresas_cruzadas_com_sucesso"].valor == "2"
    assert rows["percentual_empresas_sem_cnae"].valor == "0.0" and rows["duplicidade_cnpj_completo"].status == "ok"
    assert json.loads(rows["distribuicao_porte"].valor) == {"Empresa de pequeno porte": 1, "Microempresa": 1}
    assert json.loads(rows["distribuicao_situacao_cadastral"].valor) == {"02": 3, "08": 1}
    assert quality.validate(tables["gold_qualidade_dados"]).count() == 0


def test_quality_gate_raises(spark):
    bad = spark.createDataFrame([("duplicidade_cnpj_completo", "3", "erro", ""), ("x", "1", "atencao", "")], "validacao string, valor string, status string, detalhe string")
    with pytest.raises(quality.QualityError, match="duplicidade_cnpj_completo: 3"):
        quality.validate(bad)
    assert quality.offending(bad).count() == 2


def test_metrics_and_marker(spark, built):
    _, out = built
    metrics = spark.read.json(f"{out}/metricas/execucao")
    values = {(r.metric, r.key): r.value for r in metrics.collect()}
    assert values["lidos", ""] == "4" and values["registros_simples_mantidos", ""] == "2"
    assert not quality.has_marker(metrics)
    assert quality.has_marker(metrics.withColumn("value", F.lit("Sintetico.csv")))


def test_audit_blocks_the_tiny_run(spark, built):
    _, out = built
    counts, rules = pipeline.audit(spark, out)
    values = {r.metrica: r.valor for r in counts.collect()}
    assert values["silver_estabelecimentos"] == 2 and values["ranking_municipios"] == 2 and values["silver_empresas"] == 2
    assert {r.regra for r in rules.filter("bloqueado").collect()} == {"minimo_ativos", "minimo_municipios"}


def test_gate_blocks_without_all_parts(spark, sample_folder, tmp_path):
    with pytest.raises(diagnosis.IngestionBlocked, match="partes_estabelecimentos"):
        pipeline.run_pipeline(spark, [str(sample_folder)], str(tmp_path / "o"))
    rules = spark.read.json(str(tmp_path / "o/diagnostico/bloqueios")).filter("bloqueado").collect()
    assert {r.regra for r in rules} == {"partes_estabelecimentos", "partes_empresas"}
    parts = {r.tipo: len(r.faltantes) for r in spark.read.json(str(tmp_path / "o/diagnostico/partes")).collect()}
    assert min(parts.values()) > 0


def test_ranking_is_in_order_over_partitions_and_in_its_export(spark, tmp_path):
    silver = spark.range(0, 3000).select(
        F.concat(F.lit("M"), F.col("id") % 700).alias("municipio"), (F.col("id") % 700 + 1.0).alias("populacao"),
        F.lit(5.0).alias("pib_per_capita"), (F.col("id") % 13).cast("string").alias("cnae_principal"), (F.col("id") * 1.5).alias("capital_social"),
    )
    ranking = gold.ranking_municipios(silver)
    assert [r.posicao_ranking for r in ranking.collect()] == [*range(1, 701)]
    sinks.export(ranking, str(tmp_path), "gold_ranking_municipios", ["posicao_ranking"])
    lines = [x.split(",")[-1] for f in sorted((tmp_path / "csv/gold_ranking_municipios").glob("part-*")) for x in f.read_text().splitlines()]
    assert [int(x) for x in lines if x.isdigit()] == [*range(1, 701)]


def test_mandatory_kind(spark, sample_folder, tmp_path):
    with pytest.raises(FileNotFoundError, match="estabelecimentos"):
        pipeline.run_pipeline(spark, [str(sample_folder / "cnaes.csv")], str(tmp_path / "o"), skip_diagnostic=True)


def test_full_run_with_diagnosis(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(10):
        (raw / f"Estabelecimentos{i}.csv").write_bytes(raw_text(SAMPLE["estabelecimentos"] if i == 0 else []).encode("latin-1"))
        (raw / f"Empresas{i}.csv").write_bytes(raw_text(SAMPLE["empresas"] if i == 0 else []).encode("latin-1"))
    (raw / "cnaes.csv").write_bytes(raw_text(SAMPLE["cnaes"]).encode("latin-1"))
    (raw / "municipios.csv").write_bytes(raw_text(SAMPLE["municipios"]).encode("latin-1"))
    pib = "Sigla da Unidade da Federação;Código do Município;Nome do Município;Produto Interno Bruto per capita\nSC;4205407;Florianópolis;70000,5\n"
    pop = "UF;COD. UF;Código do Município;NOME DO MUNICÍPIO;POPULAÇÃO ESTIMADA\nSC;42;4205407;Florianópolis;537.211\nSC;42;4209102;Joinville;616.323\n"
    (raw / "PIB dos mun.csv").write_bytes(pib.encode("latin-1"))
    (raw / "POP2022.csv").write_bytes(pop.encode("latin-1"))
    lax = Thresholds(min_ativos=2, min_municipios=2, min_cnaes_descritos=2, min_registros_uf=1)
    with pytest.raises(diagnosis.IngestionBlocked, match="minimo_ativos"):
        pipeline.run_pipeline(spark, [str(raw)], str(tmp_path / "a"))
    blocked = spark.read.json(str(tmp_path / "a/diagnostico/bloqueios")).filter("bloqueado")
    assert "minimo_ativos" in {r.regra for r in blocked.collect()}
    (raw / "leia-me.txt").write_text("x")
    left = {*os.listdir(checkpoint_folder(spark))}
    tables = pipeline.run_pipeline(spark, [str(raw)], str(tmp_path / "b"), as_of="2024-01-01", thresholds=lax)
    rows = {r.municipio: r for r in tables["gold_ranking_municipios"].collect()}
    assert spark.sql("select count(*) from gold_ranking_municipios").first()[0] == len(rows) == spark.table("silver_municipios").count() - 1
    assert rows["FLORIANÓPOLIS"].populacao == 537211.0 and rows["FLORIANÓPOLIS"].pib_per_capita == 70000.5
    assert rows["JOINVILLE"].populacao == 616323.0 and rows["JOINVILLE"].pib_per_capita is None
    matches = {r.dimensao: r.percentual_match for r in spark.read.json(str(tmp_path / "b/diagnostico/matches")).collect()}
    assert matches == {"empresas": 100.0, "municipios": 100.0, "cnaes": 100.0, "naturezas": 0.0}
    assert {*os.listdir(checkpoint_folder(spark))} == left
    counts = {r.source: r.n for r in spark.read.json(str(tmp_path / "b/diagnostico/linhas_estabelecimentos")).collect()}
    assert counts == {f"{raw}/Estabelecimentos{i}.csv": 4 if i == 0 else 0 for i in range(10)}
    listed = spark.read.json(str(tmp_path / "b/diagnostico/catalogo")).filter("not processed").collect()
    assert {r.ignored_reason for r in listed} == {"nome nao classificado"} and any("leia-me" in r.label for r in listed)
    sizes = {r.tabela: r.n for r in spark.read.json(str(tmp_path / "b/diagnostico/linhas_tabelas")).collect()}
    assert sizes == {"municipios": 3, "cnaes": 2, "naturezas": 0, "empresas_com_estabelecimento": 2}
    _, rules = pipeline.audit(spark, str(tmp_path / "b"), lax)
    assert rules.filter("bloqueado").isEmpty()


def test_counted_matches_funnel(spark):
    df = spark.createDataFrame([(" sc ", "02"), ("SC", "08"), (None, "2"), ("PR", "02")], "uf string, situacao_cadastral string")
    seen = Observation("funnel")
    bronze.counted(df, "SC", seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"lidos": 4, "na_uf": 2, "ativos": 1}


def test_empty_histogram_keys(spark):
    df = spark.createDataFrame([(None, "02"), ("", "02"), ("9X", "08"), ("sc", None)], "uf string, situacao_cadastral string")
    hist = diagnosis.uf_histogram(diagnosis.ingest_counts(df.withColumn("source", F.lit("s"))))
    assert [tuple(r) for r in diagnosis.strange_ufs(hist).collect()] == [("", 2), ("9X", 1)]


def test_one_municipality_scores_zero(spark, built):
    tables, _ = built
    one = tables["gold_empresas_ativas"].filter("municipio = 'JOINVILLE'")
    row = gold.ranking_municipios(one).first()
    assert (row.score_oportunidade, row.posicao_ranking) == (0.0, 1)


def test_medians_of_the_profile_are_the_built_in_ones(spark):
    df = spark.range(3000).select(
        F.lit("SC").alias("uf"),
        F.when(F.col("id") % 3 == 0, "M0").otherwise(F.concat(F.lit("M"), (F.col("id") % 4).cast("string"))).alias("municipio"),
        F.when(F.col("id") % 50 != 0, (F.col("id") % 3).cast("string")).alias("cnae_principal"),
        F.lit(None).cast("string").alias("descricao_cnae"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).alias("capital_social"),
        (F.col("id") % 41).alias("idade_empresa_anos"),
        F.lit(1000.0).alias("populacao"),
    )
    cell = ["municipio", "cnae_principal"]
    plain = df.groupBy(*cell).agg(F.median("capital_social"), F.median("idade_empresa_anos")).collect()
    ours = gold.municipio_cnae(df).select(*cell, "capital_social_mediano", "idade_mediana_empresas").collect()
    assert sorted(map(repr, map(tuple, ours))) == sorted(map(repr, map(tuple, plain))) and len(ours) == 11


def test_null_municipality_is_a_group_without_share(spark, built):
    tables, _ = built
    df = tables["gold_empresas_ativas"].withColumn("municipio", F.lit(None).cast("string"))
    rows = gold.municipio_cnae(df).collect()
    assert len(rows) == 2 and all(r.participacao_cnae_no_municipio is None for r in rows)
    assert gold.ranking_municipios(df).count() == 1


def test_explore(spark, built):
    tables, _ = built
    df = tables["gold_empresas_ativas"]
    f = explore.Filters(municipio=("JOINVILLE",), cnae=("4711302 - COMERCIO VAREJISTA",), mei=("S",), capital=(0, 90000.0))
    assert explore.apply_filters(df, f).count() == 1
    assert explore.apply_filters(df, explore.Filters()).count() == 2
    assert explore.search(df, "alfa").count() == 1 and explore.search(df, "").count() == 2 and explore.search(df, ".*").count() == 0
    k = explore.kpis(df).first()
    assert (k.empresas, k.municipios, k.cnaes, k.capital_total, k.idade_mediana) == (2, 2, 2, 240000.0, 5.5)
    cards = explore.kpi_cards(explore.kpis(df)).first()
    assert (cards.empresas, cards.capital_total, cards.idade_mediana) == ("2", "R$ 240,0 mil", "5,5")
    assert explore.kpis(df.limit(0)).first().idade_mediana is None
    assert explore.range_bounds(df).first()[:] == (6, 150000.0)
    assert explore.range_bounds(df.limit(0)).first()[:] == (1, 1.0)
    wide = explore.pivot_counts(tables["gold_municipio_cnae"], "municipio", "descricao_cnae", "total_empresas_ativas")
    assert {r.municipio: r["COMERCIO VAREJISTA"] for r in wide.collect()} == {"FLORIANÓPOLIS": 0, "JOINVILLE": 1}
    assert explore.friendly(tables["gold_ranking_cnaes"], explore.FRIENDLY_CNAES).columns[-1] == "Score relevancia"
    assert "Posicao" in explore.friendly(tables["gold_ranking_municipios"], explore.FRIENDLY_MUNICIPIOS).columns
    assert sorted(r.label for r in explore.cnae_labels(df).collect())[0] == "4711302 - COMERCIO VAREJISTA"
    assert explore.value_counts(df, "porte_empresa", "Sem porte", "porte").count() == 2


def test_scan_invisible(spark):
    text = "a b \r\nok\x0b​﻿\x01x\x1f \x07\ttab"
    df = spark.createDataFrame([(1, text), (2, "plain\nrows"), (3, None)], "i int, t string")
    got = sorted((r.line_no, r.col or 0, r.label) for r in quality.scan_invisible(df, "i", "t").collect())
    expected = []
    names = {" ": "U+00A0 non-breaking space", "​": "U+200B zero-width space", "﻿": "U+FEFF BOM"}
    for number, line in enumerate(text.splitlines(), 1):
        expected += [(number, 0, label) for ch, label in names.items() if ch in line]
        expected += [(number, i, f"control char U+{ord(ch):04X}") for i, ch in enumerate(line, 1) if ord(ch) < 32 and ch not in "\t\r\n"]
    assert got == sorted(expected)
