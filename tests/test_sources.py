import csv
import io
import json
import zipfile

import pytest
from conftest import SAMPLE, raw_text
from pyspark.sql import functions as F

from marketlens.schemas import LAYOUTS
from marketlens.plans import bronze
from marketlens.sources import readers, sinks
from marketlens.sources.catalog import catalog, classify_kind, find_indicator_file, sources_of_kind
from marketlens.sources import zipcsv
from marketlens.sources.zipcsv import ZipCsvDataSource, ZipCsvReader


def zip_bytes(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, data in members.items():
            archive.writestr(name, data)
    return buffer.getvalue()


def test_classifier_precedence(spark):
    names = {
        "K3241.ESTABELE": "estabelecimentos", "X.EMPRECSV": "empresas", "F.CNAECSV": "cnaes", "MUNICCSV": "municipios",
        "NATJUCSV": "naturezas", "MOTICSV": "motivos", "SIMPLES": "simples", "pib.csv": "consolidado", "readme.txt": None,
        "PIB dos Municipios.csv": "municipios", "Empresas_cnae.zip": "empresas", "a.est": "estabelecimentos",
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.k for r in df.select("n", classify_kind("n").alias("k")).collect()}
    assert got == names
    path = {r.n: r.k for r in df.select("n", classify_kind("n", "path").alias("k")).collect()}
    assert path["MOTICSV"] is None and path["a.est"] is None and path["NATJUCSV"] == "naturezas"


def test_reader_agrees_with_csv_module(spark, tmp_path):
    text = (
        '"00000001";"0001";"01";"1";"Café ""do"" Zé; e Cia";"02"\r\n'
        '\r\n'
        '"00000002";"0001"\r\n'
        '"00000003";" 0001 ";"﻿"\r\n' .replace("﻿", "")
        + ";".join(f'"c{i}"' for i in range(35)) + "\r\n"
        '00000005;x"y;z\r\n'
    )
    path = tmp_path / "estabelecimentos.csv"
    path.write_bytes(text.encode("latin-1"))
    width = len(LAYOUTS["estabelecimentos"])
    expected = []
    for row in csv.reader(io.StringIO(text, newline=""), delimiter=";", quotechar='"'):
        if row:
            cells = [c.strip() or None for c in row[:width]]
            expected.append(tuple(cells + [None] * (width - len(cells))))
    for multiline in (None, False, True):
        df = readers.read_files(spark, "estabelecimentos", [str(path)], multiline=multiline)
        got = [tuple(r)[:width] for r in df.orderBy("cnpj_basico").collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)
    archive = tmp_path / "Estabelecimentos0.zip"
    archive.write_bytes(zip_bytes({"K.ESTABELE": text.encode("latin-1")}))
    zipped = readers.read_archives(spark, "estabelecimentos", [(str(archive), "K.ESTABELE")], spread=3)
    assert sorted([tuple(r)[:width] for r in zipped.collect()], key=str) == sorted(expected, key=str)


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "cnaes_a.csv").write_bytes(b'"1";"one\r\ntwo"\r\n"2";"x"\r\n')
    (tmp_path / "cnaes_b.csv").write_bytes(b'"3";"y"\r\n')
    paths = [str(tmp_path / "cnaes_a.csv"), str(tmp_path / "cnaes_b.csv")]
    assert [p.rsplit("/", 1)[1] for p in readers.irregular_files(spark, paths)] == ["cnaes_a.csv"]
    got = {r.cnae: r.descricao_cnae for r in readers.read_files(spark, "cnaes", paths).collect()}
    assert got == {"1": "one\r\ntwo", "2": "x", "3": "y"}


def test_catalogue_and_nested_archives(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "sub").mkdir(parents=True)
    estab = raw_text(SAMPLE["estabelecimentos"]).encode("latin-1")
    emp = raw_text(SAMPLE["empresas"]).encode("latin-1")
    deep = zip_bytes({"D.ESTABELE": estab})
    (raw / "download.zip").write_bytes(
        zip_bytes(
            {
                "Empresas0.zip": zip_bytes({"K.EMPRECSV": emp}),
                "Estabelecimentos0.zip": zip_bytes({"K.ESTABELE": estab, "more.zip": deep}),
                "cnaes.csv": b'"1";"a"\r\n',
                "notes.txt": b"hello",
                "other.zip": zip_bytes({"a.txt": b"x"}),
            }
        )
    )
    (raw / "vazio.zip").write_bytes(zip_bytes({}))
    (raw / "ruim.zip").write_bytes(b"not a zip")
    (raw / "sub" / "municipios.csv").write_bytes(b'"8105";"X"\r\n')
    (raw / "sub" / "leia.txt").write_text("x")
    sources = catalog(spark, [str(raw), str(tmp_path / "missing"), str(raw / "sub")])
    rows = {r.label.rsplit("/", 1)[-1]: r for r in sources.collect()}
    assert sources.count() == 9
    assert rows["download.zip::Empresas0.zip"].kind == "empresas"
    assert rows["download.zip::cnaes.csv"].processed and rows["download.zip::cnaes.csv"].size_bytes == 9
    assert rows["download.zip::notes.txt"].ignored_reason == "membro nao classificado"
    assert rows["download.zip::other.zip"].ignored_reason == "zip interno nao classificado"
    assert rows["vazio.zip"].ignored_reason == "zip vazio"
    assert rows["ruim.zip"].ignored_reason == "zip invalido"
    assert rows["leia.txt"].kind == "desconhecido" and rows["leia.txt"].ignored_reason == "nome nao classificado"
    assert [r.kind for r in sources_of_kind(sources, "municipios").collect()] == ["municipios"]

    got = readers.read_receita(spark, "estabelecimentos", sources)
    assert got.count() == 8 and {r.source for r in got.collect()} == {f"{raw}/download.zip::Estabelecimentos0.zip"}
    assert readers.read_receita(spark, "empresas", sources).count() == 3
    assert readers.read_receita(spark, "simples", sources).count() == 0

    legacy = {r.label: r.kind for r in catalog(spark, [str(raw)], scope="path").collect()}
    assert legacy["download.zip::Estabelecimentos0.zip::K.ESTABELE"] == "estabelecimentos"
    assert legacy["municipios.csv"] == "municipios" and "leia.txt" not in legacy


def test_zipcsv_load_by_path(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zip_bytes({"x.csv": b'"1";"a;b"\r\n\r\n2;"c\r\nd"\r\n'}))
    spark.dataSource.register(ZipCsvDataSource)
    rows = spark.read.format("zipcsv").load(str(tmp_path)).collect()
    label = f"{tmp_path}/a.zip::x.csv"
    assert [(r.source, list(r.cells)) for r in rows] == [(label, ["1", "a;b"]), (label, ["2", "c\r\nd"])]


def test_archives_are_known_by_content(spark, tmp_path):
    (tmp_path / "K3241.ESTABELE.D1").write_bytes(zip_bytes({"K3241.ESTABELE": b'"1";"0001"\r\n'}))
    sources = catalog(spark, [str(tmp_path)])
    row = sources.first()
    assert row.archive_members == ["K3241.ESTABELE"] and row.processed
    got = readers.read_receita(spark, "estabelecimentos", sources).collect()
    assert [(r.cnpj_basico, r.cnpj_ordem, r.source) for r in got] == [("1", "0001", row.label)]


def test_an_inner_archive_is_inflated_once_by_its_task(spark, tmp_path, monkeypatch):
    deepest = zip_bytes({"c.csv": b"3\r\n"})
    inner = zip_bytes({"a.csv": b"1\r\n", "b.csv": b"2\r\n", "more.zip": deepest})
    (tmp_path / "Estabelecimentos.zip").write_bytes(zip_bytes({"Estabelecimentos0.zip": inner, "Estabelecimentos1.csv": b"4\r\n"}))
    sources = catalog(spark, [str(tmp_path)])
    got = readers.read_receita(spark, "estabelecimentos", sources)
    assert got.rdd.getNumPartitions() == 2
    assert sorted(r.cnpj_basico for r in got.collect()) == ["1", "2", "3", "4"]
    # in this process: partitions read directories alone, a task every byte of the inner archive once
    opened, taken = [], []
    plain_open, plain_read = zipfile.ZipFile.open, zipfile.ZipExtFile.read
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, name, *a, **k: opened.append(getattr(name, "filename", name)) or plain_open(self, name, *a, **k))

    def read(self, n=-1):
        data = plain_read(self, n)
        taken.append((self.name, len(data)))
        return data

    monkeypatch.setattr(zipfile.ZipExtFile, "read", read)
    members = [(r.root_path, r.archive_members[0]) for r in sources.filter("processed").orderBy("label").collect()]
    reader = ZipCsvReader({"sources": json.dumps(members)})
    parts = reader.partitions()
    assert len(parts) == 2 and not opened
    assert sum(batch.num_rows for batch in reader.read(parts[0])) == 3
    assert opened == ["Estabelecimentos0.zip", "a.csv", "b.csv", "more.zip", "c.csv"]
    assert sum(n for name, n in taken if name == "Estabelecimentos0.zip") == len(inner)


def test_a_large_inner_archive_is_spooled_to_a_file(tmp_path, monkeypatch):
    monkeypatch.setattr(zipcsv, "SPOOL", 100)
    (tmp_path / "o.zip").write_bytes(zip_bytes({"i.zip": zip_bytes({f"{k}.csv": b"x;y\r\n" * 500 for k in range(3)})}))
    reader = ZipCsvReader({"path": str(tmp_path)})
    assert [(p.label, sum(b.num_rows for b in reader.read(p))) for p in reader.partitions()] == [(f"{tmp_path}/o.zip::i.zip", 1500)]


def test_headered_cells_over_two_lines(spark, tmp_path):
    (tmp_path / "pib.csv").write_bytes('Município;PIB;População\r\n"A\nB";10;20\r\nC;11;"2""1"\r\n'.encode("latin-1"))
    rows = readers.read_headered(spark, str(tmp_path / "pib.csv"), ";").collect()
    assert sorted(map(tuple, rows)) == [("A\nB", "10", "20"), ("C", "11", '2"1')]
    (tmp_path / "one.csv").write_bytes(b'"x\ny",z\n1,2\n')  # in the header
    table = readers.read_headered(spark, str(tmp_path / "one.csv"), ",")
    assert len(table.columns) == 2 and [tuple(r) for r in table.collect()] == [("1", "2")]


def test_sources_carry_the_label_of_the_catalogue(spark, tmp_path):
    for folder in ("a b", "c+%"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "cnaes.zip").write_bytes(zip_bytes({"cnaes.csv": b"1;x\r\n"}))
        (tmp_path / folder / "cnaes ção.csv").write_bytes(b"2;y\r\n")
    sources = catalog(spark, [str(tmp_path)])
    got = readers.read_receita(spark, "cnaes", sources)
    assert sorted(r.source for r in got.collect()) == sorted(r.label for r in sources.collect())
    assert {r.n for r in bronze.rows_by_source(got).collect()} == {1}


def test_headers_of_any_length(spark, tmp_path):
    path = tmp_path / "dados.csv"
    names = [f"coluna_{i}" for i in range(900)] + ["municipio", "populacao", "pib_per_capita"]
    path.write_text(";".join(names) + "\n" + ";".join(["0"] * 900 + ["Joinville", "5", "6"]) + "\n")
    found = find_indicator_file(spark, catalog(spark, [str(tmp_path)]), [str(tmp_path)])
    assert found == str(path) and readers.detect_separator(spark, found) == ";"
    assert readers.read_indicators(spark, found).first().populacao == "5"


def test_object_store_roots_keep_their_scheme(monkeypatch):
    from marketlens.sources import files

    class Systems:
        @staticmethod
        def from_uri(uri):
            assert uri == "s3://bucket/raw/x.csv"
            return "store", "bucket/raw/x.csv"

    monkeypatch.setattr(files.fs, "FileSystem", Systems)
    _, path, prefix = files.resolve("s3a://bucket/raw/x.csv")
    assert prefix + path == "s3a://bucket/raw/x.csv"


def test_indicators(spark, tmp_path):
    path = tmp_path / "dados.csv"
    path.write_bytes("codigo_municipio_ibge;municipio;Populacao;PIB per capita\n42-01;São José;1.000;10,5\n".encode("latin-1"))
    sources = catalog(spark, [str(tmp_path)])
    found = find_indicator_file(spark, sources, [str(tmp_path)])
    assert found.endswith("dados.csv")
    assert readers.detect_separator(spark, found) == ";"
    row = readers.read_indicators(spark, found).first()
    assert row[:] == ("SAO JOSE", "4201", None, "1.000", "10,5")
    named = tmp_path / "pib_2020.csv"
    named.write_text("a|b\n1|2\n")
    assert find_indicator_file(spark, catalog(spark, [str(tmp_path)]), [str(tmp_path)]).endswith("pib_2020.csv")
    assert readers.detect_separator(spark, str(named)) == "|"
    assert readers.pick_column(["codigo_municipio", "Município"], ("municipio",)) == "Município"
    assert readers.pick_column(["a"], ("b",)) is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("﻿007 ", 1), (None, 2)], "code string, n int")
    assert sinks.write_clean_csv(df, str(tmp_path / "c"), ["code", "n", "absent"]) == 2
    back = spark.read.csv(str(tmp_path / "c"), header=True)
    assert back.columns == ["code", "n", "absent"] and back.filter("code = '007'").count() == 1
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


@pytest.mark.parametrize("drop_parquet", [False, True])
def test_load_table_keeps_leading_zeros(spark, tmp_path, drop_parquet):
    rows = [("0001", "a", 1, 1, 2.5, 3.0, 4.0)]
    schema = "cnae_principal string, descricao_cnae string, total_empresas_ativas long, total_municipios_com_presenca long, capital_social_total double, idade_media_empresas double, score_relevancia double"
    df = spark.createDataFrame(rows, schema)
    if drop_parquet:
        sinks.write_csv(df, str(tmp_path / "csv" / "gold_ranking_cnaes"))
    else:
        sinks.export(df, str(tmp_path), "gold_ranking_cnaes")
    assert readers.load_table(spark, str(tmp_path), "gold_ranking_cnaes").first()[:] == rows[0]


def test_official_tables(spark):
    df = spark.createDataFrame(
        [("sc", "42.01", "São José", "10"), ("SC", "4201", "São José", "11"), ("PR", "41", "X", "1"), ("SC", "", "Y", "2")],
        ["Sigla da Unidade da Federação", "Código do Município", "Nome do Município", "Produto Interno Bruto per capita"],
    )
    side = readers.indicator_side(df, readers.PIB_ROLES, "pib_per_capita", "SC")
    assert side.count() == 3
    from marketlens.plans.silver import last_per_code

    assert last_per_code(side, "pib_per_capita").first()[:] == ("4201", "SAO JOSE", "11")
    assert readers.indicator_side(df.select(F.lit(1).alias("z")), readers.POP_ROLES, "populacao", "SC") is None
