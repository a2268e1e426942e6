import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlens.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("marketlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


SAMPLE = {
    "estabelecimentos": [
        ["00000001", "0001", "01", "1", "Alfa", "02", "20180115", "0", "", "", "20180115", "6201501", "", "RUA", "A", "1", "", "CENTRO", "88000000", "SC", "8105"],
        ["00000002", "0001", "02", "1", "Beta", "02", "20190520", "0", "", "", "20190520", "4711302", "", "RUA", "B", "2", "", "CENTRO", "89200000", "SC", "8047"],
        ["00000003", "0001", "03", "1", "Gama", "08", "20190520", "0", "", "", "20190520", "6201501", "", "RUA", "C", "3", "", "CENTRO", "88000000", "SC", "8105"],
        ["00000004", "0001", "04", "1", "Delta", "02", "20210110", "0", "", "", "20210110", "6201501", "", "RUA", "D", "4", "", "CENTRO", "01000000", "SP", "7107"],
    ],
    "empresas": [
        ["00000001", "ALFA LTDA", "2062", "49", "150000,00", "01", ""],
        ["00000002", "BETA LTDA", "2062", "49", "90000,00", "03", ""],
        ["00000004", "DELTA LTDA", "2062", "49", "300000,00", "05", ""],
    ],
    "municipios": [["8105", "FLORIANÓPOLIS"], ["8047", "JOINVILLE"], ["7107", "SÃO PAULO"]],
    "cnaes": [["6201501", "DESENVOLVIMENTO DE PROGRAMAS"], ["4711302", "COMERCIO VAREJISTA"]],
    "naturezas": [["2062", "SOCIEDADE LIMITADA"]],
    "simples": [
        ["00000001", "S", "20180115", "", "N", "", ""],
        ["00000002", "S", "20190520", "", "S", "20190520", ""],
    ],
}
INDICATORS = (
    "municipio,codigo_municipio_ibge,cnae,populacao,pib_per_capita\n"
    "FLORIANOPOLIS,4205407,,537211,74500.10\n"
    "JOINVILLE,4209102,,616323,68000.30\n"
)
FILE_NAMES = {
    "estabelecimentos": "estabelecimentos.csv",
    "empresas": "empresas.csv",
    "municipios": "municipios.csv",
    "cnaes": "cnaes.csv",
    "naturezas": "naturezas.csv",
    "simples": "simples.csv",
}


def raw_text(rows):
    return "".join(";".join('"' + c.replace('"', '""') + '"' for c in row) + "\r\n" for row in rows)


@pytest.fixture
def sample_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for kind, rows in SAMPLE.items():
        (folder / FILE_NAMES[kind]).write_bytes(raw_text(rows).encode("latin-1"))
    (folder / "consolidado_pib_populacao.csv").write_text(INDICATORS)
    return folder
