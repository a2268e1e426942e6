"""Readers for the raw dump, the indicator files and the stored tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.text import clean_cell, empty_to_null, normalize_name, normalize_text, only_digits
from marketlens.schemas import (
    GOLD_SCHEMAS,
    INDICATOR_COLUMNS,
    LAYOUTS,
    RAW_ENCODING,
    RAW_SEPARATOR,
    string_schema,
)
from marketlens.sources.catalog import file_heads, list_files, sources_of_kind
from marketlens.sources.splitcsv import SPLIT_BYTES, read_records, splittable
from marketlens.sources.tables import Tables
from marketlens.sources.zipcsv import ZipCsvDataSource

SEPARATORS = (";", ",", "|", "\t")

# Header texts of each indicator role, most wanted first.
INDICATOR_ROLES = {
    "municipio": ("municipio", "nome_municipio", "cidade"),
    "ibge": ("codigo_municipio_ibge", "cod_municipio_ibge", "ibge"),
    "cnae": ("cnae", "cnae_principal"),
    "populacao": ("populacao", "população"),
    "pib": ("pib_per_capita", "pib per capita"),
}
# Header texts of the official GDP and population tables.
PIB_ROLES = {
    "uf": ("Sigla da Unidade da Federação", "UF"),
    "ibge": ("Código do Município", "Codigo do Municipio"),
    "municipio": ("Nome do Município", "Nome do Municipio"),
    "value": ("Produto Interno Bruto per capita", "PIB per capita"),
}
POP_ROLES = {
    "uf": ("UF",),
    "ibge": ("Código do Município", "Codigo do Municipio"),
    "municipio": ("NOME DO MUNICÍPIO", "Nome do Município", "Nome do Municipio"),
    "value": ("POPULAÇÃO ESTIMADA", "Populacao", "População"),
}


def _cell(c: Column) -> Column:
    """A cleaned cell; empty becomes null, here and nowhere later."""
    return empty_to_null(clean_cell(c))


def empty_table(spark: SparkSession, kind: str) -> DataFrame:
    return spark.createDataFrame([], string_schema([*LAYOUTS[kind], "source"]))


def irregular_files(spark: SparkSession, paths: Sequence[str]) -> dict[str, bool]:
    """Files that Spark's line-wise parser would read wrongly, and whether a quoted cell may run over
    a line break in them (a line holds an odd number of quotes); the others have lines of nothing but
    blanks, which are records. One pass over the text; the result has one name per such file."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.text(list(paths)).select((quotes % 2 == 1).alias("odd"), "value", F.col("_metadata.file_path").alias("path"))
    found = lines.filter(F.col("odd") | F.col("value").rlike("^[\\x00-\\x20]+$")).groupBy("path").agg(F.bool_or("odd").alias("odd"))
    # The metadata column is URL-encoded, listed paths are not.
    return {unquote(r.path): r.odd for r in found.collect()}


def _sizes(spark: SparkSession, paths: Sequence[str]) -> dict[str, int]:
    """Size of each file by its URI, as Spark's readers list it."""
    return {r.path: r.length for r in spark.read.format("binaryFile").load(list(paths)).select("path", "length").collect()}


def _named(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _read_csv(spark: SparkSession, kind: str, paths: Sequence[str], encoding: str, multiline: bool) -> DataFrame:
    raw = (
        spark.read.schema(string_schema(LAYOUTS[kind]))
        .options(sep=RAW_SEPARATOR, quote='"', escape='"', encoding=encoding, header=False, mode="PERMISSIVE")
        .options(multiLine=multiline)
        .csv(list(paths))
    )
    # The metadata column is a URL-encoded URI, sources are named as they are listed.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return raw.select(*[_cell(F.col(c)).alias(c) for c in LAYOUTS[kind]], _named(path).alias("source"))


def _read_split(spark: SparkSession, kind: str, sizes: dict[str, int], encoding: str, split_bytes: int) -> DataFrame:
    files = spark.createDataFrame(list(sizes.items()), "path string, size long")
    raw = read_records(files, RAW_SEPARATOR, encoding, split_bytes)
    cells = [_cell(F.try_element_at("cells", F.lit(i + 1))).alias(c) for i, c in enumerate(LAYOUTS[kind])]
    return raw.select(*cells, _named(F.col("path")).alias("source"))


def read_files(
    spark: SparkSession,
    kind: str,
    paths: Sequence[str],
    encoding: str = RAW_ENCODING,
    multiline: bool | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Headerless files of one kind as all-string rows with a `source` column.

    Lines are records unless a quoted cell may span them or blanks fill them; by default such files
    are looked up in one extra pass and read in splits of their own (`read_records`).
    `multiline=True` reads every file so; `multiline=False` skips the pass for dumps known to be free
    of such cells, and then leaves lines of blanks out. Compressed files and encodings wider than a
    byte can't be split: there a file with open quotes is one task, and lines of blanks are left out."""
    if not paths:
        return empty_table(spark, kind)
    odd = irregular_files(spark, paths) if multiline is None else {}
    if not odd and not multiline:
        return _read_csv(spark, kind, paths, encoding, False)
    sizes = _sizes(spark, paths)
    split = {p: n for p, n in sizes.items() if (multiline or p in odd) and splittable(p, encoding)}
    whole = [p for p in sizes if p not in split and (multiline or odd.get(p))]
    plain = [p for p in sizes if p not in split and p not in whole]
    tables = [_read_split(spark, kind, split, encoding, split_bytes)] if split else []
    tables += [_read_csv(spark, kind, some, encoding, wide) for some, wide in ((whole, True), (plain, False)) if some]
    return reduce(DataFrame.unionByName, tables)


def read_archives(
    spark: SparkSession,
    kind: str,
    members: Sequence[tuple[str, str | None]],
    encoding: str = RAW_ENCODING,
    spread: int | None = None,
) -> DataFrame:
    """Archive members of one kind in the same shape; short records padded, long ones cut.

    One task inflates a member; `spread` redistributes the rows over that many tasks before
    they are cleaned, for dumps in which one member holds most of them."""
    if not members:
        return empty_table(spark, kind)
    spark.dataSource.register(ZipCsvDataSource)
    raw = spark.read.format("zipcsv").options(sources=json.dumps(list(members)), encoding=encoding).load()
    if spread:
        raw = raw.repartition(spread)
    cells = [_cell(F.try_element_at("cells", F.lit(i + 1))).alias(c) for i, c in enumerate(LAYOUTS[kind])]
    return raw.select(*cells, "source")


def read_receita(
    spark: SparkSession,
    kind: str,
    sources: DataFrame,
    encoding: str = RAW_ENCODING,
    multiline: bool | None = None,
    spread: int | None = None,
) -> DataFrame:
    """All processed sources of one kind in a catalogue, appended. Only names reach the driver."""
    rows = sources_of_kind(sources, kind).select("root_path", "archive_members").orderBy("root_path", "archive_members").collect()
    zipped_rows, plain = [], []
    for r in rows:
        if r.archive_members or r.root_path.lower().endswith(".zip"):
            zipped_rows.append(r)
        else:
            plain.append(r.root_path)
    members = [(r.root_path, r.archive_members[0] if r.archive_members else None) for r in zipped_rows]
    if not members:
        return read_files(spark, kind, plain, encoding, multiline)
    zipped = read_archives(spark, kind, members, encoding, spread)
    return read_files(spark, kind, plain, encoding, multiline).unionByName(zipped) if plain else zipped


def pick_column(columns: Sequence[str], options: Sequence[str]) -> str | None:
    """The column whose normalised name equals an option, else the first that contains one."""
    names = {normalize_name(c): c for c in columns}
    wanted = [normalize_name(o) for o in options]
    for option in wanted:
        if option in names:
            return names[option]
    for option in wanted:
        for name, original in names.items():
            if option in name:
                return original
    return None


def detect_separator(spark: SparkSession, path: str) -> str:
    """The candidate occurring most often in the first line; a semicolon when none does."""
    visible = ~F.element_at(F.split("path", "/"), -1).rlike("^[._]")  # as Spark's readers see a folder
    head = file_heads(list_files(spark, [path]).filter(visible).orderBy("path").limit(1)).first()
    counts = {sep: head.head.count(sep) if head else 0 for sep in SEPARATORS}
    return max(SEPARATORS, key=lambda sep: counts[sep])


def read_headered(
    spark: SparkSession, path: str, sep: str = "auto", encoding: str = RAW_ENCODING, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """An all-string table with a header line, in the order of the file; cells may span lines.

    Files with such cells, or with lines of nothing but blanks (records without further cells), are
    read in splits, where an empty quoted cell is null as an unquoted one."""
    sep = detect_separator(spark, path) if sep == "auto" else sep
    odd = irregular_files(spark, [path])
    options = {"header": True, "sep": sep, "encoding": encoding, "quote": '"', "escape": '"', "inferSchema": False}
    raw = spark.read.options(**options, multiLine=any(odd.values())).csv(path)
    names = [c.replace("ï»¿", "").replace("\ufeff", "").strip() for c in raw.columns]
    if not odd or not all(splittable(p, encoding) for p in odd):
        return raw.toDF(*names)
    files = spark.createDataFrame(list(_sizes(spark, [path]).items()), "path string, size long")
    records = read_records(files, sep, encoding, split_bytes, header=True)
    return records.select(*[empty_to_null(F.try_element_at("cells", F.lit(i + 1))).alias(f"c{i}") for i in range(len(names))]).toDF(*names)


def _role(df: DataFrame, options: Sequence[str]) -> Column:
    found = pick_column(df.columns, options)
    return F.lit("") if found is None else F.coalesce(F.col(f"`{found}`"), F.lit(""))


def read_indicators(spark: SparkSession, path: str, sep: str = "auto", encoding: str = RAW_ENCODING) -> DataFrame:
    """Population and GDP per municipality from a CSV whose columns are found by name."""
    df = read_headered(spark, path, sep, encoding)
    return df.select(
        empty_to_null(normalize_text(_role(df, INDICATOR_ROLES["municipio"]))).alias("municipio_norm"),
        empty_to_null(only_digits(_role(df, INDICATOR_ROLES["ibge"]))).alias("codigo_municipio_ibge"),
        empty_to_null(only_digits(_role(df, INDICATOR_ROLES["cnae"]))).alias("cnae_principal"),
        empty_to_null(_role(df, INDICATOR_ROLES["populacao"])).alias("populacao"),
        empty_to_null(_role(df, INDICATOR_ROLES["pib"])).alias("pib_per_capita"),
    )


def empty_indicators(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], string_schema(INDICATOR_COLUMNS))


def indicator_side(df: DataFrame, roles: dict[str, tuple[str, ...]], out: str, target_uf: str) -> DataFrame | None:
    """One side of the indicator merge from an official table: rows of the state with code,
    normalised name, value and their place in the file. None when a column is missing."""
    if any(pick_column(df.columns, options) is None for options in roles.values()):
        return None
    placed = df.withColumn("seq", F.monotonically_increasing_id())
    return placed.filter(F.trim(F.upper(_role(df, roles["uf"]))) == target_uf).select(
        only_digits(_role(df, roles["ibge"])).alias("codigo_municipio_ibge"),
        normalize_text(_role(df, roles["municipio"])).alias("municipio_norm"),
        _role(df, roles["value"]).alias(out),
        "seq",
    )


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored gold table: its current version, or Parquet under its name, if there, else its CSV
    export read with its own schema, so that codes keep their leading zeros."""
    current = Tables(spark, folder).entries().get(name)
    if current is not None:
        return Tables(spark, folder).open(current)
    try:
        return spark.read.parquet(f"{folder}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.read.schema(GOLD_SCHEMAS[name]).options(header=True, escape='"').csv(f"{folder}/csv/{name}")
