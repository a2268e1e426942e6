"""What lies in the raw folders: files and archive members with their kind."""

from __future__ import annotations

import zipfile
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.text import normalize_text
from marketlens.schemas import LAYOUTS
from marketlens.session import durable
from marketlens.sources.files import children, is_zip, open_file

# Tokens of lower-cased names per kind; the first kind with a hit wins.
NAME_TOKENS = {
    "estabelecimentos": ("estabele", "estab", ".est"),
    "empresas": ("empresa", "empre", ".emp"),
    "cnaes": ("cnae",),
    "municipios": ("munic",),
    "naturezas": ("natureza", "natju"),
    "motivos": ("motivo", "moti"),
    "simples": ("simples",),
    "consolidado": ("pib", "populacao", "população", "ibge", "consolid"),
}
# The tokens used on whole paths.
PATH_TOKENS = {
    "estabelecimentos": ("estabele", "estab"),
    "empresas": ("empresa", "empre"),
    "cnaes": ("cnae",),
    "municipios": ("munic",),
    "naturezas": ("natureza", "natju", "nat_jurid"),
    "simples": ("simples",),
    "consolidado": ("pib", "populacao", "população", "ibge", "consolid"),
}
UNKNOWN = "desconhecido"

COLUMNS = ("kind", "root_path", "archive_members", "processed", "ignored_reason", "label", "size_bytes")


_FILES = pa.schema([("root", pa.string()), ("path", pa.string()), ("size_bytes", pa.int64())])
_LEVEL = pa.schema([*_FILES, ("folder", pa.bool_())])
_KINDS = pa.schema([*_FILES, ("zipped", pa.bool_())])
_MEMBERS = pa.schema(
    [
        ("root", pa.string()),
        ("path", pa.string()),
        ("archive_members", pa.list_(pa.string())),
        ("size_bytes", pa.int64()),
        ("state", pa.string()),
    ]
)
_HEADS = pa.schema([("path", pa.string()), ("head", pa.string())])
_BATCH_ROWS = 10_000
_MOST_TASKS = 10_000  # of a round of listing


def _batches(schema: pa.Schema, rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while chunk := list(islice(rows, _BATCH_ROWS)):
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in chunk], schema=schema)


def classify_kind(c: Column | str, scope: str = "name") -> Column:
    """Kind of a file by its name, or by its whole path; null when nothing matches."""
    tokens = {"name": NAME_TOKENS, "path": PATH_TOKENS}[scope]
    lower = F.lower(F.col(c) if isinstance(c, str) else c)
    kind = F.lit(None).cast("string")
    for name in reversed(list(tokens)):
        hit = F.lit(False)
        for token in tokens[name]:
            hit = hit | lower.contains(token)
        kind = F.when(hit, F.lit(name)).otherwise(kind)
    return kind


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every file under the given folders or files: root, path, size. A path that does not
    exist adds nothing; a file below several roots is listed under one of them.

    Folders are listed by the executors, level by level: what is found in the folders of a level is
    stored, and the folders among it are the next level, spread over tasks again. A task holds the
    listing of one folder at a time. Contents are not read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batches(_LEVEL, ((row["root"], *child) for child in children(row["path"])))

    schema = "root string, path string, size_bytes long, folder boolean"
    level = spark.createDataFrame([(p, p) for p in paths], "root string, path string")
    files = spark.createDataFrame([], "root string, path string, size_bytes long")
    folders = len(paths)
    while folders:
        spread = level.repartitionByRange(min(folders, _MOST_TASKS), "path")
        found = durable(spread.mapInArrow(read, schema))
        files = files.unionByName(found.filter("not folder").drop("folder"))
        level = found.filter("folder").groupBy("path").agg(F.min("root").alias("root")).select("root", "path")
        folders = level.count()
    return files.dropDuplicates(["path"])


def _by_path(files: DataFrame) -> DataFrame:
    """Files spread over tasks to be opened there, by ranges of a stated number: adaptive execution
    would put rows as small as these into one task."""
    return files.repartitionByRange(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")


def with_archives(files: DataFrame) -> DataFrame:
    """The files with `zipped`: named .zip, or a zip archive by its first bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield from _batches(
                _KINDS, ((r["root"], r["path"], r["size_bytes"], r["path"].lower().endswith(".zip") or is_zip(r["path"])) for r in rows)
            )

    schema = "root string, path string, size_bytes long, zipped boolean"
    return _by_path(files.select("root", "path", "size_bytes")).mapInArrow(read, schema)


def _members(path: str, nested: bool) -> Iterator[tuple[list[str], int, str]]:
    """Members, sizes and state of one archive, from its directory alone."""
    try:
        with open_file(path) as handle, zipfile.ZipFile(handle) as archive:
            infos = [i for i in archive.infolist() if not i.is_dir()]
            if not infos:
                yield [], 0, "empty"
            for info in infos:
                if nested and info.filename.lower().endswith(".zip"):
                    with archive.open(info) as inner_handle, zipfile.ZipFile(inner_handle) as inner:
                        for i in inner.infolist():
                            if not i.is_dir():
                                yield [info.filename, i.filename], i.file_size, "member"
                else:
                    yield [info.filename], info.file_size, "member"
    except zipfile.BadZipFile:
        yield [], 0, "invalid"


def archive_members(archives: DataFrame, nested: bool = False) -> DataFrame:
    """One row per member of each archive; the directories are read by the executors."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                rows = (
                    (file["root"], file["path"], members, size if members else file["size_bytes"], state)
                    for members, size, state in _members(file["path"], nested)
                )
                yield from _batches(_MEMBERS, rows)

    schema = "root string, path string, archive_members array<string>, size_bytes long, state string"
    return _by_path(archives.select("root", "path", "size_bytes")).mapInArrow(read, schema)


def catalog(spark: SparkSession, paths: Sequence[str], scope: str = "name") -> DataFrame:
    """One row per source under `paths`, unusable ones with the reason they are ignored.

    Files that hold a zip archive, or are named so, are archives: each member is a source, an
    inner archive counts as one. With scope "path" kinds come from the whole path below the root, one level of inner
    archives is opened, and unknown files are left out."""
    files = with_archives(list_files(spark, paths))
    by_path = scope == "path"
    members = archive_members(files.filter("zipped"), nested=by_path)
    plain = files.filter("not zipped").select(
        "root", "path", F.array().cast("array<string>").alias("archive_members"), "size_bytes", F.lit("file").alias("state")
    )
    rows = plain.unionByName(members).withColumn("name", F.element_at(F.split("path", "/"), -1))
    last = F.try_element_at("archive_members", F.lit(-1))
    if by_path:
        root = F.regexp_replace(F.col("root"), "^[a-z]+:/*|^/+|/+$", "")
        relative = F.when(F.size("archive_members") > 0, F.concat_ws("/", F.array("name"), "archive_members")).otherwise(
            F.call_function("substring_index", F.col("path"), F.concat(root, F.lit("/")), F.lit(-1))
        )
        kind = classify_kind(relative, "path")
        rows = rows.withColumn("found", kind).filter(F.col("found").isNotNull())
        good, reason = F.lit(True), F.lit("")
        label_root = F.col("name")
    else:
        outer = classify_kind("name")
        inner = F.coalesce(classify_kind(last), outer)
        tabular = [*LAYOUTS]
        is_inner_zip = F.lower(F.coalesce(last, F.lit(""))).endswith(".zip")
        rows = rows.withColumn("outer", outer).withColumn("found", F.when(F.col("state") == "member", inner).otherwise(outer))
        usable = F.col("found").isin(*tabular)
        good = F.coalesce(
            F.when(F.col("state") == "empty", F.lit(False))
            .when(is_inner_zip | (F.col("state") == "invalid"), usable)
            .otherwise(usable | (F.col("found") == "consolidado")),
            F.lit(False),
        )
        reason = (
            F.when(good, "")
            .when(F.col("state") == "empty", "zip vazio")
            .when(F.col("state") == "invalid", "zip invalido")
            .when(is_inner_zip, "zip interno nao classificado")
            .when(F.col("state") == "member", "membro nao classificado")
            .otherwise("nome nao classificado")
        )
        label_root = F.col("path")
    kept_kind = F.when(good | (F.col("state") == "empty"), F.coalesce("found", F.lit(UNKNOWN))).otherwise(UNKNOWN)
    return rows.select(
        kept_kind.alias("kind"),
        F.col("path").alias("root_path"),
        "archive_members",
        good.alias("processed"),
        reason.alias("ignored_reason"),
        F.concat_ws("::", F.array(label_root), "archive_members").alias("label"),
        "size_bytes",
    ).dropDuplicates(["kind", "root_path", "archive_members"])


def sources_of_kind(sources: DataFrame, kind: str) -> DataFrame:
    return sources.filter(F.col("processed") & (F.col("kind") == kind))


def file_heads(files: DataFrame) -> DataFrame:
    """The first line of each file, Latin-1 decoded, however long it is."""

    def first_line(path: str) -> str:
        with open_file(path) as handle:
            lines = handle.readline().decode("latin-1").splitlines()
        return lines[0] if lines else ""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(_HEADS, ((path, first_line(path)) for path in batch.column("path").to_pylist()))

    return files.select("path").mapInArrow(read, "path string, head string")


def find_indicator_file(spark: SparkSession, sources: DataFrame, paths: Sequence[str]) -> str | None:
    """The indicator CSV: the first one known by name, else the first with a GDP and a
    population column in its header."""
    csv = F.lower("path").endswith(".csv")
    known = sources_of_kind(sources, "consolidado").filter(F.size("archive_members") == 0)
    by_name = known.select(F.col("root_path").alias("path")).filter(csv).orderBy("path").limit(1).collect()
    if by_name:
        return by_name[0].path
    header = normalize_text("head")
    heads = file_heads(list_files(spark, paths).filter(csv))
    by_header = heads.filter(header.contains("PIB") & header.contains("POP")).orderBy("path").limit(1).collect()
    return by_header[0].path if by_header else None
