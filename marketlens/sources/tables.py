"""Tables that outlive a session and lie by key.

Every version of a table is written to a folder of its own. A manifest names the current version of
every table; a set of new versions becomes current all at once, when the next manifest is complete.
Until then, also if the job that writes them dies, readers find the old versions whole. Manifests are
numbered and never overwritten, so of two writers that started from the same one the later fails.

Tables that are joined on a key can be written in buckets of it: a join of two of them needs no
shuffle, in any session. A key that holds far more rows than others would make one bucket, and one
task, of them; the rows per bucket are counted first, and such tables are written plainly, so that
adaptive execution can split the key in a shuffled join."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A bucket may hold so many times the mean of rows, and any bucket so many.
MOST_OF_MEAN = 4
SMALL_BUCKET = 10_000


class Superseded(RuntimeError):
    """Another job has replaced tables since this one started."""


@dataclass(frozen=True)
class Entry:
    """The current version of a table; ddl and buckets say how to read one that lies by key."""

    path: str
    ddl: str
    key: str | None = None
    buckets: int = 0


def bucket_of(key: str, buckets: int):
    """The bucket that Spark writes a row to."""
    return F.pmod(F.hash(key), F.lit(buckets))


def lies_evenly(df: DataFrame, key: str, buckets: int) -> bool:
    """Whether no bucket of `key` would hold far more rows than the others; reads the key alone."""
    counts = df.groupBy(bucket_of(key, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return (row["most"] or 0) <= max(SMALL_BUCKET, MOST_OF_MEAN * (row["rows"] or 0) / buckets)


@dataclass
class Replacement:
    """New versions of some tables, readable at once by those who write them."""

    tables: Tables
    entries: dict[str, Entry] = field(default_factory=dict)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a new version of a table and return it as read back."""
        path = self.tables.version_path(name)
        df.write.parquet(path)
        self.entries[name] = Entry(path, df._jdf.schema().toDDL())
        return self.read(name)

    def write_by_key(self, parts: Mapping[str, DataFrame], key: str, buckets: int | None = None) -> dict[str, DataFrame]:
        """Write tables that are joined on `key`, all in buckets of it, or all plainly if one of them
        has a key with far more rows than others."""
        buckets = buckets or int(self.tables.spark.conf.get("spark.sql.shuffle.partitions"))
        if not all(lies_evenly(df, key, buckets) for df in parts.values()):
            return {name: self.write(df, name) for name, df in parts.items()}
        for name, df in parts.items():
            path = self.tables.version_path(name)
            laid = df.repartition(buckets, key)  # a file per bucket
            laid.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(_session_name(path))
            self.entries[name] = Entry(path, df._jdf.schema().toDDL(), key, buckets)
        return {name: self.read(name) for name in parts}

    def read(self, name: str) -> DataFrame:
        return self.tables.open(self.entries[name])


def _session_name(path: str) -> str:
    """A table's name in the session's catalogue: one per version."""
    return f"marketlens_{path.rsplit('/', 1)[-1]}"


class Tables:
    """The tables under a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def version_path(self, name: str) -> str:
        return f"{self.folder}/tables/{name}/{uuid.uuid4().hex}"

    def _manifest(self, number: int):
        return self._path(f"{self.folder}/manifests/{number:012d}.json")

    def _numbers(self) -> list[int]:
        """Of the manifests that are there, the latest first."""
        folder = self._path(f"{self.folder}/manifests")
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)

    def _read(self, number: int) -> dict[str, Entry] | None:
        """A manifest's entries; None for one that is being written or was never finished."""
        stream = self._files.open(self._manifest(number))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return {name: Entry(**entry) for name, entry in json.loads(text)["tables"].items()}
        except ValueError:
            return None

    def entries(self) -> dict[str, Entry]:
        """Name and current version of every table."""
        for number in self._numbers():
            found = self._read(number)
            if found is not None:
                return found
        return {}

    def open(self, entry: Entry) -> DataFrame:
        if entry.key is None:
            return self.spark.read.schema(entry.ddl).parquet(entry.path)
        name = _session_name(entry.path)
        if not self.spark.catalog.tableExists(name):  # a session that didn't write it
            self.spark.sql(
                f"CREATE TABLE {name} ({entry.ddl}) USING parquet CLUSTERED BY (`{entry.key}`) SORTED BY (`{entry.key}`) INTO {entry.buckets} BUCKETS LOCATION '{entry.path}'"
            )
        return self.spark.table(name)

    def read(self, name: str) -> DataFrame:
        """The current version of a table."""
        return self.open(self.entries()[name])

    def register(self) -> list[str]:
        """Let SQL of this session find the current versions by their names."""
        entries = self.entries()
        for name, entry in entries.items():
            self.open(entry).createOrReplaceTempView(name)
        return sorted(entries)

    @contextmanager
    def replacing(self) -> Iterator[Replacement]:
        """Collect new versions; they become current together when the block ends well. If it raises,
        nothing changes and what was written is deleted."""
        numbers = self._numbers()
        before = self.entries()
        new = Replacement(self)
        try:
            yield new
            text = json.dumps({"tables": {name: asdict(e) for name, e in {**before, **new.entries}.items()}})
            self._commit((numbers[0] if numbers else 0) + 1, text)
        except BaseException:
            for entry in new.entries.values():
                self._files.delete(self._path(entry.path), True)
            raise

    def _commit(self, number: int, text: str) -> None:
        path = self._manifest(number)
        if self._files.exists(path):
            raise Superseded(f"{path} is there already")
        try:
            stream = self._files.create(path, False)  # fails if it has come up meanwhile
        except Exception as error:
            raise Superseded(f"{path} is there already") from error
        stream.write(text.encode())
        stream.close()

    def vacuum(self, keep: int = 1) -> int:
        """Delete versions that none of the `keep` latest manifests names, and older manifests. Not
        while tables are being replaced. Returns the number of versions deleted."""
        whole = [(n, e) for n in self._numbers() if (e := self._read(n)) is not None]
        if not whole:
            return 0
        named = {entry.path.rsplit("/", 1)[-1] for _, entries in whole[:keep] for entry in entries.values()}
        gone = 0
        for table in self._files.listStatus(self._path(f"{self.folder}/tables")):
            for version in self._files.listStatus(table.getPath()):
                if version.getPath().getName() not in named:
                    self._files.delete(version.getPath(), True)
                    gone += 1
        for number in self._numbers():
            if number not in {n for n, _ in whole[:keep]}:
                self._files.delete(self._manifest(number), False)
        return gone
