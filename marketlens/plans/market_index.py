"""A stored index of the market table: bitmaps per facet value, postings per trigram.

The rows are numbered in the order of municipality and company, and stored under their number. A
facet value's rows are a bitmap for each run of 32,768 numbers, so choices are ORed within a facet
and ANDed across facets, and counts under a selection are bit counts: the wide table isn't read. The
order keeps a run to few municipalities, hence the bitmaps to few values. A search intersects the
posting lists of the term's trigrams and verifies the candidates literally, so it finds what a scan
does. Nulls have no bitmap, as no choice can name them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.ranking import global_rank
from marketlens.plans.explore import FACETS, SEARCHED, Filters, apply_filters, search
from marketlens.session import broadcast_if_small, file_by_file

GRAM = 3
# Facets of a selection by their field in `Filters`.
_CHOICES = {
    "municipio": "municipio",
    "porte": "porte_empresa",
    "natureza": "descricao_natureza_juridica",
    "simples": "opcao_simples",
    "mei": "opcao_mei",
}
_ROWS_OF_A_PART = 20  # bits: a folder of the stored rows holds a million numbers
# Bounds of a building task, so that its memory doesn't grow with the table.
_ROWS_OF_A_FILE = 1 << 16
_POSTINGS_OF_A_TASK = 1 << 21


def _bucket(row: str = "row_id") -> Column:
    return F.bitmap_bucket_number(F.col(row))


def _part(row: Column) -> Column:
    """The folder of a row, the same for all rows of a bitmap; rows are numbered from 1."""
    return F.shiftright(row - 1, _ROWS_OF_A_PART)


def trigrams(text: Column) -> Column:
    """All runs of three characters; nothing for shorter texts."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d}))" % GRAM), F.lit(1)))


def _texts() -> list[Column]:
    """The texts that `search` looks at, as it looks at them."""
    return [F.coalesce("cnae_principal", F.lit("")), *[F.upper(F.coalesce(c, F.lit(""))) for c in SEARCHED]]


def _searched() -> Column:
    """Trigrams of the texts that `search` looks at."""
    return F.array_distinct(F.flatten(F.array(*[trigrams(t) for t in _texts()])))


def _posting_tasks(rows: DataFrame) -> int:
    """Tasks to sort the postings in: a text has no more trigrams than characters."""
    most = rows.agg(F.sum(sum(F.char_length(t) for t in _texts()))).first()[0] or 0
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-most // _POSTINGS_OF_A_TASK))


class MarketIndex:
    """The index stored in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @classmethod
    def build(cls, silver: DataFrame, folder: str, facets: Sequence[str] = FACETS) -> MarketIndex:
        """Write the numbered rows, the bitmaps and the postings of a market table.

        A task numbers, or takes values and trigrams of, at most the rows of a file, and sorts about
        `_POSTINGS_OF_A_TASK` postings: larger tables have more tasks, not larger ones."""
        index = cls(silver.sparkSession, folder)
        reader = file_by_file(silver.sparkSession)
        order = [F.asc_nulls_last("municipio"), F.asc_nulls_last("cnpj_completo")]
        numbered = global_rank(silver, order, "row_id", reader, _ROWS_OF_A_FILE).withColumn("row_id", F.col("row_id").cast("long"))
        silver.limit(0).write.parquet(f"{folder}/columns")
        numbered.withColumn("part", _part(F.col("row_id"))).write.partitionBy("part").parquet(f"{folder}/rows")
        rows = cls(reader, folder).numbered
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("faceta"), F.col(c).alias("valor")) for c in facets])).alias("p")
        values = rows.select("row_id", pairs).select("row_id", "p.*").filter(F.col("valor").isNotNull())
        bitmaps = values.groupBy("faceta", "valor", _bucket().alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(F.col("row_id"))).alias("bits"), F.count(F.lit(1)).alias("n")
        )
        bitmaps.repartitionByRange("faceta", "valor", "bucket").sortWithinPartitions("faceta", "valor", "bucket").write.parquet(
            f"{folder}/bitmaps"
        )
        postings = rows.select(F.explode(_searched()).alias("gram"), "row_id")
        dealt = postings.repartitionByRange(_posting_tasks(rows), "gram", "row_id")
        dealt.sortWithinPartitions("gram", "row_id").write.parquet(f"{folder}/postings")
        return index

    @property
    def numbered(self) -> DataFrame:
        columns = self.spark.read.parquet(f"{self.folder}/columns").schema
        return self.spark.read.schema(columns.add("row_id", "long").add("part", "long")).parquet(f"{self.folder}/rows")

    @property
    def bitmaps(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/bitmaps")

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/postings")

    def selected(self, choices: Mapping[str, Sequence[str]]) -> DataFrame:
        """`bucket` and `bits` of the rows that have one of the chosen values in each facet."""
        wanted = F.lit(False)
        for facet, values in choices.items():
            wanted = wanted | ((F.col("faceta") == facet) & F.col("valor").isin(*values))
        either = self.bitmaps.filter(wanted).groupBy("faceta", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        both = either.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("facets"))
        return both.filter(F.col("facets") == len(choices)).select("bucket", "bits")

    def facet_counts(self, choices: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
        """Rows per facet value among those selected, values without any left out."""
        choices = {c: v for c, v in (choices or {}).items() if v}
        if not choices:
            return self.bitmaps.groupBy("faceta", "valor").agg(F.sum("n").alias("n"))
        chosen = self.selected(choices).withColumnRenamed("bits", "chosen")
        met = self.bitmaps.join(chosen, "bucket").select("faceta", "valor", "bucket", F.explode(F.array("bits", "chosen")).alias("bits"))
        counts = met.groupBy("faceta", "valor", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
        return counts.groupBy("faceta", "valor").agg(F.sum("n").alias("n")).filter("n > 0")

    def filtered(self, f: Filters) -> DataFrame:
        """The rows of `apply_filters`: facets by bitmaps, ranges and industries on what they leave."""
        choices = {column: getattr(f, name) for name, column in _CHOICES.items() if getattr(f, name)}
        rest = Filters(cnae=f.cnae, idade=f.idade, capital=f.capital)
        if not choices:
            return apply_filters(self._market(self.numbered), rest)
        position = F.bitmap_bit_position(F.col("row_id"))
        byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("getbit", byte, (position % 8).cast("int"))
        chosen = self.selected(choices).withColumn("part", _part(F.col("bucket") * 32768))
        rows = self.numbered.withColumn("bucket", _bucket()).join(broadcast_if_small(chosen), ["part", "bucket"])
        return apply_filters(self._market(rows.filter(bit == 1).drop("bucket", "bits")), rest)

    def search(self, term: str) -> DataFrame:
        """The rows of `explore.search`; terms under three characters scan the rows."""
        grams = self.spark.range(1).select(trigrams(F.lit(term.upper()))).first()[0]
        if not grams:
            return search(self._market(self.numbered), term)
        lists = self.postings.filter(F.col("gram").isin(*grams)).groupBy("row_id").agg(F.count(F.lit(1)).alias("grams"))
        candidates = lists.filter(F.col("grams") == len(grams)).select("row_id", _part(F.col("row_id")).alias("part"))
        rows = self.numbered.join(broadcast_if_small(candidates), ["part", "row_id"], "left_semi")
        return search(self._market(rows), term)

    @staticmethod
    def _market(rows: DataFrame) -> DataFrame:
        return rows.drop("row_id", "part")
