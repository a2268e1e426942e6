"""Documents to token counts: toxic ones out, copies out, sources mixed, texts encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again
for the next one. All but the last return the columns of `documents`.

Cases: null texts count as empty. An empty text is scored like any other; all empty ones are copies of
one another, so one of them (the largest id, one of a null id if there is no other) reaches the end,
where it has no tokens. Rows that repeat an id are documents of their own. Of ties the stages keep what
their modules say: of copies the largest id, of near copies the smallest. A null source is a source. The
mix repeats documents, or leaves them out, in whole; columns beyond those of `documents` are kept up
to the last stage. No rows give none."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import bpe, exact_dedup, mixing, simhash, toxicity
from marketlens.session import discard, release, scratch_path, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, the document with the smallest doc_id."""
    return simhash.keep_representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]
#: SQL has neither the classifier nor the token merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the whole of `documents`. What a stage stored for itself,
    and the result of the one before, are deleted once its result is written; `release` deletes the
    last one."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        path = scratch_path(spark)
        before = written()
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        release(spark, before)
        docs = spark.read.schema(result.schema).parquet(path)
        if last is not None:
            discard(spark, last)
        last = path
    return docs
