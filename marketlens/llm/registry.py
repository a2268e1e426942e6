"""The operators' queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from marketlens.llm import bpe, exact_dedup, html_text, merkle, mixing, neighbours, pieces, pii, quality_score, simhash, suffix_dedup, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


ORACLES["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(folded) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded FROM documents)
WINDOW same AS (PARTITION BY folded)
"""


@query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op2_neighbours"] = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pairs)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_score.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(table(spark, sf_dir, "documents"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_strings(pii.spans(table(spark, sf_dir, "documents")))


@query
def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.verified(docs, merkle.FIELDS, tampered=merkle.tampered_fifth(docs["doc_id"]))


_DIGEST = "sha256(concat({}))".format(", ".join(f"coalesce(strlen({{{f}}}::VARCHAR) || ':' || {{{f}}}::VARCHAR, '-')" for f in merkle.FIELDS))
_LEAF = _DIGEST.format(**{f: f for f in merkle.FIELDS})
_TAMPERED = _DIGEST.format(**{f: f for f in merkle.FIELDS} | {"text": f"translate(text, '{merkle.UPPER}', '{merkle.UPPER.lower()}')"})
# CRC-32 of the digits of an id, bit by bit
_CRC = """(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)), lambda a, i: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295))"""
_SIBLINGS = """coalesce(string_agg(digest, '') OVER (PARTITION BY {key}level, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
       coalesce(string_agg(digest, '') OVER (PARTITION BY {key}level, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b"""
ORACLES["op12_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('s' || source, 'n') AS tree, {_LEAF} AS leaf, CASE WHEN {_CRC} % 5 = 0 THEN {_TAMPERED} END AS other FROM documents),
trees AS (
  SELECT tree, 0 AS level, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n, rid FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 15) // 16), NULL FROM trees WHERE n > 1 GROUP BY tree, level, idx // 16),
subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree COLLATE "binary") - 1 AS idx, count(*) OVER () AS n FROM trees WHERE n = 1),
upper AS (
  SELECT 0 AS level, idx, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 15) // 16) FROM upper WHERE n > 1 GROUP BY level, idx // 16),
beside AS (SELECT tree, level, idx, {_SIBLINGS.format(key="tree, ")} FROM trees WHERE n > 1),
over AS (SELECT level, idx, {_SIBLINGS.format(key="")} FROM upper WHERE n > 1),
climb AS (
  SELECT t.rid, t.tree, 0 AS level, t.idx, coalesce(l.other, l.leaf) AS acc, '' AS proof FROM trees t JOIN leaves l ON t.rid = l.rid
  UNION ALL
  SELECT c.rid, c.tree, c.level + 1, c.idx // 16, sha256(b.a || c.acc || b.b), c.proof || b.a || b.b
  FROM climb c JOIN beside b ON b.tree = c.tree AND b.level = c.level AND b.idx = c.idx),
rise AS (
  SELECT c.rid, 0 AS level, s.idx, c.acc, c.proof FROM climb c JOIN subroots s ON s.tree = c.tree
  WHERE c.level = (SELECT max(level) FROM trees t WHERE t.tree = c.tree)
  UNION ALL
  SELECT r.rid, r.level + 1, r.idx // 16, sha256(o.a || r.acc || o.b), r.proof || o.a || o.b
  FROM rise r JOIN over o ON o.level = r.level AND o.idx = r.idx),
root AS (SELECT digest FROM upper WHERE n = 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root.digest AS root, sha256(r.proof) AS proof_sha256, r.acc AS folded_root, r.acc = root.digest AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN rise r ON r.rid = l.rid, root WHERE r.level = (SELECT max(level) FROM upper)
"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
