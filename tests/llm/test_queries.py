"""The registered queries: against their SQL, or against brute force over the same table."""

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from marketlens.llm import registry  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_a_query_per_operator_and_the_pipeline():
    names = [*registry.QUERIES]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
    assert set(registry.ORACLES) <= set(names)


@pytest.mark.parametrize("key", sorted(registry.ORACLES))
def test_matches_sql(spark, duck, key):
    df = registry.QUERIES[key](spark, SF)
    names = sorted(df.columns)
    cursor = duck.execute(registry.ORACLES[key])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    theirs = sorted(repr(tuple(r[columns.index(n)] for n in names)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == theirs and theirs


def test_op3_against_brute_force(spark):
    from test_suffix_dedup import expected

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(map(repr, map(tuple, registry.QUERIES["op3_suffix_dedup"](spark, SF).collect())))
    assert got == sorted(map(repr, expected([(r.doc_id, r.text) for r in docs], 100).elements()))


def test_op8_against_brute_force(spark):
    from test_simhash import plain_components

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(map(repr, map(tuple, registry.QUERIES["op8_simhash"](spark, SF).collect())))
    assert got == sorted(map(repr, plain_components([(r.doc_id, r.text) for r in docs]).elements()))


def test_stages_one_by_one_and_in_a_row(spark, tmp_path):
    """Every stage works on all that the one before kept; the last one's rows are run()'s."""
    from test_exact_dedup import folded
    from test_mixing import plain_size
    from test_simhash import representatives

    from marketlens.llm import mixing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        rows, kept = before.collect(), after.collect()
        if k < 4:
            assert after.columns == columns and kept
        if name == "exact dedup":
            best = {}
            for r in rows:
                best[folded(r.text)] = max(r.doc_id, best.get(folded(r.text), r.doc_id))
            assert sorted(r.doc_id for r in kept) == sorted(best.values())
        elif name == "SimHash near-dedup":
            assert Counter((r.doc_id, r.text) for r in kept) == representatives([(r.doc_id, r.text) for r in rows])
        elif name == "mixing":
            takes = {r.doc_id: r.taken for r in mixing.mix(before).collect()}
            assert len(kept) == sum(int(takes[r.doc_id] / plain_size(r.text) + 0.5) if plain_size(r.text) else 1 for r in rows)
        elif name == "byte-level BPE":
            assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in rows)
        before = after
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, before.collect()))


@pytest.mark.parametrize("some", [True, False])
def test_the_pipeline_on_odd_rows_and_on_none(spark, tmp_path, some):
    """Clashing columns, nulls, repeats, very long texts; nothing stays behind but the result."""
    import os

    from cases import frame, odd_rows

    from marketlens.session import checkpoint_folder, release, written

    rows = odd_rows() if some else []
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(4, 0, 1), *[(k, 1, 0) for k in range(20, 36)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left, before = {*os.listdir(checkpoint_folder(spark))}, written()
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len({*os.listdir(checkpoint_folder(spark))} - left) == 1 and written() == before + 1
    release(spark, before)
    assert {*os.listdir(checkpoint_folder(spark))} == left
    assert bool(got) == some and {r.doc_id for r in got} <= {d for d, _ in rows}
    if some:
        assert {r.n_tokens for r in got if r.doc_id == 3} <= {0} and len({r.ids_sha256 for r in got}) > 5
