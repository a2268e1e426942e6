"""Versioned tables and tables that lie by key."""

import os

import pytest
from pyspark.sql import functions as F

from marketlens.registry import queries
from marketlens.session import durable, release, written
from marketlens.sources import tables as T
from marketlens.sources.tables import Superseded, Tables


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_all_new_versions_or_none(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert tables.entries() == {}
    with tables.replacing() as new:
        new.write(spark.range(3), "a")
        new.write(spark.range(5), "b")
        assert tables.entries() == {}  # not before the end
    with pytest.raises(ZeroDivisionError), tables.replacing() as new:
        assert new.write(spark.range(7), "a").count() == 7
        raise ZeroDivisionError
    assert tables.read("a").count() == 3 and len(os.listdir(tmp_path / "tables/a")) == 1
    with tables.replacing() as new:
        new.write(spark.range(9), "a")
    assert tables.read("a").count() == 9 and tables.read("b").count() == 5


def test_a_job_that_dies_leaves_the_old_tables(spark, tmp_path):
    """It has written files, and perhaps half of a manifest."""
    tables = Tables(spark, str(tmp_path))
    with tables.replacing() as new:
        new.write(spark.range(3), "a")
    spark.range(8).write.parquet(tables.version_path("a"))
    (tmp_path / "manifests/000000000002.json").write_text('{"tables": {"a": {"path": "')
    assert tables.read("a").count() == 3
    with tables.replacing() as new:
        new.write(spark.range(4), "a")
    assert tables.read("a").count() == 4 and tables.vacuum() == 2
    assert tables.read("a").count() == 4 and len(os.listdir(tmp_path / "tables/a")) == 1


def test_a_reader_keeps_its_version_while_tables_are_replaced(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    with tables.replacing() as new:
        new.write(spark.range(3), "a")
    old = tables.read("a")
    with tables.replacing() as new:
        new.write(old.filter("id > 0"), "a")  # a table can be made from its old version
    assert old.count() == 3 and tables.read("a").count() == 2


def test_of_two_writers_the_later_fails(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    with pytest.raises(Superseded), tables.replacing() as slow:
        slow.write(spark.range(1), "a")
        with Tables(spark, str(tmp_path)).replacing() as quick:
            quick.write(spark.range(2), "a")
    assert tables.read("a").count() == 2


def test_another_session_finds_the_tables_by_name(spark, tmp_path):
    with Tables(spark, str(tmp_path)).replacing() as new:
        new.write(spark.range(3), "found_again")
        new.write_by_key({"by_key_again": spark.range(50).withColumn("k", F.col("id") % 7)}, "k", 4)
    other = spark.newSession()
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("marketlens_")]:
        spark.sql(f"DROP TABLE {name}")  # a new application's catalogue is empty; the files stay
    assert Tables(other, str(tmp_path)).register() == ["by_key_again", "found_again"]
    assert other.sql("SELECT count(*) FROM found_again").first()[0] == 3
    assert other.sql("SELECT count(DISTINCT k) FROM by_key_again").first()[0] == 7
    assert "found_again" not in {t.name for t in spark.catalog.listTables()}


def joined_plan(left, right):
    return left.join(right, "k")._jdf.queryExecution().executedPlan().toString()


def test_tables_by_key_join_without_a_shuffle(spark, tmp_path, monkeypatch):
    left = spark.range(20_000).select((F.col("id") % 5000).cast("string").alias("k"), F.col("id").alias("a"))
    right = spark.range(6000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("b"))
    with Tables(spark, str(tmp_path)).replacing() as new:
        parts = new.write_by_key({"left": left, "right": right}, "k", 6)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in joined_plan(parts["left"], parts["right"])
        assert "Exchange" in joined_plan(left, right)
        assert rows_of(parts["left"].join(parts["right"], "k")) == rows_of(left.join(right, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len([f for f in os.listdir(Tables(spark, str(tmp_path)).entries()["left"].path) if f.startswith("part")]) == 6


def test_a_hot_key_is_not_laid_into_one_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "SMALL_BUCKET", 100)
    hot = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    even = spark.range(9000).select(F.col("id").alias("k"))
    assert T.lies_evenly(even, "k", 16) and not T.lies_evenly(hot, "k", 16)
    with Tables(spark, str(tmp_path)).replacing() as new:
        parts = new.write_by_key({"hot": hot, "even": even}, "k", 16)
    assert {e.key for e in Tables(spark, str(tmp_path)).entries().values()} == {None}
    assert parts["hot"].count() == parts["even"].count() == 9000
    assert T.lies_evenly(hot.limit(0), "k", 16)


def test_the_market_joins_companies_without_a_shuffle(spark):
    """Establishments and companies lie by key: no exchange of either for their join."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries()["silver_by_key"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "hashpartitioning(cnpj_basico" not in plan and "SortMergeJoin [cnpj_basico" in plan


def test_a_thread_deletes_only_what_it_stored(spark):
    from threading import Thread

    before = written()
    mine = durable(spark.range(3))
    other = Thread(target=lambda: (durable(spark.range(4)), release(spark)))
    other.start()
    other.join()
    assert mine.count() == 3 and written() == before + 1
    release(spark, before)
    assert written() == before
