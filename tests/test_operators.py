import random
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from marketlens.functions.text import parse_br_number
from marketlens.operators.aggregates import grouped_medians, histogram_json, ordered_bits, sum_money, top, with_empty
from marketlens.operators.keys import dedup_dim, duplicate_keys, keep_known, keep_known_numbers, key_bitmap, key_overlap, missing_keys, stored_keys
from marketlens.operators.ranking import global_rank, minmax, share_of_parent, weighted_score
from marketlens.plans.diagnosis import sample_rows
from marketlens.plans.explore import pivot_counts
from marketlens.plans.silver import build_silver
from marketlens.session import broadcast_if_small, durable


def test_median_matches_statistics(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *(round(rng.uniform(-1e6, 1e9), 2) for _ in range(3))]), rng.randint(0, 90)) for _ in range(4000)]
    # One group holds most of the rows, many of them copies of one value.
    rows += [("hot", 1000.0, 5)] * 5000 + [("hot", float(i), i % 7) for i in range(3000)] + [("solo", None, 3)]
    df = spark.createDataFrame(rows, "k string, x double, y long").repartition(8)
    got = {r.k: (r.x, r.y) for r in grouped_medians(df, ["k"], ["x", "y"]).collect()}
    assert len(got) == len({r[0] for r in rows})
    for key in {r[0] for r in rows}:
        xs = [x for k, x, _ in rows if k == key and x is not None]
        ys = [y for k, _, y in rows if k == key]
        assert got[key] == (statistics.median(xs) if xs else None, float(statistics.median(ys)))


def test_median_agrees_with_builtin_and_splits_a_hot_group(spark):
    df = spark.range(0, 50_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 100).alias("v"),
    )
    ours = grouped_medians(df, ["g"], ["v"])
    builtin = df.groupBy("g").agg(F.median("v").alias("b"))
    assert ours.join(builtin, "g").filter(F.abs(F.col("v") - F.col("b")) > 1e-9).isEmpty()
    assert ours.count() == builtin.count()


def test_bits_sort_like_their_doubles(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf")]
    values += [struct.unpack("d", struct.pack("q", rng.randrange(-(2**63), 2**63)))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("b")).collect()
    assert [r.v for r in sorted(rows, key=lambda r: r.b)] == sorted(values)
    assert len({r.b for r in rows}) == len(set(values))


def test_median_of_arbitrary_doubles(spark):
    """Values of all magnitudes, many of a group within one prefix, and groups of one and two rows."""
    rng = random.Random(5)
    any_double = lambda: struct.unpack("d", struct.pack("q", rng.randrange(-(2**63), 2**63)))[0]
    rows = [("any", v) for v in (any_double() for _ in range(3001)) if abs(v) < 1e300]
    rows += [("near", 1.0 + rng.random() * 1e-9) for _ in range(2000)] + [("one", -3.5)] + [("two", 1.0), ("two", 4.0)] + [("none", None)]
    rows += [("zero", 0.0), ("zero", -0.0), ("zero", -1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(8)
    got = {r.k: r.v for r in grouped_medians(df, ["k"], ["v"]).collect()}
    for key in {k for k, _ in rows}:
        own = [v for k, v in rows if k == key and v is not None]
        assert got[key] == (statistics.median(own) if own else None)


def test_keys_of_eight_digits_are_looked_up_in_a_bitmap(spark):
    names = ["00000000", "00000001", "00032767", "00032768", "99999999", "12345678", "123456789", "1234567", "A2345678", "", " 1234567"]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([*names, *names, None])], "k string, v int")
    for chosen in (names[::2], names[1::2], [], ["00032767", "A2345678"]):
        keys = spark.createDataFrame([(k,) for k in chosen], "k string")
        kept = keep_known_numbers(rows, keys, "k")
        assert kept.columns == rows.columns
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, keep_known(rows, keys, "k").collect()))
    bits = key_bitmap(spark.range(100_000).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("k")), "k")
    assert bits.count() == 4
    assert bits.agg(F.sum(F.octet_length("_bits"))).first()[0] == 4 * 4096


def test_the_bitmap_moves_no_rows(spark, tmp_path):
    """The large table is read where it lies, also with as many copies of one key as here."""
    spark.range(200_000).select(F.lpad((F.col("id") % 3000).cast("string"), 8, "0").alias("k"), "id").write.parquet(str(tmp_path / "t"))
    large = spark.read.parquet(str(tmp_path / "t"))
    keys = spark.range(0, 3000, 7).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("k"))
    kept = keep_known_numbers(large, keys, "k")
    numeric = kept._jdf.queryExecution().optimizedPlan().toString().split("Union")[1]
    assert "rightHint=(strategy=broadcast)" in numeric
    assert kept.count() == large.join(keys, "k", "left_semi").count()


def test_global_rank_equals_plain_window(spark):
    df = spark.range(0, 5000, numPartitions=7).select(F.col("id").alias("k"), (F.col("id") * 7919 % 97 / 3).alias("s"))
    ranked = global_rank(df, [F.desc_nulls_last("s"), F.asc("k")], "r")
    expected = [r.k for r in df.orderBy(F.desc("s"), "k").collect()]
    got = {r.r: r.k for r in ranked.collect()}
    assert [got[i + 1] for i in range(len(expected))] == expected


def test_global_rank_of_one_score_and_of_nothing(spark):
    df = spark.range(100).withColumn("s", F.lit(1.0))
    assert sorted(r.r for r in global_rank(df, [F.desc("s"), F.asc("id")], "r").collect()) == list(range(1, 101))
    assert global_rank(df.limit(0), [F.desc("s"), F.asc("id")], "r").collect() == []


def test_minmax_and_score(spark):
    df = spark.createDataFrame([("a", 1.0, 5), ("b", 3.0, 5), ("c", None, 5)], "k string, x double, y int")
    rows = {r.k: r for r in minmax(df, {"nx": "x", "ny": "y"}).withColumn("s", weighted_score({"nx": 0.6, "ny": 0.4})).collect()}
    assert (rows["a"].nx, rows["b"].nx, rows["c"].nx, rows["a"].ny) == (0.0, 1.0, None, None)
    assert [rows[k].s for k in "abc"] == [0.0, 60.0, 0.0]


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 6), ("b", 1, 1), (None, 1, 4)], "m string, c int, n long")
    rows = share_of_parent(df, "n", ["m"], "p").collect()
    assert {(r.m, r.c): r.p for r in rows} == {("a", 1): 0.25, ("a", 2): 0.75, ("b", 1): 1.0, (None, 1): None}


def test_key_sets(spark):
    left = spark.createDataFrame([("1",), ("1",), ("2",), ("",), (None,)], "k string")
    right = spark.createDataFrame([("1", "x"), ("1", "y"), ("3", "z"), ("", "w")], "k string, t string")
    assert sorted(r.t for r in keep_known(right, stored_keys(left, "k"), "k").collect()) == ["x", "y"]
    assert key_overlap(left, right, "k", "k", "d").first()[:] == ("d", 2, 1, 50.0)
    assert key_overlap(left.limit(0), right, "k", "k", "d").first()[:] == ("d", 0, 0, 0.0)
    assert [r.k for r in missing_keys(left.filter("k <> ''").distinct(), right, ["k"]).collect()] == ["2"]
    assert [tuple(r) for r in duplicate_keys(right, ["k"]).collect()] == [("1", 2)]


def test_dedup_takes_each_maximum_on_its_own(spark):
    df = spark.createDataFrame([("1", "a", "z"), ("1", "b", "y"), ("2", None, "q")], "k string, a string, b string")
    assert {r.k: (r.a, r.b) for r in dedup_dim(df, "k").collect()} == {"1": ("b", "z"), "2": (None, "q")}


def test_histogram_json_and_top(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), (None, 5), ("c", 1)], "k string, n long")
    assert histogram_json(df, "k", "n").first().json == '{"":5,"a":2,"b":2,"c":1}'
    assert [r.k for r in top(df, "n", ["k"], 3).collect()] == [None, "a", "b"]


def test_broadcast_only_when_small(spark):
    small, large = spark.range(5), spark.range(50)
    assert "broadcast" in broadcast_if_small(small, 100)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(large, 100)._jdf.queryExecution().logical().toString()


def test_durable_writes_to_the_configured_folder(spark):
    stored = durable(spark.range(3))
    folder = spark.conf.get("spark.checkpoint.dir")
    assert stored.count() == 3 and all(folder in f for f in stored.inputFiles())


@pytest.fixture
def small_partitions(spark):
    """No broadcasts, and a skew limit low enough for test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_splits_a_hot_company(spark, small_partitions):
    n = 60_000
    estab = spark.range(n, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 20_000).cast("string")).alias("cnpj_basico"),
        F.col("id").cast("string").alias("cnpj_ordem"),
        F.lit("00").alias("cnpj_dv"),
        F.sha2(F.col("id").cast("string"), 256).alias("nome_fantasia"),
        F.lit("02").alias("situacao_cadastral"),
        F.lit("20200101").alias("data_inicio_atividade"),
        (F.col("id") % 7).cast("string").alias("cnae_fiscal_principal"),
        F.lit("SC").alias("uf"),
        (F.col("id") % 5).cast("string").alias("municipio"),
    )
    key = F.col("id").cast("string").alias("cnpj_basico")
    emp = spark.range(20_000).select(
        key, F.lit("n").alias("razao_social"), F.lit("1").alias("natureza_juridica"), F.lit("1,00").alias("capital_social"), F.lit("01").alias("porte_empresa")
    )
    simples = spark.range(0, 20_000, 2).select(key, F.lit("S").alias("opcao_simples"), F.lit("N").alias("opcao_mei"))
    towns = spark.range(5).select(
        F.col("id").cast("string").alias("codigo_municipio_receita"), F.lit("x").alias("nome_municipio_receita"), F.lit("X").alias("municipio_norm")
    )
    cnaes = spark.range(7).select(F.col("id").cast("string").alias("cnae"), F.lit("d").alias("descricao_cnae"))
    nat = spark.sql("SELECT '1' natureza_juridica, 'n' descricao_natureza_juridica")
    ind = spark.sql("SELECT 'X' municipio_norm, '42' codigo_municipio_ibge, '10' populacao, '5' pib_per_capita")
    market = build_silver(estab, emp, towns, cnaes, nat, simples, ind, "2024-01-01")
    assert "SortMergeJoin(skew=true)" in final_plan(market)
    assert market.count() == n and market.filter("opcao_simples = 'S'").count() == estab.filter("cnpj_basico % 2 = 0").count()


def test_semi_join_splits_copies_of_a_company(spark, small_partitions):
    emp = spark.range(60_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("string").alias("cnpj_basico"), F.sha2(F.col("id").cast("string"), 256).alias("pay")
    )
    keys = stored_keys(spark.range(0, 60_000).select(F.col("id").cast("string").alias("cnpj_basico")), "cnpj_basico")
    kept = keep_known(emp, keys)
    assert "skew=true" in final_plan(kept) and kept.count() == 60_000


def test_money_neither_aborts_nor_loses(spark):
    rows = [(0.1,)] * 10 + [(1e24,), (2.0**100,), (5.123456,), (None,)]
    df = spark.createDataFrame(rows, "x double")
    assert df.agg(sum_money("x").alias("s")).first().s == 2.0**100 + 1e24 + 6.123456
    assert df.filter("x < 10").agg(sum_money("x").alias("s")).first().s == 6.123456
    assert df.filter("x is null").agg(sum_money("x").alias("s")).first().s == 0.0


def test_amounts_beyond_a_double_are_refused(spark):
    df = spark.createDataFrame([("1e999",), ("-1e999",), ("1,5",), ("x",)], "t string")
    assert [r[0] for r in df.select(parse_br_number("t")).collect()] == [None, None, 1.5, None]


def test_sources_without_rows_count_zero(spark):
    counts = spark.createDataFrame([("a", 3), ("c", 1)], "source string, n long")
    names = spark.createDataFrame([("a",), ("b",)], "source string")
    assert {r.source: r.n for r in with_empty(counts, names).collect()} == {"a": 3, "b": 0, "c": 1}


def test_pivot_has_a_column_for_every_value_that_occurs(spark):
    df = spark.createDataFrame([("r", "never seen before", 2), ("r", "other", 1), ("s", "other", 5)], "m string, d string, n long")
    got = {r.m: r.asDict() for r in pivot_counts(df, "m", "d", "n").collect()}
    assert got["r"]["never seen before"] == 2 and got["s"] == {"m": "s", "never seen before": 0, "other": 5}


def test_histogram_beyond_its_bound_adds_the_others_up(spark):
    import json

    rows = [("a", 5), ("b", 9), (None, 2), ("", 4), ("outros", 7), ("c", 1), ("d", 1)]
    df = spark.createDataFrame(rows, "k string, n long")
    whole = histogram_json(df, "k", "n").first().json
    assert list(json.loads(whole).items()) == [("b", 9), ("outros", 7), ("", 6), ("a", 5), ("c", 1), ("d", 1)]
    assert json.loads(histogram_json(df, "k", "n", most=3).first().json) == {"b": 9, "": 6, "outros": 14}
    assert list(json.loads(histogram_json(df, "k", "n", most=2).first().json).items()) == [("b", 9), ("outros", 20)]
    assert histogram_json(df.limit(0), "k", "n").first().json == "{}"


@pytest.mark.parametrize("n", [1, 3, 4, 9])
def test_first_rows_are_those_of_a_sort(spark, n):
    rows = [("b", 2), ("a", 1), (None, 5), ("b", 1), ("c", 0), ("a", 1), (None, 4), ("b", 3)]
    df = spark.createDataFrame(rows, "k string, m int")
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))[:n]
    assert [tuple(r) for r in sample_rows(df, ("k", "m"), n).collect()] == want
    assert sample_rows(df.limit(0), ("k", "m"), n).collect() == []
