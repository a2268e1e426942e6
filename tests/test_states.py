"""Gold tables rolled up from partial states, against those made from the rows."""

import pytest
from pyspark.sql import functions as F

from marketlens.operators.states import STATES
from marketlens.plans import gold


@pytest.fixture(scope="module")
def market(spark, tmp_path_factory):
    """Null keys and values, amounts no decimal holds, a municipality with two thirds of the rows."""
    n = F.col("id")
    rows = spark.range(4000).select(
        F.lit("SC").alias("uf"),
        F.when(n % 3 != 0, "HOT").when(n % 6 != 0, F.concat(F.lit("M"), (n % 15).cast("string"))).alias("municipio"),
        F.when(n % 40 != 0, (n % 7).cast("string")).alias("cnae_principal"),
        F.when(n % 2 == 0, F.concat(F.lit("d"), (n % 7).cast("string"))).alias("descricao_cnae"),
        F.when(n % 500 == 1, F.lit(2e20)).when(n % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(900)) / 4).alias("capital_social"),
        F.when(n % 13 != 0, (n % 41).cast("int")).alias("idade_empresa_anos"),
        F.when(n % 5 != 0, (n % 9).cast("double")).alias("populacao"),
        F.when(n % 8 != 0, (n % 9) * 0.5).alias("pib_per_capita"),
    )
    path = str(tmp_path_factory.mktemp("market") / "rows")
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("make", [gold.municipio_cnae, gold.ranking_municipios, gold.ranking_cnaes])
def test_rolled_up_tables_are_those_of_the_rows(market, make):
    states = gold.market_states(market)
    rolled = make(states, of=STATES)
    assert not set(rolled.inputFiles()) & set(market.inputFiles()), "the market table is read once, for the states"
    assert rolled.schema == make(market).schema
    assert sorted(map(repr, rolled.collect())) == sorted(map(repr, make(market).collect()))


def test_states_merge_rows_before_the_shuffle(market):
    states = gold.market_states(market)
    assert states.agg(F.sum("n")).first()[0] == 4000
    again = market.unionByName(market)
    assert gold.market_states(again).count() == states.count()


def test_no_rows_no_states(market):
    states = gold.market_states(market.limit(0))
    assert states.count() == 0
    assert gold.municipio_cnae(states, of=STATES).count() == 0 and gold.ranking_cnaes(states, of=STATES).count() == 0
