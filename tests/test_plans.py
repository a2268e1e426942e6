"""Shapes the physical plans must keep."""

import os

import pytest

from marketlens.registry import queries
from marketlens.session import broadcast_if_small, durable, expected_bytes, release, written
from marketlens.tpch_views import forget_views

SF = "/root/testdata/sf0.01"


def plan_of(spark, key):
    return queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "key",
    "silver_market join_dims municipio_cnae ranking_cnaes semi_empresas semi_simples duplicate_keys facet_values "
    "explore_filter search_text indicator_merge dim_dedup status_hist diag_match normalize_text scan_invisible".split(),
)
def test_no_rows_meet_in_one_task(spark, key):
    """Outside the aggregates of whole tables, which send one row per task."""
    plan = plan_of(spark, key)
    for i, line in enumerate(lines := plan.splitlines()):
        if "SinglePartition" in line:
            below = next(x for x in lines[i + 1 :] if x.strip(" +-:*|"))
            assert "HashAggregate(keys=[]" in below or "SortAggregate(keys=[]" in below, below


def test_scans_are_pruned_and_filtered(spark):
    plan = plan_of(spark, "explore_filter")
    assert "In(porte_empresa, [Demais,Microempresa])" in plan
    assert "razao_social" not in plan
    status = plan_of(spark, "status_hist")
    assert "l_extendedprice" not in status and "l_shipdate" not in status


@pytest.mark.parametrize("key", ["normalize_text", "clean_cell", "fmt_br_money", "silver_market", "search_text"])
def test_no_python_in_queries(spark, key):
    assert "Python" not in plan_of(spark, key) and "MapInArrow" not in plan_of(spark, key)


@pytest.mark.parametrize("key", ["silver_market", "join_dims"])
def test_the_market_plan_is_described_with_one_write_at_most(spark, key):
    forget_views()
    before = written()
    plan_of(spark, key)
    assert written() - before <= 1
    release(spark, before)
    forget_views()


def test_parts_are_scanned_once_each(spark):
    assert plan_of(spark, "union_parts").count("FileScan parquet") == 2


def test_stored_tables_go_with_release(spark):
    before = written()
    path = durable(spark.range(3)).inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(path)
    release(spark, before)
    assert not os.path.exists(path) and written() == before


def test_sizes_decide_on_broadcasts_without_a_job(spark):
    small = spark.read.parquet(f"{SF}/nation.parquet")
    assert broadcast_if_small(small) is not small and broadcast_if_small(small, 1) is small
    unknown = small.mapInArrow(lambda batches: batches, small.schema)
    assert expected_bytes(small) < 10_000 and expected_bytes(unknown) >= expected_bytes(small)
