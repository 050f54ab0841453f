"""End to end: land driver-derived CSVs, run bronze -> gold into a fresh
folder, and compare the written marts with the lazy queries."""

from collections import Counter

import pytest

from tillroll.paths import LayerPaths
from tillroll.plans import pipeline
from tillroll.plans.queries import all_queries
from tillroll.schemas import build_schema
from tillroll.sources.driver_tables import DriverTables
from tillroll.sources.landing import land_tables


@pytest.fixture(scope="module")
def built(spark, smoke_dir, tmp_path_factory):
    paths = LayerPaths.under(str(tmp_path_factory.mktemp("warehouse")))
    land_tables(DriverTables(spark, smoke_dir).bronze(), paths)
    report = pipeline.run_pipeline(spark, paths)
    return paths, report


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_report(built):
    _, report = built
    assert len(report["bronze"]) == 9
    assert report["gate"] == {"valid": 1475, "quarantined": 55}
    assert report["gold"][0] == "mart_order_analytics"


@pytest.mark.parametrize("name", ["mart_daily_sales", "mart_state_performance",
                                  "mart_category_performance", "mart_order_status_daily"])
def test_gold_mart_equals_query(spark, smoke_dir, built, name):
    paths, _ = built
    written = spark.read.parquet(paths.gold(name))
    query = all_queries()[name](spark, smoke_dir)
    assert written.columns == query.columns
    assert rows(written) == rows(query)


def test_silver_fact_and_gate(spark, smoke_dir, built):
    paths, _ = built
    q = all_queries()
    assert rows(spark.read.parquet(paths.silver("fct_order_items"))) == rows(q["fct_order_items"](spark, smoke_dir))
    valid = pipeline.stg_orders(spark, paths)
    assert valid.columns == q["dq_gate_valid"](spark, smoke_dir).columns
    assert rows(valid) == rows(q["dq_gate_valid"](spark, smoke_dir))
    quarantine = pipeline.stg_orders_quarantine(spark, paths)
    assert rows(quarantine) == rows(q["dq_gate_quarantine"](spark, smoke_dir))


@pytest.mark.parametrize("rows_in, valid, bad", [
    ([], 0, 0), ([("o", "c", "d", "2021-01-01 00:00:00")], 1, 0), ([("o", None, "d", "2021-01-01 00:00:00")], 0, 1)])
def test_gate_of_empty_all_valid_and_all_bad(spark, tmp_path, rows_in, valid, bad):
    paths = LayerPaths.under(str(tmp_path))
    full = [(*r, None, None, None, None) for r in rows_in]
    spark.createDataFrame(full, build_schema("orders")).write.parquet(paths.bronze("orders"))
    assert pipeline.orders_gate(spark, paths) == {"valid": valid, "quarantined": bad}
    assert pipeline.stg_orders(spark, paths).count() == valid
    assert pipeline.stg_orders_quarantine(spark, paths).count() == bad
