"""Registered queries on the smallest driver scale: each one against its
DuckDB oracle, the entry point, determinism, and the survey's invariants."""

import datetime as dt
import decimal
import math
from collections import Counter

import pytest

import __spark_entry__ as entry_mod
from tillroll.plans.oracle import oracle_sql
from tillroll.plans.queries import Model, model

TABLES = "region nation customer supplier part orders lineitem events".split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return None if v is None else str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(smoke_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    return con


def test_registry_and_oracle_keys():
    from tillroll.plans.queries import all_queries
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(qs)
    own, own_sql = all_queries(), oracle_sql()
    assert set(own) <= set(qs) and set(own_sql) <= set(sql)
    assert len(own) >= 30
    assert set(own) == set(own_sql)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, smoke_dir, duck, name):
    df = entry_mod.queries()[name](spark, smoke_dir)
    res = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, df.collect()) == canon(ocols, res.fetchall())


def test_entry_flagship(spark, smoke_dir):
    df = entry_mod.entry(spark)
    assert df.columns == ["order_date", "orders", "gmv", "freight_total", "avg_review_score", "delay_rate"]
    assert df.count() > 0


def test_fixture_counts(spark, smoke_dir):
    """Smoke assertions on the adapter (FIXTURES.md section 5, sf0.001)."""
    m = model(spark, smoke_dir)
    assert m.t.table("orders").count() == 1530
    assert m.fact().count() == 4599


@pytest.mark.parametrize("n", [1, 7, 32])
def test_deterministic_under_repartitioning(spark, smoke_dir, n):
    from tillroll.operators import dims, facts, marts, quality
    t = Model(spark, smoke_dir).t
    def parts(name):
        return t.table(name).repartition(n)
    fact = facts.fct_order_items(parts("order_items"), quality.valid_orders(parts("orders")),
                                 parts("order_payments"), parts("order_reviews"))
    enriched = marts.fct_enriched(fact, dims.dim_customers(parts("customers")),
                                  dims.dim_products(parts("products"), parts("category_translation")),
                                  dims.dim_sellers(parts("sellers")))
    base = model(spark, smoke_dir)
    for got, want in ((fact, base.fact()),
                      (marts.mart_daily_sales(enriched), marts.mart_daily_sales(base.enriched())),
                      (marts.mart_state_performance(enriched), marts.mart_state_performance(base.enriched()))):
        assert canon(got.columns, got.collect()) == canon(want.columns, want.collect())


def test_invariants(spark, smoke_dir):
    from pyspark.sql import functions as F
    from tillroll.operators import marts, quality
    m = model(spark, smoke_dir)
    orders = m.t.table("orders")
    valid, bad = quality.split_orders(orders)
    assert valid.count() + bad.count() == orders.count()
    fact = m.fact()
    assert fact.count() == fact.select("order_id", "order_item_id").distinct().count()
    enriched = m.enriched()
    assert enriched.count() == fact.count()
    sums = [mart(enriched).agg(F.sum("gmv")).collect()[0][0] for mart in (
        marts.mart_daily_sales, marts.mart_state_performance, marts.mart_category_performance,
        marts.mart_order_status_daily)]
    assert max(sums) - min(sums) < 1e-6 * max(sums)
