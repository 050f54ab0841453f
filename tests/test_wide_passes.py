"""Passes of wide rows: the fact deals its items once and a customer joins
the orders."""

import re

import pytest
from pyspark.sql import functions as F

from tillroll.operators import facts, marts
from tillroll.plans.queries import Model, all_queries

from test_refresh import rows


def exchanged(df) -> list[str]:
    """Columns of the rows below each exchange, as the plan lists them."""
    df._jdf.queryExecution().executedPlan()
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\) Exchange\nInput[^\n]*: \[(.*?)\]\nArguments: hashpartitioning\(([^\n]*?), \d+\)", text)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_items_are_dealt_once_and_customers_join_orders(spark, smoke_dir, no_broadcast):
    df = all_queries()["mart_order_analytics"](spark, smoke_dir)
    found = exchanged(df)
    by_customer = [cols for cols, by in found if "customer_id" in by or "_key" in by and "customer_id" in cols]
    assert by_customer and not any("price" in cols or "_first" in cols for cols in by_customer)
    # Whole items are dealt for the orders kept apart, for products and for sellers.
    assert sum("price" in cols for cols, by in found if "_key" in by) == 3


@pytest.mark.parametrize("hot", [0, 3, 10**6])
def test_hot_orders_apart_give_the_same_fact(spark, smoke_dir, hot):
    m = Model(spark, smoke_dir)
    items = m.bronze("order_items").limit(3000)
    items = items.unionByName(items.limit(500).withColumn("order_id", F.lit("32"))).unionByName(
        items.limit(200).withColumn("order_id", F.lit(None).cast("string"))).localCheckpoint()
    sides = m.orders_valid(), m.bronze("order_payments"), m.bronze("order_reviews")
    got = facts.fct_order_items(items, *sides, hot=hot)
    plain = facts.dedupe_items(items).join(facts.order_attributes(*sides), "order_id", "left")
    plain = (plain.withColumn("order_date", F.to_date("order_purchase_ts"))
                  .withColumn("is_delayed", facts.delay_flag("order_delivered_customer_ts", "order_estimated_delivery_ts"))
                  .select(got.columns))
    assert rows(got) == rows(plain)


def test_customers_joined_to_orders_give_the_same_rows(spark, smoke_dir):
    m = Model(spark, smoke_dir)
    late = marts.fct_enriched(m.fact(), m.dim_customers(), m.dim_products(), m.dim_sellers())
    assert m.enriched().columns == late.columns
    assert rows(m.enriched()) == rows(late)
