"""Gold marts."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tillroll.operators import marts

ENRICHED = ("order_id string, order_item_id int, order_date date, order_status string, "
            "customer_state string, customer_city string, seller_state string, seller_city string, "
            "product_id string, product_category_name_en string, price double, freight_value double, "
            "payment_value_total double, payment_type_primary string, review_score int, is_delayed int")


def row(oid, item, day, status, state, cat, price, review, delayed):
    return (oid, item, day, status, state, "city", "SP", "sp", "p", cat, price, 1.0, 99.0, "card",
            review, delayed)


@pytest.fixture()
def enriched(spark):
    d1, d2 = date(2017, 1, 1), date(2017, 1, 2)
    return spark.createDataFrame([
        row("o1", 1, d1, "delivered", "SP", "toys", 0.1, 5, 1),
        row("o1", 2, d1, "delivered", "SP", "toys", 0.2, 4, 1),
        row("o2", 1, d1, "shipped", "RJ", "books", 10.0, None, None),
        row("o3", 1, d2, "delivered", "RJ", "books", 3.0, 1, 0),
        row("o4", 1, None, None, None, "unknown", 2.0, None, None),
    ], ENRICHED)


def test_daily_sales(enriched):
    got = {r["order_date"]: r for r in marts.mart_daily_sales(enriched).collect()}
    d1 = got[date(2017, 1, 1)]
    assert d1["orders"] == 2 and d1["gmv"] == 10.3 and d1["freight_total"] == 3.0
    assert d1["avg_review_score"] == 4.5          # item-weighted, NULL skipped
    assert d1["delay_rate"] == 1.0                # undelivered excluded, not on time
    assert got[None]["orders"] == 1 and got[None]["delay_rate"] is None


def test_daily_sort_nulls_first(enriched):
    days = [r["order_date"] for r in marts.mart_daily_sales(enriched).collect()]
    assert days == [None, date(2017, 1, 1), date(2017, 1, 2)]


def test_state_sorted_by_gmv_desc(enriched):
    rows = marts.mart_state_performance(enriched).collect()
    assert [r["customer_state"] for r in rows] == ["RJ", None, "SP"]
    assert rows[0]["orders"] == 2 and rows[0]["gmv"] == 13.0 and rows[0]["avg_review_score"] == 1.0


def test_category(enriched):
    got = {r["product_category_name_en"]: r for r in marts.mart_category_performance(enriched).collect()}
    assert got["toys"]["gmv"] == 0.3 and got["toys"]["orders"] == 1
    assert [r["product_category_name_en"] for r in marts.mart_category_performance(enriched).collect()][0] == "books"


def test_status_daily_two_key_sort(enriched):
    rows = marts.mart_order_status_daily(enriched).collect()
    assert [(r["order_date"], r["order_status"]) for r in rows] == [
        (None, None), (date(2017, 1, 1), "delivered"), (date(2017, 1, 1), "shipped"),
        (date(2017, 1, 2), "delivered")]
    assert rows[1]["order_cnt"] == 1 and rows[1]["delay_rate"] == 1.0


def test_gmv_equal_over_all_marts(enriched):
    totals = [m(enriched).agg(F.sum("gmv")).collect()[0][0] for m in (
        marts.mart_daily_sales, marts.mart_state_performance, marts.mart_category_performance,
        marts.mart_order_status_daily)]
    assert all(t == pytest.approx(15.3) for t in totals)


def test_half_up_rounding(spark):
    df = spark.createDataFrame([("o1", 1, date(2017, 1, 1), 1), ("o1", 2, date(2017, 1, 1), 1),
                                ("o1", 3, date(2017, 1, 1), 1), ("o1", 4, date(2017, 1, 1), 0)] * 1,
                               "order_id string, order_item_id int, order_date date, is_delayed int")
    df = df.withColumns({"price": F.lit(1.005), "freight_value": F.lit(0.0), "review_score": F.lit(None).cast("int")})
    r = marts.mart_daily_sales(df).collect()[0]
    assert r["delay_rate"] == 0.75 and r["gmv"] == 4.02


def test_money_rounded_once_after_the_sum(spark):
    df = spark.createDataFrame([("o1", i, date(2017, 1, 1), 0.335) for i in range(3)],
                               "order_id string, order_item_id int, order_date date, price double")
    df = df.withColumns({"freight_value": F.lit(0.0), "review_score": F.lit(None).cast("int"),
                         "is_delayed": F.lit(None).cast("int")})
    assert marts.mart_daily_sales(df).collect()[0]["gmv"] == 1.01  # not 3 x 0.34


def test_analytics_columns(enriched):
    out = marts.mart_order_analytics(enriched)
    assert out.columns == marts.ANALYTICS_COLUMNS + ["etl_loaded_at"]
    assert out.select("etl_loaded_at").distinct().count() == 1
    assert marts.mart_order_analytics(enriched, with_load_time=False).columns == marts.ANALYTICS_COLUMNS


def test_enrichment_joins_keep_rows(spark):
    fact = spark.createDataFrame([("o1", "c1", "p1", "s1"), ("o2", "cX", "pX", "sX")],
                                 "order_id string, customer_id string, product_id string, seller_id string")
    c = spark.createDataFrame([("c1", "SP", "sp")], "customer_id string, customer_state string, customer_city string")
    p = spark.createDataFrame([("p1", "toys")], "product_id string, product_category_name_en string")
    s = spark.createDataFrame([("s1", "rio", "RJ")], "seller_id string, seller_city string, seller_state string")
    rows = {r["order_id"]: r for r in marts.fct_enriched(fact, c, p, s).collect()}
    assert len(rows) == 2 and rows["o1"]["customer_state"] == "SP" and rows["o2"]["seller_state"] is None
