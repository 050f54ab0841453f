"""Dimensions, order aggregates and the fact."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, TimestampNTZType

from tillroll.functions import delay_flag, exact_mean, money_sum, parse_ts
from tillroll.operators import dims, facts

DELIVERY = "order_id string, d timestamp_ntz, e timestamp_ntz"


def delayed(spark, rows):
    df = spark.createDataFrame(rows, DELIVERY)
    return df.withColumn("is_delayed", delay_flag("d", "e"))


DAY = datetime(2022, 5, 10)


def test_delay_flag_over_offsets(spark):
    """Delivered 36 h before to 36 h after the estimate, in steps of 12 h."""
    hours = range(-36, 37, 12)
    rows = [(str(h), DAY + timedelta(hours=h), DAY) for h in hours]
    df = delayed(spark, rows)
    assert {r["order_id"]: r["is_delayed"] for r in df.collect()} == {str(h): int(h > 0) for h in hours}
    assert df.schema["is_delayed"].dataType == IntegerType()


@pytest.mark.parametrize("delivered, estimated, flag", [
    (None, None, None), (None, DAY, None), (DAY, None, 0)])     # M5: no estimate is on time
def test_delay_flag_without_times(spark, delivered, estimated, flag):
    assert delayed(spark, [("x", delivered, estimated)]).first()["is_delayed"] == flag


PRODUCTS = ("product_id string, product_category_name string, product_name_length int, "
            "product_description_length int, product_photos_qty int, product_weight_g double, "
            "product_length_cm double, product_height_cm double, product_width_cm double")
TRANSLATION = "product_category_name string, product_category_name_english string"


def prod(pid, cat):
    return (pid, cat, 10, 100, 1, 1.0, 1.0, 1.0, 1.0)


def english(spark, products, translations, **kw):
    """(product, category, English name) rows of the built dimension."""
    d = dims.dim_products(spark.createDataFrame([prod(*p) for p in products], PRODUCTS),
                          spark.createDataFrame(translations, TRANSLATION), **kw)
    return sorted(tuple(r) for r in d.select(
        "product_id", F.coalesce("product_category_name", F.lit("-")), "product_category_name_en").collect())


def test_product_names_and_fallbacks(spark):
    """Translated, untranslated and missing categories; a NULL translation row
    matches nothing (M11); of two versions the lower category stays."""
    got = english(spark, [("a", "lamp"), ("b", "rug"), ("c", None), ("d", "rug"), ("d", "lamp"), ("a", "lamp")],
                  [("lamp", "light"), (None, "never")])
    assert got == [("a", "lamp", "light"), ("b", "rug", "unknown"), ("c", "-", "unknown"), ("d", "lamp", "light")]


def test_repeated_translations(spark):
    twice = [("lamp", "light"), ("lamp", "glow")]
    assert english(spark, [("a", "lamp")], twice) == [("a", "lamp", "glow")]
    assert len(english(spark, [("a", "lamp")], twice, dedupe_translation=False)) == 2


class TestPeopleAndPlaces:
    def test_customers_city_normalised_and_deduped(self, spark):
        df = spark.createDataFrame(
            [("c1", "u1", "01000", "  São PAULO ", "SP"), ("c1", "u1", "01000", "  São PAULO ", "SP")],
            "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
            "customer_city string, customer_state string")
        rows = dims.dim_customers(df).collect()
        assert len(rows) == 1 and rows[0]["customer_city"] == "são paulo"
        assert dims.dim_customers(df).columns == ["customer_id", "customer_unique_id", "customer_city",
                                                  "customer_state", "customer_zip_code_prefix"]

    def test_trim_keeps_tabs(self, spark):
        df = spark.createDataFrame([("s1", "01000", "\tRio ", "RJ")],
                                   "seller_id string, seller_zip_code_prefix string, seller_city string, "
                                   "seller_state string")
        assert dims.dim_sellers(df).collect()[0]["seller_city"] == "\trio"

    def test_geolocation_centroid_per_three_keys(self, spark):
        df = spark.createDataFrame(
            [("01000", -23.5, -46.6, " Sao Paulo", "SP"), ("01000", -23.7, -46.4, "sao paulo ", "SP"),
             ("01000", -22.0, -43.0, "sao paulo", "RJ")],
            "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
            "geolocation_city string, geolocation_state string")
        got = {r["geolocation_state"]: (r["avg_lat"], r["avg_lng"]) for r in dims.dim_geolocation(df).collect()}
        assert got["SP"] == pytest.approx((-23.6, -46.5)) and got["RJ"] == (-22.0, -43.0)


class TestOrderAggregates:
    def test_payments(self, spark):
        df = spark.createDataFrame(
            [("o1", 2, "voucher", 1, 10.10), ("o1", 1, None, 2, 5.05), ("o1", 3, "card", 3, 0.01),
             ("o2", 1, None, 1, 1.0)],
            "order_id string, payment_sequential int, payment_type string, payment_installments int, "
            "payment_value double")
        got = {r["order_id"]: r for r in facts.payments_per_order(df).collect()}
        assert got["o1"]["payment_value_total"] == pytest.approx(15.16)
        assert got["o1"]["payment_type_primary"] == "voucher"  # lowest sequence with a type
        assert got["o1"]["payment_installments_total"] == 6
        assert got["o2"]["payment_type_primary"] is None

    def test_reviews_best_score_latest_date(self, spark):
        df = spark.createDataFrame(
            [("o1", 3, "2018-01-05 00:00:00"), ("o1", 5, "2018-01-01 00:00:00"), ("o1", 4, "junk")],
            "order_id string, review_score int, review_creation_date string")
        r = facts.reviews_per_order(df).collect()[0]
        assert r["review_score"] == 5 and r["review_creation_ts"] == datetime(2018, 1, 5)

    def test_parse_ts_is_wall_clock(self, spark):
        df = spark.createDataFrame([("2017-10-02 10:56:33",), ("junk",), (None,)], "s string")
        out = df.select(parse_ts("s").alias("t"))
        assert out.schema["t"].dataType == TimestampNTZType()
        assert [r["t"] for r in out.collect()] == [datetime(2017, 10, 2, 10, 56, 33), None, None]


ITEMS = ("order_id string, order_item_id int, product_id string, seller_id string, "
         "shipping_limit_date string, price double, freight_value double")
ORDERS = ("order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
          "order_approved_at string, order_delivered_carrier_date string, "
          "order_delivered_customer_date string, order_estimated_delivery_date string")
PAY = ("order_id string, payment_sequential int, payment_type string, payment_installments int, "
       "payment_value double")
REV = ("review_id string, order_id string, review_score int, review_comment_title string, "
       "review_comment_message string, review_creation_date string, review_answer_timestamp string")


class TestPaymentEdges:
    SCHEMA = ("order_id string, payment_sequential int, payment_type string, payment_installments int, "
              "payment_value double")

    def one(self, spark, rows):
        return facts.payments_per_order(spark.createDataFrame(rows, self.SCHEMA)).first()

    def test_total_is_not_rounded(self, spark):
        assert self.one(spark, [("o", 1, "card", 1, 1.005)])["payment_value_total"] == 1.005

    def test_type_without_sequence_counts_last(self, spark):
        assert self.one(spark, [("o", None, "card", 1, 1.0)])["payment_type_primary"] == "card"
        assert self.one(spark, [("o", None, "card", 1, 1.0), ("o", 9, "cash", 1, 1.0)])["payment_type_primary"] == "cash"

    def test_equal_sequences_take_the_smaller_type(self, spark):
        assert self.one(spark, [("o", 1, "cash", 1, 1.0), ("o", 1, "card", 1, 1.0)])["payment_type_primary"] == "card"


class TestMoneyAndMeans:
    def aggregate(self, spark, values, f):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(f("x").alias("y")).first()["y"]

    @pytest.mark.parametrize("values, total", [
        ([1e13, 1.0], 1e13 + 1), ([0.1] * 10, 1.0), ([None, 2.5], 2.5), ([], None), ([float("inf"), 1.0], float("inf"))])
    def test_money_sum_has_no_range(self, spark, values, total):
        assert self.aggregate(spark, values, money_sum) == total

    def test_nan_stays_nan(self, spark):
        assert math.isnan(self.aggregate(spark, [float("nan"), 1.0], money_sum))
        assert math.isnan(self.aggregate(spark, [float("nan"), 1.0], exact_mean))

    @pytest.mark.parametrize("values, mean", [([2e6, 1.0], 1000000.5), ([0.1, 0.2], 0.15), ([None], None)])
    def test_exact_mean_has_no_range(self, spark, values, mean):
        got = self.aggregate(spark, values, exact_mean)
        assert got == mean if mean is None else got == pytest.approx(mean, abs=1e-12)


class TestFact:
    @pytest.fixture()
    def fact(self, spark):
        items = spark.createDataFrame([
            ("o1", 1, "p1", "s1", "x", 10.0, 1.0), ("o1", 1, "p0", "s1", "x", 12.0, 1.0),
            ("o1", 2, "p2", "s2", "x", 5.0, 0.5), ("o9", 1, "p1", "s1", "x", 7.0, 0.7)], ITEMS)
        orders = spark.createDataFrame([
            ("o1", "c1", "delivered", "2017-10-02 10:00:00", None, None, "2017-10-20 00:00:00",
             "2017-10-18 00:00:00")], ORDERS)
        pay = spark.createDataFrame([("o1", 1, "card", 2, 15.0), ("o9", 1, "boleto", 1, 7.0)], PAY)
        rev = spark.createDataFrame([("r1", "o1", 4, None, None, "2017-10-21 00:00:00", None)], REV)
        return facts.fct_order_items(items, orders, pay, rev)

    def test_grain_is_unique(self, fact):
        keys = [(r["order_id"], r["order_item_id"]) for r in fact.collect()]
        assert sorted(keys) == [("o1", 1), ("o1", 2), ("o9", 1)]

    def test_item_survivor_is_lowest_row(self, fact):
        r = fact.filter("order_id = 'o1' AND order_item_id = 1").collect()[0]
        assert r["product_id"] == "p0"

    def test_order_attributes(self, fact):
        r = fact.filter("order_id = 'o1' AND order_item_id = 2").collect()[0]
        assert r["customer_id"] == "c1" and r["order_date"].isoformat() == "2017-10-02"
        assert r["is_delayed"] == 1 and r["payment_value_total"] == 15.0 and r["review_score"] == 4

    def test_orphan_item_kept_with_payment(self, fact):
        # M6: no surviving order -> NULL order attributes, payment still attached.
        r = fact.filter("order_id = 'o9'").collect()[0]
        assert r["customer_id"] is None and r["order_date"] is None and r["is_delayed"] is None
        assert r["payment_type_primary"] == "boleto"

    def test_columns(self, fact):
        assert fact.columns == facts.FACT_COLUMNS
