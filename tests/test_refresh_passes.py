"""Passes of the refresh at size: the marts' measures take one pass over the
wide rows, the fact reads its items once, and rows lie so that later passes are
cheap."""

import datetime as dt
import glob
import hashlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillroll.functions.expressions import money_parts
from tillroll.operators import facts, marts, quality, states
from tillroll.operators.digest import SEPARATOR, table_digest
from tillroll.operators.joins import hot_classes
from tillroll.paths import LayerPaths
from tillroll.plans import refresh
from tillroll.plans.queries import Model
from tillroll.sinks.files import write_parquet
from tillroll.sources.parquet import read_identified

from test_quality import EARLIER, LATER, PATTERNS, SCHEMA, expected, version
from test_refresh import WIDE, rows, wide_rows
from test_wide_passes import exchanged, no_broadcast  # noqa: F401


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("mart", sorted(states.MARTS))
def test_measured_groups_give_the_mart_without_the_wide_rows(spark, mart, tmp_path):
    path = str(tmp_path / "wide")
    spark.createDataFrame(wide_rows(5), WIDE).write.parquet(path)
    wide = spark.read.parquet(path)
    numbers = states.number_orders(wide.select("order_id", "order_date")).localCheckpoint()
    placed, measured = states.place_orders(wide, numbers), states.measure_groups(wide)
    parts = states.mart_states(wide, mart, placed, measured)
    assert path not in plan(parts)
    assert parts.columns == states.mart_states(wide, mart, placed).columns
    got, want = states.mart_of_states(parts, mart), getattr(marts, mart)(wide)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_a_group_without_amounts_does_not_spoil_an_exact_sum(spark):
    day = [dt.date(2017, 1, d) for d in (1, 2, 3)]
    wide = spark.createDataFrame([("a", day[0], "x", "SP", "toys", None, None, 5, 0), ("b", day[1], "x", "SP", "toys", 0.1, 1.0, 5, 0)], WIDE)
    whole = wide.groupBy("order_date").agg(money_parts("price")["whole"].alias("whole"))
    assert {r["order_date"]: r["whole"] for r in whole.collect()} == {day[0]: None, day[1]: True}
    inexact = spark.createDataFrame([(1e15,), (0.25,)], "price double").agg(money_parts("price")["whole"].alias("whole"))
    assert inexact.first()["whole"] is False


@pytest.mark.parametrize("classes", [None, [], "some"])
def test_known_hot_classes_give_the_same_fact(spark, smoke_dir, classes, tmp_path):
    m = Model(spark, smoke_dir)
    m.bronze("order_items").limit(3000).write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    sides = m.orders_valid(), m.bronze("order_payments"), m.bronze("order_reviews")
    if classes == "some":
        classes = [r["class"] for r in hot_classes(items, "order_id", 3).collect()]
        assert 0 < len(classes) < 3000 / 3
    got = facts.fct_order_items(items, *sides, classes=classes)
    assert rows(got) == rows(facts.fct_order_items(items, *sides, hot=3))
    # Without a hot class nothing is read for it.
    assert (plan(got).count("/items]") == 1) == (classes == [])


@pytest.fixture()
def no_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rows_of_an_order_leave_the_joins_in_one_task(spark, no_broadcast, no_coalescing, tmp_path):  # noqa: F811
    fact = spark.range(4000).select(
        F.concat(F.lit("o"), F.floor(F.col("id") / 8)).alias("order_id"), F.col("id").alias("order_item_id"),
        F.concat(F.lit("c"), F.floor(F.col("id") / 80)).alias("customer_id"),
        F.concat(F.lit("p"), F.col("id") % 97).alias("product_id"), F.concat(F.lit("s"), F.col("id") % 31).alias("seller_id"))

    def dim(key, n, *own):
        return spark.range(n).select(F.concat(F.lit(key[0]), "id").alias(key), *[F.lit(c).alias(c) for c in own])
    paths = LayerPaths.under(str(tmp_path))
    for name, df in {"fct_order_items": fact, "dim_customers": dim("customer_id", 50, *marts.CUSTOMER_COLUMNS),
                     "dim_products": dim("product_id", 97, *marts.PRODUCT_COLUMNS),
                     "dim_sellers": dim("seller_id", 31, *marts.SELLER_COLUMNS), "dim_geolocation": spark.range(1)}.items():
        write_parquet(df, paths.silver(name))
    out = refresh._enriched(spark, paths)
    assert set(out.columns) == {*fact.columns, *marts.CUSTOMER_COLUMNS, *marts.PRODUCT_COLUMNS, *marts.SELLER_COLUMNS}
    assert out.where("seller_city IS NOT NULL AND customer_city IS NOT NULL").count() == 4000
    where = out.select("order_id", F.spark_partition_id().alias("task")).distinct()
    assert where.count() == 500 and where.select("task").distinct().count() > 1


def test_columns_of_many_values_are_written_without_a_dictionary(spark, tmp_path):
    write_parquet(spark.range(5000).select(F.col("id").cast("string").alias("order_id"), F.lit("x").alias("order_status")).coalesce(1), str(tmp_path / "t"))
    group = pq.ParquetFile(glob.glob(str(tmp_path / "t/*.parquet"))[0]).metadata.row_group(0)
    kinds = {group.column(i).path_in_schema: "RLE_DICTIONARY" in str(group.column(i).encodings) or "PLAIN_DICTIONARY" in str(group.column(i).encodings) for i in range(2)}
    assert kinds == {"order_id": False, "order_status": True}


def test_digest_is_the_sum_of_the_hashes(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("a"), F.lit(None).cast("int").alias("b"))
    want = sum(int(hashlib.md5(SEPARATOR.join([f"={i}", "-"]).encode()).hexdigest()[:15], 16) for i in range(1000))
    assert table_digest(df, "t").first()["row_digest"] == str(want)


@pytest.mark.parametrize("hot", [0, 2, 10**6])
def test_the_gate_by_class_tags_every_row_by_the_same_rule(spark, tmp_path, hot):
    data = []
    for i, pattern in enumerate(PATTERNS):
        for twin in (None, EARLIER, LATER):
            data.append(version(pattern, f"k{i}{twin}"))
            if twin:
                data += [version((False,) * 4, f"k{i}{twin}", twin) for _ in range(1 + i % 3)]
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(str(tmp_path / "t"))
    orders = read_identified(spark, str(tmp_path / "t"), quality.IDENTITY)
    classes = [r["class"] for r in hot_classes(orders, "order_id", hot).collect()]
    assert bool(classes) == (hot < 10)
    tagged = quality.tag_by_class(orders, classes)
    assert rows(tagged) == expected(data) == rows(quality.tag_orders(orders))


def test_the_gate_deals_whole_rows_once(spark, smoke_dir, tmp_path, no_broadcast):  # noqa: F811
    Model(spark, smoke_dir).bronze("orders").write.parquet(str(tmp_path / "t"))
    orders = read_identified(spark, str(tmp_path / "t"), quality.IDENTITY)
    whole = ["order_estimated_delivery_date" in cols for cols, _ in exchanged(quality.tag_by_class(orders, []))]
    assert whole == [True]
