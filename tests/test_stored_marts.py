"""Marts of stored rows shuffle no measures per order, and order numbers are
joined to no wide rows: both give the mart's rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators import marts, states

from test_refresh import WIDE, wide_rows
from test_wide_passes import exchanged


@pytest.mark.parametrize("mart", sorted(states.MARTS))
def test_stored_marts_and_placed_orders_equal_the_mart(spark, mart, tmp_path):
    wide_rows_ = wide_rows(3)
    spark.createDataFrame(wide_rows_, WIDE).write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    want = getattr(marts, mart)(wide)
    stored = getattr(marts, mart)(wide, stored=True)
    assert stored.columns == want.columns and stored.collect() == want.collect()
    numbers = wide.select("order_id").filter("order_id IS NOT NULL").distinct().withColumn(
        "order_number", F.substring("order_id", 2, 9).cast("long") * 1500)
    placed = states.place_orders(wide, numbers)
    got = states.mart_of_states(states.mart_states(wide, mart, placed), mart)
    assert got.columns == want.columns and Counter(got.collect()) == Counter(want.collect())
    # Per order only groups and ids are shuffled.
    by_order = [cols for cols, by in exchanged(stored) if "order_id" in by]
    assert by_order and all("sum#" not in c for c in by_order)
