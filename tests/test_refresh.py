"""Mergeable mart states and the incremental gold stage."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators import marts, states
from tillroll.operators.facts import FACT_COLUMNS
from tillroll.paths import LayerPaths
from tillroll.plans import refresh
from tillroll.sinks.files import exists, write_parquet

WIDE = ("order_id string, order_date date, order_status string, customer_state string, product_category_name_en string, "
        "price double, freight_value double, review_score int, is_delayed int")
DAYS = [None, dt.date(2017, 1, 1), dt.date(2017, 1, 31), dt.date(2017, 2, 1), dt.date(2018, 2, 1)]


def wide_rows(seed, n=400):
    rng = random.Random(seed)
    orders = {f"o{i}": (rng.choice(DAYS), rng.choice(["new", "done", None]), rng.choice(["SP", "RJ", None]),
                        rng.choice([1, 4, 5, None]), rng.choice([0, 1, None])) for i in range(60)}
    out = []
    for _ in range(n):
        o = rng.choice(sorted(orders) + [None])
        day, status, state, score, late = orders.get(o, (None,) * 5)
        price = rng.choice([0.1, 0.335, 7.0, None, rng.randrange(10**6) / 100])
        out.append((o, day, status, state, rng.choice(["toys", "books", None]), price, rng.choice([1.25, None]), score, late))
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def spread(wide, numbers):
    """Number some orders far apart, so that they fall in several ranges."""
    return wide.join(numbers, "order_id", "left")


@pytest.mark.parametrize("mart", sorted(states.MARTS))
@pytest.mark.parametrize("seed", [1, 2])
def test_merged_states_equal_the_mart(spark, mart, seed):
    wide = spark.createDataFrame(wide_rows(seed), WIDE)
    ids = wide.select("order_id").filter("order_id IS NOT NULL").distinct()
    numbers = ids.withColumn("order_number", F.substring("order_id", 2, 9).cast("long") * 1500)
    numbered = spread(wide, numbers)
    # Two runs' states of overlapping orders, merged.
    some = F.pmod(F.xxhash64("price", "order_id"), F.lit(2)) == 0
    parts = [states.mart_states(numbered.filter(c), mart) for c in (some, ~some)]
    got = states.mart_of_states(parts[0].unionByName(parts[1]), mart)
    want = getattr(marts, mart)(wide)
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    assert [r[0] for r in got.collect()] == [r[0] for r in want.collect()]


def test_inexact_and_overflowing_money_falls_back_to_the_plain_sum(spark):
    wide = spark.createDataFrame([("a", DAYS[1], "x", "SP", "toys", p, 1.0, 5, 0) for p in (1e15, 0.25, 1e-9)], WIDE)
    numbered = wide.withColumn("order_number", F.lit(3).cast("long"))
    got = states.mart_of_states(states.mart_states(numbered, "mart_daily_sales"), "mart_daily_sales").first()
    assert got["gmv"] == marts.mart_daily_sales(wide).first()["gmv"]


def test_order_numbers_are_dense_by_date_and_go_on(spark):
    orders = spark.createDataFrame([(f"o{i}", DAYS[i % 5]) for i in range(500)] + [(None, DAYS[1]), ("o1", DAYS[3])],
                                   "order_id string, order_date date")
    first = states.number_orders(orders.filter("order_id < 'o3' OR order_id IS NULL"))
    got = {r["order_id"]: r["order_number"] for r in first.collect()}
    assert sorted(got.values()) == list(range(len(got)))
    by_number = [int(o[1:]) % 5 for o, _ in sorted(got.items(), key=lambda x: x[1]) if o != "o1"]
    assert by_number == sorted(by_number)
    later = {r["order_id"]: r["order_number"] for r in states.number_orders(orders, spark.createDataFrame(
        sorted(got.items()), "order_id string, order_number long")).collect()}
    assert set(later) == {f"o{i}" for i in range(500)} - set(got)
    assert sorted(later.values()) == list(range(len(got), 500))


# -- refreshing

def put_silver(spark, paths, items):
    """items: (order, item, customer, day, price)."""
    full = {c: None for c in FACT_COLUMNS}
    data = []
    for o, i, c, day, price in items:
        data.append(tuple((full | {"order_id": o, "order_item_id": i, "product_id": f"p{i % 2}", "seller_id": "s", "price": price,
                                   "customer_id": c, "order_status": "done", "freight_value": 1.0, "order_date": day,
                                   "review_score": i, "is_delayed": i % 2}).values()))
    kinds = {"order_item_id": "int", "price": "double", "freight_value": "double", "payment_value_total": "double",
             "payment_installments_total": "long", "review_score": "int", "is_delayed": "int", "order_date": "date"}
    kinds |= {c: "timestamp_ntz" for c in FACT_COLUMNS if c.endswith("_ts")}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in FACT_COLUMNS)
    tables = {"fct_order_items": spark.createDataFrame(data, schema),
              "dim_customers": spark.createDataFrame([("c1", "sp", "SP"), ("c2", "rio", "RJ")],
                                                     "customer_id string, customer_city string, customer_state string"),
              "dim_products": spark.createDataFrame([("p0", "toys"), ("p1", "books")],
                                                    "product_id string, product_category_name_en string"),
              "dim_sellers": spark.createDataFrame([("s", "x", "SP")], "seller_id string, seller_city string, seller_state string"),
              "dim_geolocation": spark.createDataFrame([("z",)], "geolocation_zip_code_prefix string")}
    for name, df in tables.items():
        write_parquet(df, paths.silver(name))


def content(spark, paths):
    out = {}
    for t in (refresh.WIDE, *states.MARTS):
        df = spark.read.parquet(paths.gold(t)).drop(marts.LOAD_TIME, refresh.PERIOD)
        out[t] = rows(df.select(sorted(df.columns)))
    return out


def files(paths):
    """Data files of the wide mart and of one mart's states, by month."""
    out = {}
    for t in (refresh.WIDE, "states/mart_state_performance"):
        for folder, _, names in os.walk(paths.gold(t)):
            out.update({os.path.join(folder, n): None for n in names if n.startswith("part-")})
    return set(out)


BEFORE = [("a", 1, "c1", DAYS[1], 10.0), ("a", 2, "c1", DAYS[1], 5.5), ("b", 1, "c2", DAYS[3], 1.0),
          ("c", 1, "c1", DAYS[4], 2.0), ("d", 1, None, None, 3.0), (None, 1, "c1", None, 4.0)]
#: b has moved to January, d has been found a date, a has one item less, e is new.
AFTER = [("a", 1, "c1", DAYS[1], 10.0), ("b", 1, "c2", DAYS[2], 1.0), ("c", 1, "c1", DAYS[4], 2.0),
         ("d", 1, "c2", DAYS[2], 3.0), ("e", 1, "c2", DAYS[2], 9.0), (None, 1, "c1", None, 4.0)]


@pytest.fixture()
def two(spark, tmp_path):
    """The tables after both runs, and a rebuild of the second state."""
    paths, whole = (LayerPaths.under(str(tmp_path / n)) for n in ("two", "whole"))
    put_silver(spark, paths, BEFORE)
    refresh.refresh_gold(spark, paths)
    put_silver(spark, whole, AFTER)
    refresh.refresh_gold(spark, whole)
    return paths, whole


def changed(spark, ids="abde"):
    return spark.createDataFrame([(i,) for i in ids], "order_id string")


def test_two_runs_equal_a_rebuild(spark, two):
    paths, whole = two
    assert content(spark, paths) != content(spark, whole)
    old = files(paths)
    put_silver(spark, paths, AFTER)
    assert refresh.refresh_gold(spark, paths, changed(spark)) == [None, 201701, 201702]
    assert content(spark, paths) == content(spark, whole)
    # February 2017 has no rows any more; February 2018 was left alone.
    months = {f.split(refresh.PERIOD + "=")[1].split("/")[0] for f in files(paths)}
    assert months == {refresh.NO_DATE, "201701", "201802"}
    assert {f for f in old if "201802" in f} == {f for f in files(paths) if "201802" in f}


def test_nothing_changed(spark, two):
    paths, _ = two
    before, old = content(spark, paths), files(paths)
    # Rows without an order id are always looked at again.
    assert refresh.refresh_gold(spark, paths, changed(spark, "")) == [None]
    assert content(spark, paths) == before
    assert {f for f in old if refresh.NO_DATE not in f} <= files(paths)


def test_a_refresh_that_died_is_taken_up(spark, two, monkeypatch):
    paths, whole = two
    put_silver(spark, paths, AFTER)

    def die(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(refresh, "mart_states", die)
        with pytest.raises(RuntimeError, match="lost"):
            refresh.refresh_gold(spark, paths, changed(spark))
    # The wide mart is new, the states are not; b's old month is only known from the dead run.
    assert exists(spark, paths.gold("states/pending"))
    refresh.refresh_gold(spark, paths, changed(spark, "b"))
    assert content(spark, paths) == content(spark, whole)
    assert not exists(spark, paths.gold("states/pending"))


def test_marts_equal_the_direct_ones(spark, two):
    _, whole = two
    wide = spark.read.parquet(whole.gold(refresh.WIDE))
    for name in states.MARTS:
        assert rows(spark.read.parquet(whole.gold(name))) == rows(getattr(marts, name)(wide))
