"""Mergeable states of the aggregate marts (A6-A12 in parts that add up).

A state row holds, for one date, one group and one range of order numbers, all
that the mart's measures need of those items, and every part of it merges:

* distinct orders as a bitmap over dense order numbers, one bit each, 32,768 to
  a row: exact, and the union of bitmaps is the distinct count of the union;
* money as an exact sum beside the plain one and whether all amounts were exact
  (see ``functions.money_sum``);
* means as sums and counts.

Orders and measures come in rows of their own, which merge like any others: the
bitmaps from one narrow table of each order's groups, dealt by range of order
numbers (``place_orders``), so that a range's bitmaps are built in one task; the
measures, which all marts share, from one pass over the wide rows, by all marts'
keys at once (``measure_groups``), merged to each mart's groups.

So a date's states are computed once, from that date's rows alone, and the
marts are merged from states, however the rows came in.  Numbers are dealt in
the order of dates, so a date's orders lie in few ranges; unlike a distinct
count, the aggregation needs one shuffle and no row per order in it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.functions.expressions import money_of, money_parts
from tillroll.session import scratch_path
from tillroll.sinks.files import write_parquet

DATE, NUMBER = "order_date", "order_number"

#: Grouping columns, name of the order count, money and mean measures (name,
#: column, digits of the mean) of each mart, in the marts' column order.
MARTS: dict[str, dict] = {
    "mart_daily_sales": {
        "keys": [DATE], "orders": "orders", "money": {"gmv": "price", "freight_total": "freight_value"},
        "means": {"avg_review_score": ("review_score", 2), "delay_rate": ("is_delayed", 4)}},
    "mart_state_performance": {
        "keys": ["customer_state"], "orders": "orders", "money": {"gmv": "price"},
        "means": {"avg_review_score": ("review_score", 2)}},
    "mart_category_performance": {
        "keys": ["product_category_name_en"], "orders": "orders", "money": {"gmv": "price"},
        "means": {"avg_review_score": ("review_score", 2)}},
    "mart_order_status_daily": {
        "keys": [DATE, "order_status"], "orders": "order_cnt", "money": {"gmv": "price"},
        "means": {"delay_rate": ("is_delayed", 4)}},
}

#: How the parts of a money measure merge.
MONEY = {"units": F.try_sum, "millionths": F.try_sum, "whole": F.bool_and, "plain": F.sum}


def number_orders(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(order_id, order_number) of the orders (order_id, order_date) that are
    not ``known``: dense numbers from 0, or from the highest known one on, in
    the order of dates.

    Numbers are places within range partitions (sampling splits a hot date),
    plus the rows of the partitions before; the partitioned rows are written
    once, so that both see the same ones.  NULL ids get none.
    """
    spark = orders.sparkSession
    new = orders.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.min(DATE).alias(DATE))
    first = 0
    if known is not None:
        new = new.join(known.select("order_id"), "order_id", "left_anti")
        first = known.agg(F.coalesce(F.max(NUMBER) + 1, F.lit(0))).first()[0]
    path = scratch_path(spark, "order-numbers")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    new = (new.repartitionByRange(parts, F.col(DATE).asc_nulls_first(), "order_id")
              .withColumn("_part", F.spark_partition_id()))
    write_parquet(new, path)
    new = spark.read.schema(new.schema).parquet(path)
    # One row per partition: ``parts`` of them at most.
    sizes = new.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = Window.partitionBy("_part").orderBy(F.col(DATE).asc_nulls_first(), "order_id")
    return (new.withColumn("_place", F.row_number().over(place) - 1).join(F.broadcast(sizes), "_part")
               .select("order_id", (F.col("_before") + F.col("_place") + first).cast("long").alias(NUMBER)))


def place_orders(wide: DataFrame, numbers: DataFrame) -> DataFrame:
    """The distinct groups of every numbered order, all marts' keys at once, with
    its number; written once, ranges of numbers whole in a file.

    The groups are collected map-side, so a hot order is a few rows per task.
    """
    spark = wide.sparkSession
    keys = _all_keys()
    each = (wide.filter(F.col("order_id").isNotNull()).groupBy("order_id")
                .agg(F.collect_set(F.struct(*keys)).alias("_groups")))
    out = (each.join(numbers, "order_id").select(NUMBER, F.inline("_groups"))
               .repartition(F.bitmap_bucket_number(F.col(NUMBER) + 1)))
    path = scratch_path(spark, "placed-orders")
    write_parquet(out, path)
    return spark.read.schema(out.schema).parquet(path)


def _all_keys() -> list[str]:
    """The grouping columns of all marts."""
    return list(dict.fromkeys([DATE, *(k for shape in MARTS.values() for k in shape["keys"])]))


def _measures(*names: str) -> list[Column]:
    """The measures of these marts; one that several have is there once, as a
    name has one meaning."""
    parts: dict[str, Column] = {}
    for shape in map(MARTS.get, names):
        for name, column in shape["money"].items():
            parts |= {f"{name}_{part}": c for part, c in money_parts(column).items()}
        for name, (column, _) in shape["means"].items():
            parts |= {f"{name}_sum": F.sum(F.col(column).cast("long")), f"{name}_n": F.count(column)}
    return [c.alias(name) for name, c in parts.items()]


def _merged(mart: str) -> list[Column]:
    """The measures of ``mart`` merged from rows of its measures."""
    parts = [merge(f"{name}_{part}").alias(f"{name}_{part}")
             for name in MARTS[mart]["money"] for part, merge in MONEY.items()]
    for name in MARTS[mart]["means"]:
        parts += [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("sum", "n")]
    return parts


def measure_groups(wide: DataFrame) -> DataFrame:
    """The measures of all marts by all marts' keys at once, in one pass over the
    wide rows; written once."""
    out = wide.groupBy(*_all_keys()).agg(*_measures(*MARTS))
    path = scratch_path(wide.sparkSession, "measured-groups")
    write_parquet(out, path)
    return wide.sparkSession.read.schema(out.schema).parquet(path)


def mart_states(rows: DataFrame, mart: str, placed: DataFrame | None = None,
                measured: DataFrame | None = None) -> DataFrame:
    """State rows of ``mart`` from wide rows with their order numbers, or from
    wide rows as they are and their ``placed`` orders: then rows of measures, in
    range 0 and without a bitmap, and rows of bitmaps without measures.  Measures
    are merged from ``measured`` groups of the same rows, if these are given.

    Rows without an order number count in every measure but the orders.
    """
    keys = list(dict.fromkeys([DATE, *MARTS[mart]["keys"]]))
    # Numbers of the functions start from 1.
    at = F.col(NUMBER) + 1
    bits = {"bucket": F.coalesce(F.bitmap_bucket_number(at), F.lit(0)), "_bit": F.bitmap_bit_position(at)}
    bitmap = F.bitmap_construct_agg("_bit").alias("orders_seen")
    if placed is None:
        return rows.withColumns(bits).groupBy(*keys, "bucket").agg(bitmap, *_measures(mart))
    measures = (rows.groupBy(*keys).agg(*_measures(mart)) if measured is None
                else measured.groupBy(*keys).agg(*_merged(mart))).withColumn("bucket", F.lit(0).cast("long"))
    seen = placed.withColumns(bits).groupBy(*keys, "bucket").agg(bitmap)
    columns = [*keys, "bucket", "orders_seen", *[c for c in measures.columns if c not in (*keys, "bucket")]]
    return seen.unionByName(measures, allowMissingColumns=True).select(*columns)


def mart_of_states(states: DataFrame, mart: str, sort: bool = True) -> DataFrame:
    """The mart, merged from states of any dates and runs."""
    shape = MARTS[mart]
    keys = shape["keys"]
    merged = [F.bitmap_or_agg("orders_seen").alias("orders_seen"), *_merged(mart)]
    final = [F.sum(F.bitmap_count("orders_seen")).alias(shape["orders"])]
    for name in shape["money"]:
        final.append(money_of(**{part: merge(f"{name}_{part}") for part, merge in MONEY.items()}).alias(name))
    for name, (_, digits) in shape["means"].items():
        n = F.sum(f"{name}_n")
        final.append(F.when(n > 0, F.round(F.sum(f"{name}_sum") / n, digits)).alias(name))
    out = states.groupBy(*keys, "bucket").agg(*merged).groupBy(*keys).agg(*final)
    if not sort:
        return out
    by = ([F.col(k).asc_nulls_first() for k in keys] if DATE in keys
          else [F.col("gmv").desc_nulls_last(), F.col(keys[0]).asc_nulls_first()])
    return out.orderBy(*by)
