"""Incremental gold stage (K4): only the months a landing run touches.

Kept below ``<mart>/gold``:

* ``mart_order_analytics``, partitioned by month;
* ``states/<mart>``, the mergeable states of each aggregate mart, by date, in
  partitions by month;
* ``states/order_numbers``, the dense number of every order;
* the aggregate marts, merged from the states.

A refresh gets the silver tables as they are now and the ids of the orders that
changed.  It finds the months in which these orders were and are, recomputes
those months' wide rows and states (dynamic partition overwrite), removes months
that have no rows any more, and merges the marts.  Cost is in proportion to the
touched months, but for the merge, which reads a row per date, group and range
of order numbers.

The touched months are written down first and forgotten last.  A refresh that
dies on the way is repeated: it takes up the months that the dead one left.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tillroll.operators import marts
from tillroll.operators.states import (
    DATE, MARTS, mart_of_states, mart_states, measure_groups, number_orders, place_orders)
from tillroll.paths import LayerPaths
from tillroll.plans.pipeline import DEFAULT_CONCURRENT_JOBS, SILVER_TABLES, write_all
from tillroll.sinks.files import WRITE_OPTIONS, exists, remove, write_parquet
from tillroll.sources.parquet import read_table

log = logging.getLogger(__name__)

WIDE, PERIOD = "mart_order_analytics", "order_month"
#: Spark's folder name of the partition without a value.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _enriched(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    s = {t: read_table(spark, paths.silver(t)) for t in SILVER_TABLES}
    # Customers last: their join leaves an order's rows in one task, so that the
    # wide rows' later passes by order find them together.
    by_item = marts.fct_enriched(s["fct_order_items"], None, s["dim_products"], s["dim_sellers"])
    return marts.fct_enriched(by_item, s["dim_customers"], None, None)


def _month() -> Column:
    """201702 for a day of February 2017; NULL without a date."""
    return (100 * F.year(DATE) + F.month(DATE)).cast("int")


def _within(months: list) -> Column:
    """Rows of these months; literals, so that a scan is pruned."""
    known = [m for m in months if m is not None]
    missing = F.col(PERIOD).isNull() if None in months else F.lit(False)
    return missing | (F.col(PERIOD).isin(known) if known else F.lit(False))


def _replace(rows: DataFrame, path: str, months: list) -> DataFrame:
    """Overwrite the partitions of ``months``, remove those without rows; the
    table as it is then.  Months are dealt to tasks by size, a large one to
    several."""
    spark = rows.sparkSession
    rows = rows.withColumn(PERIOD, _month())
    seen = Observation()
    written = rows.observe(seen, F.collect_set(PERIOD).alias("months"), F.count_if(F.col(PERIOD).isNull()).alias("dateless"))
    (written.hint("rebalance", PERIOD).write.mode("overwrite").options(**WRITE_OPTIONS).option("partitionOverwriteMode", "dynamic")
            .partitionBy(PERIOD).parquet(path))
    kept = {*(seen.get["months"] or ()), *([None] if seen.get["dateless"] else [])}
    for m in set(months) - kept:
        remove(spark, f"{path}/{PERIOD}={NO_DATE if m is None else m}")
    return spark.read.schema(rows.schema).parquet(path)


def _touched(spark: SparkSession, paths: LayerPaths, fact: DataFrame, changed: DataFrame | None) -> list:
    """The months to recompute: those of the changed orders now and before, and
    those that a dead refresh left.  As many come to the driver as the calendar
    has months."""
    found = fact.select("order_id", _month().alias(PERIOD))
    if exists(spark, paths.gold(WIDE)):
        found = found.unionByName(read_table(spark, paths.gold(WIDE)).select("order_id", PERIOD))
    if changed is not None:
        # Any row without an order id may be new.
        some = changed.select("order_id").distinct()
        found = found.join(some, "order_id", "left_semi").unionByName(found.filter(F.col("order_id").isNull()))
    write_parquet(found.select(PERIOD).distinct(), paths.gold("states/pending"), mode="append")
    pending = read_table(spark, paths.gold("states/pending")).distinct().collect()
    return sorted((r[0] for r in pending), key=lambda m: (m is not None, m))


def refresh_gold(spark: SparkSession, paths: LayerPaths, changed: DataFrame | None = None,
                 concurrent_jobs: int = DEFAULT_CONCURRENT_JOBS) -> list:
    """Bring the gold tables up to the silver tables; returns the touched months.

    ``changed`` has the ids of all orders any of whose rows (orders, items,
    payments, reviews, or their customers', products' and sellers' attributes)
    are new or other than before; None: everything.
    """
    # Dates are the fact's own: no dimension is needed to find the months, nor to
    # number the orders, whose rows lie together there.
    fact = read_table(spark, paths.silver("fct_order_items"))
    months = _touched(spark, paths, fact, changed)
    enriched = _enriched(spark, paths)
    log.info("refreshing %d months", len(months))
    numbers = paths.gold("states/order_numbers")
    known = read_table(spark, numbers) if exists(spark, numbers) else None
    rows = marts.mart_order_analytics(enriched.withColumn(PERIOD, _month()).filter(_within(months)))
    orders = fact.withColumn(PERIOD, _month()).filter(_within(months)).select("order_id", DATE)
    made: dict[str, DataFrame] = {}
    write_all({"wide": lambda: made.update(wide=_replace(rows, paths.gold(WIDE), months).filter(_within(months))),
               "numbers": lambda: write_parquet(number_orders(orders, known), numbers, mode="append")}, concurrent_jobs)
    wide = made["wide"]
    write_all({"placed": lambda: made.update(placed=place_orders(wide, read_table(spark, numbers))),
               "measured": lambda: made.update(measured=measure_groups(wide))}, concurrent_jobs)

    def merge(mart: str) -> None:
        states = _replace(mart_states(wide, mart, made["placed"], made["measured"]), paths.gold(f"states/{mart}"), months)
        write_parquet(mart_of_states(states, mart), paths.gold(mart))
    write_all({mart: (lambda mart=mart: merge(mart)) for mart in MARTS}, concurrent_jobs)
    remove(spark, paths.gold("states/pending"))
    return months
