"""Gold marts.

All marts come from one enriched item-grain frame.  In the pipeline that
frame is written once as ``mart_order_analytics`` and the four aggregates
read it back, so the joins run once and lineage is cut by a table in shared
storage rather than an executor-local cache.

Aggregation shape: ``countDistinct`` next to plain aggregates is planned as
a two-level aggregation keyed first by (group, order_id), so a hot group —
one date or state with a third of all items — is pre-aggregated map-side
and spread over the cluster by order_id before the final merge.  Each of those
rows carries every measure's buffers.  Of a stored frame, which is read again
at little cost, orders and measures are aggregated apart: then only groups and
order ids are shuffled, and the measures of a group are one row per task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.functions import money_sum, rounded_mean
from tillroll.operators.joins import left_join_unique
from tillroll.sinks.buckets import Layout, join_layouts

# fixed values: columns of the wide analytics mart, in order (plus the load time)
ANALYTICS_COLUMNS = [
    "order_id", "order_item_id", "order_date", "order_status", "customer_state",
    "customer_city", "seller_state", "seller_city", "product_id", "product_category_name_en",
    "price", "freight_value", "payment_value_total", "payment_type_primary", "review_score",
    "is_delayed",
]
LOAD_TIME = "etl_loaded_at"

# dimension attributes of the enriched fact, and what each aggregate mart reads
CUSTOMER_COLUMNS = ["customer_state", "customer_city"]
PRODUCT_COLUMNS = ["product_category_name_en"]
SELLER_COLUMNS = ["seller_city", "seller_state"]
MART_INPUTS = {
    "mart_daily_sales": ["order_id", "order_date", "price", "freight_value", "review_score", "is_delayed"],
    "mart_state_performance": ["order_id", "customer_state", "price", "review_score"],
    "mart_category_performance": ["order_id", "product_category_name_en", "price", "review_score"],
    "mart_order_status_daily": ["order_id", "order_date", "order_status", "price", "is_delayed"],
}


def fact_columns(columns: Sequence[str]) -> list[str]:
    """Columns the fact must have for ``columns`` of the enriched fact."""
    keys = [k for k, own in (("customer_id", CUSTOMER_COLUMNS), ("product_id", PRODUCT_COLUMNS),
                             ("seller_id", SELLER_COLUMNS)) if set(own) & set(columns)]
    attributes = {*CUSTOMER_COLUMNS, *PRODUCT_COLUMNS, *SELLER_COLUMNS}
    spread = ["order_id", "order_item_id"] if keys else []
    return list(dict.fromkeys([*spread, *(c for c in columns if c not in attributes), *keys]))


def fct_enriched(fact: DataFrame, dim_customers: DataFrame | None, dim_products: DataFrame | None,
                 dim_sellers: DataFrame | None, columns: Sequence[str] | None = None) -> DataFrame:
    """Fact plus customer, product and seller attributes.

    Each dimension is unique per key and joined only when one of its
    attributes is among ``columns`` (all of them by default) and it is given:
    one that is joined already is None.  Hot and missing keys: see
    ``joins.left_join_unique``.
    """
    out = fact
    spread = [c for c in ("order_id", "order_item_id") if c in fact.columns] or fact.columns
    for dim, key, own in ((dim_customers, "customer_id", CUSTOMER_COLUMNS),
                          (dim_products, "product_id", PRODUCT_COLUMNS),
                          (dim_sellers, "seller_id", SELLER_COLUMNS)):
        if dim is not None and (columns is None or set(own) & set(columns)):
            out = left_join_unique(out, dim.select(key, *own), key, spread)
    return out if columns is None else out.select(*columns)


def fct_enriched_colocated(spark: SparkSession, fact: Layout, dim_customers: Layout, dim_products: DataFrame,
                           dim_sellers: DataFrame) -> DataFrame:
    """``fct_enriched`` of a fact and customers that lie bucketed by customer:
    the largest of the three joins moves nothing."""
    by_customer = join_layouts(spark, fact, dim_customers)
    return fct_enriched(by_customer, None, dim_products, dim_sellers)


def mart_order_analytics(enriched: DataFrame, with_load_time: bool = True) -> DataFrame:
    """Wide row-level table (P4); ``etl_loaded_at`` is one value per query."""
    cols = [F.col(c) for c in ANALYTICS_COLUMNS]
    if with_load_time:
        cols.append(F.current_timestamp().alias(LOAD_TIME))
    return enriched.select(*cols)


def _grouped(enriched: DataFrame, keys: Sequence[str], orders: str, measures: Sequence[Column],
             stored: bool) -> DataFrame:
    """Distinct orders and ``measures`` per group."""
    counted = F.countDistinct("order_id").alias(orders)
    if not stored:
        return enriched.groupBy(*keys).agg(counted, *measures)
    counts = enriched.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(counted)
    totals = enriched.groupBy(*keys).agg(*measures)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return totals.join(counts, same).select(*keys, orders, *[c for c in totals.columns if c not in keys])


def mart_daily_sales(enriched: DataFrame, sort: bool = True, stored: bool = False) -> DataFrame:
    """Orders, GMV, freight, item-weighted review score and delay rate per day."""
    out = _grouped(enriched, ["order_date"], "orders", [
        money_sum("price").alias("gmv"),
        money_sum("freight_value").alias("freight_total"),
        rounded_mean("review_score", 2).alias("avg_review_score"),
        rounded_mean("is_delayed", 4).alias("delay_rate"),
    ], stored)
    return out.orderBy(F.col("order_date").asc_nulls_first()) if sort else out


def mart_state_performance(enriched: DataFrame, sort: bool = True, stored: bool = False) -> DataFrame:
    """Orders, GMV and review score per customer state, biggest GMV first."""
    out = _grouped(enriched, ["customer_state"], "orders", [
        money_sum("price").alias("gmv"),
        rounded_mean("review_score", 2).alias("avg_review_score"),
    ], stored)
    return out.orderBy(F.col("gmv").desc_nulls_last(), "customer_state") if sort else out


def mart_category_performance(enriched: DataFrame, sort: bool = True, stored: bool = False) -> DataFrame:
    """Orders, GMV and review score per English category."""
    out = _grouped(enriched, ["product_category_name_en"], "orders", [
        money_sum("price").alias("gmv"),
        rounded_mean("review_score", 2).alias("avg_review_score"),
    ], stored)
    return out.orderBy(F.col("gmv").desc_nulls_last(), "product_category_name_en") if sort else out


def mart_order_status_daily(enriched: DataFrame, sort: bool = True, stored: bool = False) -> DataFrame:
    """Orders, GMV and delay rate per day and status."""
    out = _grouped(enriched, ["order_date", "order_status"], "order_cnt", [
        money_sum("price").alias("gmv"),
        rounded_mean("is_delayed", 4).alias("delay_rate"),
    ], stored)
    return (out.orderBy(F.col("order_date").asc_nulls_first(), F.col("order_status").asc_nulls_first())
            if sort else out)
