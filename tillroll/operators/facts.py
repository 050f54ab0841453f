"""Order-grain aggregates and the item-grain sales fact (A2, A4, A5, J1-J3,
P5, X3, X4, X6).

Scale design: the order-grain inputs that a query asks for, and only those,
become one attribute table: their rows are tagged, united and aggregated by
``order_id`` once (map-side partial aggregation, so a hot order is pre-summed
before the shuffle).  The items are dealt by ``order_id`` once: they are
de-duplicated and meet their order's attributes where they lie.  Orders that
hold a large share of the items are kept apart: theirs are reduced map-side,
and their join has fresh shuffles on both sides, the shape adaptive execution
can split.  Which orders these are is found by counting items per hash of the
order, a few numbers per task.

A customer's attributes are joined to the orders, which are several times
fewer, and narrower, than the items.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions import delay_flag, first_value_by, parse_ts
from tillroll.operators.dedupe import keep_first
from tillroll.operators.joins import HOT, hot_classes, key_class, left_join_unique

# --- fixed values: column names of the silver model -------------------------
# raw text column -> parsed timestamp column
ORDER_TIMESTAMPS = {
    "order_purchase_timestamp": "order_purchase_ts",
    "order_approved_at": "order_approved_ts",
    "order_delivered_carrier_date": "order_delivered_carrier_ts",
    "order_delivered_customer_date": "order_delivered_customer_ts",
    "order_estimated_delivery_date": "order_estimated_delivery_ts",
}

# grain of the fact
ITEM_KEYS = ["order_id", "order_item_id"]

# columns of the fact, in order
FACT_COLUMNS = [
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
    "price", "freight_value", "customer_id", "order_status", "order_purchase_ts",
    "order_delivered_customer_ts", "order_estimated_delivery_ts", "payment_value_total",
    "payment_type_primary", "payment_installments_total", "review_score",
    "review_creation_ts", "order_date", "is_delayed",
]
ORDER_COLUMNS = ["customer_id", "order_status", "order_purchase_ts",
                 "order_delivered_customer_ts", "order_estimated_delivery_ts"]
PAYMENT_COLUMNS = ["payment_value_total", "payment_type_primary", "payment_installments_total"]
REVIEW_COLUMNS = ["review_score", "review_creation_ts"]
# --- end of fixed values ----------------------------------------------------

# columns of the fact that are computed from order columns
DERIVED = {"order_date": ["order_purchase_ts"],
           "is_delayed": ["order_delivered_customer_ts", "order_estimated_delivery_ts"]}


def parse_orders(orders: DataFrame) -> DataFrame:
    """Adds the five parsed timestamps to (validated) orders (P5)."""
    return orders.withColumns({ts: parse_ts(raw) for raw, ts in ORDER_TIMESTAMPS.items()})


def delivery_delay(orders_parsed: DataFrame) -> DataFrame:
    """``is_delayed`` per order."""
    return orders_parsed.select(
        "order_id", "order_delivered_customer_ts", "order_estimated_delivery_ts",
        delay_flag("order_delivered_customer_ts", "order_estimated_delivery_ts").alias("is_delayed"))


def _payment_aggregates() -> list[Column]:
    return [F.sum("payment_value").alias("payment_value_total"),
            first_value_by("payment_type", "payment_sequential").alias("payment_type_primary"),
            F.sum("payment_installments").alias("payment_installments_total")]


def _review_aggregates() -> list[Column]:
    return [F.max("review_score").alias("review_score"),
            F.max(parse_ts("review_creation_date")).alias("review_creation_ts")]


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Total value, unrounded, primary type (lowest sequence with a type; a type
    without a sequence comes last), instalments (A4)."""
    return payments.groupBy("order_id").agg(*_payment_aggregates())


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """Highest score and latest creation time per order (A5)."""
    return reviews.groupBy("order_id").agg(*_review_aggregates())


def dedupe_items(order_items: DataFrame) -> DataFrame:
    """One row per (order_id, order_item_id), lowest remaining columns (A2)."""
    return keep_first(order_items, ITEM_KEYS)


def order_attributes(orders_valid: DataFrame | None = None, payments: DataFrame | None = None,
                     reviews: DataFrame | None = None, own: Sequence[str] = ()) -> DataFrame:
    """One row per order with the columns of the sides that are given.

    An order known only to payments or reviews keeps those attributes, as the
    item joins require.  ``orders_valid`` is unique per order, so ``max`` of
    its columns is its one row; ``own`` names further ones.
    """
    wide, aggregates = None, []
    if orders_valid is not None:
        wide = parse_orders(orders_valid).select("order_id", *ORDER_COLUMNS, *own)
        aggregates += [F.max(c).alias(c) for c in [*ORDER_COLUMNS, *own]]
    for side, columns, parts in (
            (payments, ["payment_value", "payment_type", "payment_sequential", "payment_installments"],
             _payment_aggregates()),
            (reviews, ["review_score", "review_creation_date"], _review_aggregates())):
        if side is not None:
            rows = side.select("order_id", *columns)
            wide = rows if wide is None else wide.unionByName(rows, allowMissingColumns=True)
            aggregates += parts
    return wide.groupBy("order_id").agg(*aggregates)


def items_with_attributes(order_items: DataFrame, attributes: DataFrame, hot: int = HOT,
                          classes: Sequence[int] | None = None) -> DataFrame:
    """De-duplicated items left join ``attributes``, unique per order.

    ``classes``: the hot ones, if they were counted before; without any, nothing
    is kept apart, and no input is read for that a second time.  Else a subquery
    finds them."""
    if classes is None:
        found = hot_classes(order_items, "order_id", hot)
        apart = F.array_contains(found.agg(F.collect_list("class")).scalar(), key_class("order_id"))
    else:
        apart = key_class("order_id").isin(list(classes))
    near = (keep_first(order_items.filter(~apart).repartition("order_id"), ITEM_KEYS)
            .join(attributes, "order_id", "left"))
    if classes is not None and not classes:
        return near
    far = left_join_unique(dedupe_items(order_items.filter(apart)), attributes.filter(apart),
                           "order_id", ITEM_KEYS + ["product_id"])
    return near.unionByName(far)


def fct_order_items(order_items: DataFrame, orders_valid: DataFrame, payments: DataFrame,
                    reviews: DataFrame, columns: Sequence[str] = FACT_COLUMNS,
                    customers: DataFrame | None = None, hot: int = HOT,
                    classes: Sequence[int] | None = None) -> DataFrame:
    """Item-grain fact (J1-J3), its ``columns`` only: a side none of whose
    columns is asked for is not read.  Items without a surviving order are
    kept with NULL order attributes (they form the NULL date group
    downstream).  The columns of ``customers`` (unique per customer_id) follow,
    if it is given.  ``hot`` and ``classes``: see ``items_with_attributes``."""
    own = [] if customers is None else [c for c in customers.columns if c != "customer_id"]
    needed = {b for c in columns for b in DERIVED.get(c, [c])}
    asked = [needed & set(ORDER_COLUMNS) or own, needed & set(PAYMENT_COLUMNS), needed & set(REVIEW_COLUMNS)]
    sides = [df if some else None for df, some in zip((orders_valid, payments, reviews), asked)]
    if own:
        sides[0] = left_join_unique(sides[0], customers, "customer_id", ["order_id"])
    if any(s is not None for s in sides):
        out = items_with_attributes(order_items, order_attributes(*sides, own=own), hot, classes)
    else:
        out = dedupe_items(order_items)
    derived = {"order_date": lambda: F.to_date("order_purchase_ts"),
               "is_delayed": lambda: delay_flag("order_delivered_customer_ts", "order_estimated_delivery_ts")}
    return out.withColumns({c: f() for c, f in derived.items() if c in columns}).select(*columns, *own)
