"""DuckDB oracle: each registered query restated in plain SQL.

The SQL deliberately follows the *reference* formulation — one row_number
over every row of a key, joins in the original order — and not the
skew-safe Spark plan, so the two are independent.  Money sums of the marts are
exact decimal sums rounded once; the payment total is the reference's plain sum; rounding of means uses integer half-up, which equals Spark's
``round(avg(x), n)`` on these inputs (DuckDB's own ``round`` breaks ties
differently on binary doubles).
"""

from __future__ import annotations

from tillroll.operators.facts import FACT_COLUMNS
from tillroll.operators.marts import ANALYTICS_COLUMNS
from tillroll.schemas import column_names

TS = "'%Y-%m-%d %H:%M:%S'"

ORDER_COLS = ("order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
              "order_delivered_carrier_date, order_delivered_customer_date, "
              "order_estimated_delivery_date")

NULL_REASON = ("coalesce(CASE WHEN order_id IS NULL THEN 'null:order_id' END, "
               "CASE WHEN customer_id IS NULL THEN 'null:customer_id' END, "
               "CASE WHEN order_status IS NULL THEN 'null:order_status' END, "
               "CASE WHEN order_purchase_timestamp IS NULL THEN 'null:order_purchase_timestamp' END)")

COMPLETE = ("order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IS NOT NULL "
            "AND order_purchase_timestamp IS NOT NULL")


def _cents(c: str) -> str:
    return f"cast(round(sum(cast({c} AS DECIMAL(18,6))), 2) AS DOUBLE)"


def _half_up_mean(c: str, p: int) -> str:
    return f"cast(({2 * p} * sum({c}) + count({c})) // (2 * count({c})) AS DOUBLE) / {p}.0"


CTES = f"""
b_orders AS (
  SELECT cast(o_orderkey AS VARCHAR) AS order_id,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE cast(o_custkey AS VARCHAR) END AS customer_id,
         o_orderstatus AS order_status,
         CASE WHEN o_orderkey % 101 = 0 THEN 'junk' ELSE strftime(o_orderdate, {TS}) END
           AS order_purchase_timestamp,
         strftime(o_orderdate + to_hours(cast(o_orderkey % 48 AS INTEGER)), {TS}) AS order_approved_at,
         CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE strftime(o_orderdate + to_days(cast(o_orderkey % 5 + 1 AS INTEGER)), {TS}) END
           AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE strftime(o_orderdate + to_days(cast(o_orderkey % 30 AS INTEGER)), {TS}) END
           AS order_delivered_customer_date,
         strftime(o_orderdate + INTERVAL 20 DAY, {TS}) AS order_estimated_delivery_date
  FROM orders
  UNION ALL
  SELECT cast(o_orderkey AS VARCHAR),
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE cast(o_custkey AS VARCHAR) END,
         o_orderstatus,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate + INTERVAL 1 DAY, {TS}) END,
         NULL, NULL, NULL, NULL
  FROM orders WHERE o_orderkey % 50 = 0
),
b_order_items AS (
  SELECT cast(l_orderkey AS VARCHAR) AS order_id,
         cast(l_linenumber AS INTEGER) AS order_item_id,
         cast(l_partkey AS VARCHAR) AS product_id,
         cast(l_suppkey AS VARCHAR) AS seller_id,
         strftime(l_shipdate, {TS}) AS shipping_limit_date,
         l_extendedprice AS price,
         cast(round(cast(l_extendedprice AS DECIMAL(18,2)) * cast(l_tax AS DECIMAL(18,2)), 2) AS DOUBLE)
           AS freight_value
  FROM lineitem
),
b_order_payments AS (
  SELECT cast(event_id // 2 AS VARCHAR) AS order_id,
         CASE WHEN event_id % 11 = 0 THEN NULL WHEN (event_id // 2) % 13 = 0 THEN 1
              ELSE cast(event_id % 2 + 1 AS INTEGER) END AS payment_sequential,
         CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS payment_type,
         cast(event_id % 12 + 1 AS INTEGER) AS payment_installments,
         value + cast(event_id % 7 AS DOUBLE) * cast(0.001 AS DOUBLE) AS payment_value
  FROM events
),
b_order_reviews AS (
  SELECT cast(event_id AS VARCHAR) AS review_id,
         cast(event_id // 3 AS VARCHAR) AS order_id,
         cast(event_id % 5 + 1 AS INTEGER) AS review_score,
         cast(NULL AS VARCHAR) AS review_comment_title,
         props AS review_comment_message,
         strftime(ts, {TS}) AS review_creation_date,
         strftime(ts + INTERVAL 1 DAY, {TS}) AS review_answer_timestamp
  FROM events WHERE event_type = 'view'
),
b_customers AS (
  SELECT cast(c_custkey AS VARCHAR) AS customer_id,
         'cu' || cast(c_custkey AS VARCHAR) AS customer_unique_id,
         lpad(cast(c_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         '  ' || upper(c_name) || ' ' AS customer_city,
         n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT cast(c_custkey AS VARCHAR), 'cu' || cast(c_custkey AS VARCHAR),
         lpad(cast(c_custkey % 100000 AS VARCHAR), 5, '0'),
         ' ' || c_mktsegment || ' ', c_mktsegment
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 40 = 0
),
b_sellers AS (
  SELECT cast(s_suppkey AS VARCHAR) AS seller_id,
         lpad(cast(s_suppkey % 100000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
         '  ' || upper(s_name) || ' ' AS seller_city,
         n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT cast(s_suppkey AS VARCHAR), lpad(cast(s_suppkey % 100000 AS VARCHAR), 5, '0'),
         ' ' || n_name, substr(n_name, 1, 2)
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 40 = 0
),
b_products AS (
  SELECT cast(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE p_type END AS product_category_name,
         cast(length(p_name) AS INTEGER) AS product_name_length,
         cast(p_size * 10 AS INTEGER) AS product_description_length,
         cast(p_size % 5 AS INTEGER) AS product_photos_qty,
         p_retailprice AS product_weight_g,
         cast(p_size AS DOUBLE) AS product_length_cm,
         cast(p_size % 7 AS DOUBLE) AS product_height_cm,
         cast(p_size % 11 AS DOUBLE) AS product_width_cm
  FROM part
  UNION ALL
  SELECT cast(p_partkey AS VARCHAR), 'PROMO', cast(length(p_name) AS INTEGER),
         cast(p_size * 10 AS INTEGER), cast(p_size % 5 AS INTEGER), p_retailprice,
         cast(p_size AS DOUBLE), cast(p_size % 7 AS DOUBLE), cast(p_size % 11 AS DOUBLE)
  FROM part WHERE p_partkey % 40 = 0
),
b_category_translation AS (
  SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'STANDARD'
),
b_geolocation AS (
  SELECT p_brand AS geolocation_zip_code_prefix,
         p_retailprice AS geolocation_lat,
         cast(p_size AS DOUBLE) AS geolocation_lng,
         ' ' || upper(p_name) AS geolocation_city,
         p_type AS geolocation_state
  FROM part
),
o_ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY order_id
           ORDER BY try_cast(order_purchase_timestamp AS TIMESTAMP) ASC NULLS FIRST,
                    customer_id ASC NULLS FIRST, order_status ASC NULLS FIRST,
                    order_purchase_timestamp ASC NULLS FIRST, order_approved_at ASC NULLS FIRST,
                    order_delivered_carrier_date ASC NULLS FIRST,
                    order_delivered_customer_date ASC NULLS FIRST,
                    order_estimated_delivery_date ASC NULLS FIRST) AS rn
  FROM b_orders
),
o_valid AS (
  SELECT {ORDER_COLS} FROM o_ranked WHERE rn = 1 AND {COMPLETE}
),
o_quarantine AS (
  SELECT {ORDER_COLS}, coalesce({NULL_REASON}, 'duplicate') AS dq_reason
  FROM o_ranked WHERE NOT ({COMPLETE}) OR rn > 1
),
o_parsed AS (
  SELECT *, try_cast(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_ts,
            try_cast(order_approved_at AS TIMESTAMP) AS order_approved_ts,
            try_cast(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_ts,
            try_cast(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_ts,
            try_cast(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_ts
  FROM o_valid
),
items AS (
  SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value
  FROM (SELECT *, row_number() OVER (
          PARTITION BY order_id, order_item_id
          ORDER BY product_id ASC NULLS FIRST, seller_id ASC NULLS FIRST,
                   shipping_limit_date ASC NULLS FIRST, price ASC NULLS FIRST,
                   freight_value ASC NULLS FIRST) AS rn
        FROM b_order_items) WHERE rn = 1
),
pay AS (
  SELECT order_id,
         sum(payment_value) AS payment_value_total,
         (list(payment_type ORDER BY payment_sequential ASC NULLS LAST, payment_type)
            FILTER (WHERE payment_type IS NOT NULL))[1] AS payment_type_primary,
         cast(sum(payment_installments) AS BIGINT) AS payment_installments_total
  FROM b_order_payments GROUP BY order_id
),
rev AS (
  SELECT order_id, max(review_score) AS review_score,
         max(try_cast(review_creation_date AS TIMESTAMP)) AS review_creation_ts
  FROM b_order_reviews GROUP BY order_id
),
fact AS (
  SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
         i.price, i.freight_value, o.customer_id, o.order_status, o.order_purchase_ts,
         o.order_delivered_customer_ts, o.order_estimated_delivery_ts,
         p.payment_value_total, p.payment_type_primary, p.payment_installments_total,
         r.review_score, r.review_creation_ts,
         cast(o.order_purchase_ts AS DATE) AS order_date,
         cast(CASE WHEN o.order_delivered_customer_ts IS NULL THEN NULL
                   WHEN o.order_delivered_customer_ts > o.order_estimated_delivery_ts THEN 1
                   ELSE 0 END AS INTEGER) AS is_delayed
  FROM items i
  LEFT JOIN o_parsed o ON i.order_id = o.order_id
  LEFT JOIN pay p ON i.order_id = p.order_id
  LEFT JOIN rev r ON i.order_id = r.order_id
),
d_customers AS (
  SELECT customer_id, customer_unique_id, lower(trim(customer_city)) AS customer_city,
         customer_state, customer_zip_code_prefix
  FROM (SELECT *, row_number() OVER (
          PARTITION BY customer_id
          ORDER BY customer_unique_id ASC NULLS FIRST, customer_zip_code_prefix ASC NULLS FIRST,
                   customer_city ASC NULLS FIRST, customer_state ASC NULLS FIRST) AS rn
        FROM b_customers) WHERE rn = 1
),
d_sellers AS (
  SELECT seller_id, lower(trim(seller_city)) AS seller_city, seller_state, seller_zip_code_prefix
  FROM (SELECT *, row_number() OVER (
          PARTITION BY seller_id
          ORDER BY seller_zip_code_prefix ASC NULLS FIRST, seller_city ASC NULLS FIRST,
                   seller_state ASC NULLS FIRST) AS rn
        FROM b_sellers) WHERE rn = 1
),
d_translation AS (
  SELECT product_category_name, product_category_name_english
  FROM (SELECT *, row_number() OVER (
          PARTITION BY product_category_name
          ORDER BY product_category_name_english ASC NULLS FIRST) AS rn
        FROM b_category_translation) WHERE rn = 1
),
d_products AS (
  SELECT p.product_category_name, p.product_id, p.product_name_length,
         p.product_description_length, p.product_photos_qty, p.product_weight_g,
         p.product_length_cm, p.product_height_cm, p.product_width_cm,
         coalesce(t.product_category_name_english, 'unknown') AS product_category_name_en
  FROM (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
          PARTITION BY product_id
          ORDER BY product_category_name ASC NULLS FIRST, product_name_length ASC NULLS FIRST,
                   product_description_length ASC NULLS FIRST, product_photos_qty ASC NULLS FIRST,
                   product_weight_g ASC NULLS FIRST, product_length_cm ASC NULLS FIRST,
                   product_height_cm ASC NULLS FIRST, product_width_cm ASC NULLS FIRST) AS rn
        FROM b_products) WHERE rn = 1) p
  LEFT JOIN d_translation t ON p.product_category_name = t.product_category_name
),
enriched AS (
  SELECT f.*, c.customer_state, c.customer_city, p.product_category_name_en,
         s.seller_city, s.seller_state
  FROM fact f
  LEFT JOIN d_customers c ON f.customer_id = c.customer_id
  LEFT JOIN d_products p ON f.product_id = p.product_id
  LEFT JOIN d_sellers s ON f.seller_id = s.seller_id
)
"""

D_GEOLOCATION = """
SELECT geolocation_zip_code_prefix, lower(trim(geolocation_city)) AS geolocation_city,
       geolocation_state,
       cast(sum(cast(geolocation_lat AS DECIMAL(18,12))) AS DOUBLE) / count(geolocation_lat) AS avg_lat,
       cast(sum(cast(geolocation_lng AS DECIMAL(18,12))) AS DOUBLE) / count(geolocation_lng) AS avg_lng
FROM b_geolocation
GROUP BY geolocation_zip_code_prefix, lower(trim(geolocation_city)), geolocation_state"""

WITH = "WITH " + CTES.strip() + "\n"

_BRONZE = ("customers", "geolocation", "order_items", "order_payments", "order_reviews", "orders",
           "products", "sellers", "category_translation")

_DOUBLES = {"price", "freight_value", "payment_value", "payment_value_total", "geolocation_lat", "geolocation_lng",
            "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm", "avg_lat", "avg_lng",
            "gmv", "freight_total", "avg_review_score", "delay_rate"}

# columns of the compared tables, from the registry and the models
_COLUMNS = {f"b_{t}": column_names(t) for t in _BRONZE} | {
    "o_valid": column_names("orders"),
    "o_quarantine": [*column_names("orders"), "dq_reason"],
    "d_customers": ["customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"],
    "d_sellers": ["seller_id", "seller_city", "seller_state", "seller_zip_code_prefix"],
    "d_products": [*column_names("products"), "product_category_name_en"],
    "d_geolocation": ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state", "avg_lat", "avg_lng"],
    "fact": FACT_COLUMNS,
    "mart_order_analytics": ANALYTICS_COLUMNS,
    "mart_daily_sales": ["order_date", "orders", "gmv", "freight_total", "avg_review_score", "delay_rate"],
    "mart_state_performance": ["customer_state", "orders", "gmv", "avg_review_score"],
    "mart_category_performance": ["product_category_name_en", "orders", "gmv", "avg_review_score"],
    "mart_order_status_daily": ["order_date", "order_status", "order_cnt", "gmv", "delay_rate"],
}


def _counts(label: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS {label}, count(*) AS row_count FROM b_{t}" for t in _BRONZE)


def _digest(label: str, table: str, source: str | None = None) -> str:
    """Rows, sum of row hashes and NULLs by column of a table of the model."""
    columns = sorted(_COLUMNS[table])

    def text(c: str) -> str:
        x = f"cast({c} AS VARCHAR)"
        if c in _DOUBLES:
            x = (f"CASE WHEN abs({c}) < 9e12 THEN cast(cast(floor({c} * 1000000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)"
                 f" AS VARCHAR) ELSE {x} END")
        return f"coalesce('=' || {x}, '-')"

    row = "concat_ws(chr(31), " + ", ".join(map(text, columns)) + ")"
    nulls = "concat_ws(',', " + ", ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns) + ")"
    return f"""
SELECT '{label}' AS table_name, count(*) AS row_count,
       coalesce(cast(sum(cast('0x' || substr(md5({row}), 1, 15) AS BIGINT)) AS VARCHAR), '0') AS row_digest,
       {nulls} AS null_counts
FROM {source or table}"""


def _digests(tables: dict[str, tuple]) -> str:
    return "\nUNION ALL\n".join(_digest(label, *of) for label, of in tables.items())


SELECTS: dict[str, str] = {
    "csv_explicit_scan": "SELECT * FROM b_orders",
    "csv_inferred_scan": """
SELECT cast(order_id AS INTEGER) AS order_id, payment_sequential, payment_type,
       payment_installments, payment_value
FROM b_order_payments""",
    "parquet_overwrite_roundtrip": "SELECT * FROM items",
    "bronze_ingest": _digests({t: (f"b_{t}",) for t in _BRONZE}),
    "landing_manifest": ("SELECT *, true AS files_counted, true AS keys_and_sizes_listed, cast(0 AS BIGINT) AS problems"
                         f" FROM ({_counts('dataset')})"),
    "landing_discovery": _counts("dataset"),
    "gate_tables": _digests({"stg_orders": ("o_valid",), "stg_orders_quarantine": ("o_quarantine",)}),
    "silver_tables": _digests({
        "dim_customers": ("d_customers",), "dim_sellers": ("d_sellers",), "dim_products": ("d_products",),
        "dim_geolocation": ("d_geolocation", f"({D_GEOLOCATION})"), "fct_order_items": ("fact",)}),
    "dq_ranked_orders": f"SELECT {ORDER_COLS}, cast(rn AS INTEGER) AS _row_num FROM o_ranked",
    "dq_null_violations": f"""
SELECT {ORDER_COLS}, {NULL_REASON} AS dq_reason FROM b_orders WHERE NOT ({COMPLETE})""",
    "dq_gate_valid": "SELECT * FROM o_valid",
    "dq_gate_quarantine": "SELECT * FROM o_quarantine",
    "dq_gate_summary": f"""
SELECT outcome, dq_reason, count(*) AS row_count
FROM (SELECT CASE WHEN rn = 1 AND {COMPLETE} THEN 'valid' ELSE 'quarantined' END AS outcome,
             CASE WHEN rn = 1 AND {COMPLETE} THEN NULL
                  ELSE coalesce({NULL_REASON}, 'duplicate') END AS dq_reason
      FROM o_ranked)
GROUP BY outcome, dq_reason""",
    "dedupe_items": "SELECT * FROM items",
    "orders_parsed": "SELECT * FROM o_parsed",
    "delivery_delay_flag": """
SELECT order_id, order_delivered_customer_ts, order_estimated_delivery_ts,
       cast(CASE WHEN order_delivered_customer_ts IS NULL THEN NULL
                 WHEN order_delivered_customer_ts > order_estimated_delivery_ts THEN 1
                 ELSE 0 END AS INTEGER) AS is_delayed
FROM o_parsed""",
    "dim_customers": "SELECT * FROM d_customers",
    "dim_sellers": "SELECT * FROM d_sellers",
    "dim_products": "SELECT * FROM d_products",
    "dim_geolocation": D_GEOLOCATION,
    "payments_per_order": "SELECT * FROM pay",
    "reviews_per_order": "SELECT * FROM rev",
    "fct_order_items": "SELECT * FROM fact",
    "fct_enriched": "SELECT * FROM enriched",
    "fct_enriched_colocated": "SELECT * FROM enriched",
    "mart_order_analytics": """
SELECT order_id, order_item_id, order_date, order_status, customer_state, customer_city,
       seller_state, seller_city, product_id, product_category_name_en, price, freight_value,
       payment_value_total, payment_type_primary, review_score, is_delayed
FROM enriched""",
    "mart_daily_sales": f"""
SELECT order_date, count(DISTINCT order_id) AS orders,
       {_cents('price')} AS gmv,
       {_cents('freight_value')} AS freight_total,
       {_half_up_mean('review_score', 100)} AS avg_review_score,
       {_half_up_mean('is_delayed', 10000)} AS delay_rate
FROM enriched GROUP BY order_date ORDER BY order_date NULLS FIRST""",
    "mart_state_performance": f"""
SELECT customer_state, count(DISTINCT order_id) AS orders,
       {_cents('price')} AS gmv,
       {_half_up_mean('review_score', 100)} AS avg_review_score
FROM enriched GROUP BY customer_state
ORDER BY gmv DESC NULLS LAST, customer_state NULLS FIRST""",
    "mart_category_performance": f"""
SELECT product_category_name_en, count(DISTINCT order_id) AS orders,
       {_cents('price')} AS gmv,
       {_half_up_mean('review_score', 100)} AS avg_review_score
FROM enriched GROUP BY product_category_name_en
ORDER BY gmv DESC NULLS LAST, product_category_name_en NULLS FIRST""",
    "mart_order_status_daily": f"""
SELECT order_date, order_status, count(DISTINCT order_id) AS order_cnt,
       {_cents('price')} AS gmv,
       {_half_up_mean('is_delayed', 10000)} AS delay_rate
FROM enriched GROUP BY order_date, order_status
ORDER BY order_date NULLS FIRST, order_status NULLS FIRST""",
}

_MARTS = ("mart_order_analytics", "mart_daily_sales", "mart_state_performance", "mart_category_performance",
          "mart_order_status_daily")
SELECTS["gold_tables"] = _digests({m: (m, f"({SELECTS[m]})") for m in _MARTS})
# run by run, the marts end up the same
SELECTS["gold_refreshed"] = SELECTS["gold_tables"]


def oracle_sql() -> dict[str, str]:
    return {name: WITH + body.strip() for name, body in SELECTS.items()}
