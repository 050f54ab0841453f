"""Retail bronze tables derived from the driver's TPC-H-style tables.

The test data ships ``orders``, ``lineitem``, ``customer`` ... but no retail
tables, and no NULLs, duplicate keys or junk timestamps.  This adapter maps
them onto the nine bronze tables and injects those defects by key
arithmetic, so every gate and fallback path is exercised and every derived
row still comes from — and grows with — the given tables.  The DuckDB
oracle (``tillroll.plans.oracle``) states the same mapping in SQL.

Timestamps are rendered as ``yyyy-MM-dd HH:mm:ss`` text, like the raw files.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.schemas import column_names
from tillroll.sources.parquet import row_identity, spread

TS_TEXT = "yyyy-MM-dd HH:mm:ss"


# Schemas of the driver tables (TESTDATA.md): given explicitly so a read is a
# file listing, not a footer-reading job per table.
DRIVER_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
              "props STRING",
}


def _text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a wall-clock timestamp, whole seconds.

    Cast, not ``date_format``: formatting goes through the session time
    zone, which could move a wall-clock midnight inside a DST gap.
    """
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, len(TS_TEXT))


def _days(ts: Column, n: Column | int) -> Column:
    return F.timestamp_add("DAY", n if isinstance(n, Column) else F.lit(n), ts)


def _hours(ts: Column, n: Column) -> Column:
    return F.timestamp_add("HOUR", n, ts)


def _s(c: Column) -> Column:
    return c.cast("string")


def _null() -> Column:
    return F.lit(None).cast("string")


@dataclass
class DriverTables:
    """Lazily loaded driver tables under ``sf_dir`` and the retail views."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def _scan(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in DRIVER_SCHEMAS:
            reader = reader.schema(DRIVER_SCHEMAS[name])
        return reader.parquet(self._path(name))

    def raw(self, name: str) -> DataFrame:
        """The table; the files have one row group each, so small ones are dealt
        over the cores."""
        if name not in self._cache:
            scan = self._scan(name)
            self._cache[name] = spread(scan, scan.columns[0])
        return self._cache[name]

    def _path(self, name: str) -> str:
        return f"{self.sf_dir.rstrip('/')}/{name}.parquet"

    # -- bronze views -------------------------------------------------------
    def orders(self, identity: str | None = None) -> DataFrame:
        """One row per driver order plus a second version of every 50th.

        customer_id NULL for keys divisible by 97; purchase text 'junk' for
        keys divisible by 101; no delivery while status is 'P'.  The second
        versions are one day later, or have no purchase time when the key is
        divisible by 3 (such a version outranks the original, see the gate).
        ``identity`` names one more column with the rows' identities.
        """
        o = self.raw("orders")
        if identity:
            # What is read of a file is only known right above its scan.
            o = spread(self._scan("orders").withColumn("_at", row_identity()), "o_orderkey")

        def version(number: int) -> list[Column]:
            return [F.struct("_at", F.lit(number).alias("version")).alias(identity)] if identity else []

        k = F.col("o_orderkey")
        d = F.col("o_orderdate")
        customer = F.when(k % 97 == 0, _null()).otherwise(_s(F.col("o_custkey")))
        pending = F.col("o_orderstatus") == "P"
        base = o.select(
            _s(k).alias("order_id"),
            customer.alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.when(k % 101 == 0, F.lit("junk")).otherwise(_text(d)).alias("order_purchase_timestamp"),
            _text(_hours(d, (k % 48).cast("int"))).alias("order_approved_at"),
            F.when(pending, _null()).otherwise(_text(_days(d, (k % 5 + 1).cast("int"))))
             .alias("order_delivered_carrier_date"),
            F.when(pending, _null()).otherwise(_text(_days(d, (k % 30).cast("int"))))
             .alias("order_delivered_customer_date"),
            _text(_days(d, 20)).alias("order_estimated_delivery_date"),
            *version(1),
        )
        again = o.filter(k % 50 == 0).select(
            _s(k).alias("order_id"),
            customer.alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.when(k % 3 == 0, _null()).otherwise(_text(_days(d, 1))).alias("order_purchase_timestamp"),
            _null().alias("order_approved_at"),
            _null().alias("order_delivered_carrier_date"),
            _null().alias("order_delivered_customer_date"),
            _null().alias("order_estimated_delivery_date"),
            *version(2),
        )
        return base.unionByName(again)

    def order_items(self) -> DataFrame:
        """Line items; (l_orderkey, l_linenumber) repeats, as duplicates do."""
        li = self.raw("lineitem")
        price = F.col("l_extendedprice")
        freight = F.round(price.cast("decimal(18,2)") * F.col("l_tax").cast("decimal(18,2)"), 2)
        return li.select(
            _s(F.col("l_orderkey")).alias("order_id"),
            F.col("l_linenumber").cast("int").alias("order_item_id"),
            _s(F.col("l_partkey")).alias("product_id"),
            _s(F.col("l_suppkey")).alias("seller_id"),
            _text(F.col("l_shipdate")).alias("shipping_limit_date"),
            price.alias("price"),
            freight.cast("double").alias("freight_value"),
        )

    def order_payments(self) -> DataFrame:
        """Two events per order id; 'error' events carry no payment type.

        Every 11th sequence is NULL, every 13th order has equal sequences, and
        amounts have a third decimal place.
        """
        ev = self.raw("events")
        e = F.col("event_id")
        return ev.select(
            _s(F.floor(e / 2)).alias("order_id"),
            F.when(e % 11 == 0, F.lit(None)).when(F.floor(e / 2) % 13 == 0, F.lit(1))
             .otherwise(e % 2 + 1).cast("int").alias("payment_sequential"),
            F.when(F.col("event_type") == "error", _null()).otherwise(F.col("event_type"))
             .alias("payment_type"),
            (e % 12 + 1).cast("int").alias("payment_installments"),
            (F.col("value") + (e % 7).cast("double") * F.lit(0.001)).alias("payment_value"),
        )

    def order_reviews(self) -> DataFrame:
        """'view' events as reviews, three event ids per order id."""
        ev = self.raw("events").filter(F.col("event_type") == "view")
        e = F.col("event_id")
        return ev.select(
            _s(e).alias("review_id"),
            _s(F.floor(e / 3)).alias("order_id"),
            (e % 5 + 1).cast("int").alias("review_score"),
            _null().alias("review_comment_title"),
            F.col("props").alias("review_comment_message"),
            _text(F.col("ts")).alias("review_creation_date"),
            _text(_days(F.col("ts"), 1)).alias("review_answer_timestamp"),
        )

    def customers(self) -> DataFrame:
        """Customers with their nation as state; every 40th key twice."""
        c = self.raw("customer").join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        k = F.col("c_custkey")
        cols = [
            _s(k).alias("customer_id"),
            F.concat(F.lit("cu"), _s(k)).alias("customer_unique_id"),
            F.lpad(_s(k % 100000), 5, "0").alias("customer_zip_code_prefix"),
        ]
        base = c.select(*cols,
                        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("customer_city"),
                        F.col("n_name").alias("customer_state"))
        again = c.filter(k % 40 == 0).select(
            *cols,
            F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("customer_city"),
            F.col("c_mktsegment").alias("customer_state"))
        return base.unionByName(again).select(*column_names("customers"))

    def sellers(self) -> DataFrame:
        """Suppliers with their nation as state; every 40th key twice."""
        s = self.raw("supplier").join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        k = F.col("s_suppkey")
        cols = [_s(k).alias("seller_id"), F.lpad(_s(k % 100000), 5, "0").alias("seller_zip_code_prefix")]
        base = s.select(*cols,
                        F.concat(F.lit("  "), F.upper("s_name"), F.lit(" ")).alias("seller_city"),
                        F.col("n_name").alias("seller_state"))
        again = s.filter(k % 40 == 0).select(
            *cols,
            F.concat(F.lit(" "), F.col("n_name")).alias("seller_city"),
            F.substring("n_name", 1, 2).alias("seller_state"))
        return base.unionByName(again).select(*column_names("sellers"))

    def products(self) -> DataFrame:
        """Parts; part type as category (NULL every 53rd); every 40th twice."""
        p = self.raw("part")
        k = F.col("p_partkey")
        size = F.col("p_size")

        def shape(category: Column) -> list[Column]:
            return [
                _s(k).alias("product_id"),
                category.alias("product_category_name"),
                F.length("p_name").cast("int").alias("product_name_length"),
                (size * 10).cast("int").alias("product_description_length"),
                (size % 5).cast("int").alias("product_photos_qty"),
                F.col("p_retailprice").alias("product_weight_g"),
                size.cast("double").alias("product_length_cm"),
                (size % 7).cast("double").alias("product_height_cm"),
                (size % 11).cast("double").alias("product_width_cm"),
            ]

        base = p.select(*shape(F.when(k % 53 == 0, _null()).otherwise(F.col("p_type"))))
        again = p.filter(k % 40 == 0).select(*shape(F.lit("PROMO")))
        return base.unionByName(again)

    def category_translation(self) -> DataFrame:
        """Every part type except 'STANDARD', translated to lower case."""
        return (self.raw("part").select("p_type").distinct()
                .filter(F.col("p_type") != "STANDARD")
                .select(F.col("p_type").alias("product_category_name"),
                        F.lower("p_type").alias("product_category_name_english")))

    def geolocation(self) -> DataFrame:
        """Parts as places: brand = zip prefix, part name = city, type = state."""
        p = self.raw("part")
        return p.select(
            F.col("p_brand").alias("geolocation_zip_code_prefix"),
            F.col("p_retailprice").alias("geolocation_lat"),
            F.col("p_size").cast("double").alias("geolocation_lng"),
            F.concat(F.lit(" "), F.upper("p_name")).alias("geolocation_city"),
            F.col("p_type").alias("geolocation_state"),
        )

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)().select(*column_names(name))

    def bronze(self) -> dict[str, DataFrame]:
        from tillroll.schemas import DATASET_FILES
        return {name: self.table(name) for name in DATASET_FILES}
