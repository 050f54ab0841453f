"""Registered queries: the whole silver/gold model over the driver tables.

Each query is ``(spark, sf_dir) -> DataFrame``: it derives the bronze tables
from the driver's Parquet files (``DriverTables``) and runs the operators
lazily.  ``tillroll.plans.oracle`` holds the equivalent DuckDB SQL.

Every call builds its own ``Model``, so a folder that changed is listed anew.
Source/sink queries write the
derived tables to a fresh folder under the session's shared checkpoint
directory and return what the operator reads back; ``dq_ranked_orders``
checkpoints once (see ``quality.rank_orders``).  Every query reads its
tables whole.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.operators import dims, facts, marts, quality
from tillroll.operators.digest import table_digests
from tillroll.paths import LayerPaths
from tillroll.plans import pipeline
from tillroll.plans.refresh import PERIOD, WIDE, refresh_gold
from tillroll.schemas import DATASET_FILES
from tillroll.session import scratch_path
from tillroll.sinks.buckets import write_layout
from tillroll.sinks.files import write_csv, write_parquet
from tillroll.sources.csv import read_raw_csv
from tillroll.sources.driver_tables import DriverTables
from tillroll.sources.landing import (
    compare_snapshots, discover_csv, land_tables, snapshot_run, verify_snapshot)
from tillroll.sources.parquet import read_table

Query = Callable[[SparkSession, str], DataFrame]


class Model:
    """Lazy silver/gold frames over one set of driver tables.

    Each frame is built once per model.  Only plans are shared — nothing is
    cached or materialised.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = DriverTables(spark, sf_dir)
        self._frames: dict[str, DataFrame] = {}

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = build()
        return self._frames[name]

    def bronze(self, name: str) -> DataFrame:
        return self._once("bronze:" + name, lambda: self.t.table(name))

    def orders_identified(self) -> DataFrame:
        return self.t.orders(quality.IDENTITY)

    def orders_valid(self) -> DataFrame:
        return self._once("orders_valid", lambda: quality.valid_orders(self.bronze("orders")))

    def fact(self, columns=facts.FACT_COLUMNS, customers=None) -> DataFrame:
        return facts.fct_order_items(
            self.bronze("order_items"), self.orders_valid(), self.bronze("order_payments"),
            self.bronze("order_reviews"), columns, customers)

    def dim_customers(self) -> DataFrame:
        return self._once("dim_customers", lambda: dims.dim_customers(self.bronze("customers")))

    def dim_sellers(self) -> DataFrame:
        return self._once("dim_sellers", lambda: dims.dim_sellers(self.bronze("sellers")))

    def dim_products(self) -> DataFrame:
        return self._once("dim_products", lambda: dims.dim_products(
            self.bronze("products"), self.bronze("category_translation")))

    def enriched(self, columns=None) -> DataFrame:
        # A customer is an order's: joined there, not once per item.
        own = [c for c in marts.CUSTOMER_COLUMNS if columns is None or c in columns]
        customers = self.dim_customers().select("customer_id", *own) if own else None
        fact = self.fact(facts.FACT_COLUMNS if columns is None else marts.fact_columns(columns), customers)
        return marts.fct_enriched(fact, None, self.dim_products(), self.dim_sellers(), columns)

    def mart(self, name: str) -> DataFrame:
        """An aggregate mart from just the sides and dimensions it reads."""
        return getattr(marts, name)(self.enriched(marts.MART_INPUTS[name]))


def model(spark: SparkSession, sf_dir: str) -> Model:
    return Model(spark, sf_dir)


def q_dq_null_violations(spark, d):
    return quality.null_violations(model(spark, d).bronze("orders"))


def q_dq_gate_valid(spark, d):
    return model(spark, d).orders_valid()


def q_dq_gate_quarantine(spark, d):
    return quality.quarantined_orders(model(spark, d).orders_identified())


def q_dq_gate_summary(spark, d):
    return quality.gate_summary(model(spark, d).orders_identified())


def q_dedupe_items(spark, d):
    return facts.dedupe_items(model(spark, d).bronze("order_items"))


def q_orders_parsed(spark, d):
    return facts.parse_orders(model(spark, d).orders_valid())


def q_delivery_delay_flag(spark, d):
    return facts.delivery_delay(facts.parse_orders(model(spark, d).orders_valid()))


def q_dim_customers(spark, d):
    return model(spark, d).dim_customers()


def q_dim_sellers(spark, d):
    return model(spark, d).dim_sellers()


def q_dim_products(spark, d):
    return model(spark, d).dim_products()


def q_dim_geolocation(spark, d):
    return dims.dim_geolocation(model(spark, d).bronze("geolocation"))


def q_payments_per_order(spark, d):
    return facts.payments_per_order(model(spark, d).bronze("order_payments"))


def q_reviews_per_order(spark, d):
    return facts.reviews_per_order(model(spark, d).bronze("order_reviews"))


def q_fct_order_items(spark, d):
    return model(spark, d).fact()


def q_fct_enriched(spark, d):
    return model(spark, d).enriched()


def q_fct_enriched_colocated(spark, d):
    """The same from tables that lie bucketed by customer."""
    m, root = model(spark, d), scratch_path(spark, "colocated")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layouts = []
    for name, df in (("fct_order_items", m.fact()), ("dim_customers", m.dim_customers().select(
            "customer_id", *marts.CUSTOMER_COLUMNS))):
        write_parquet(df, f"{root}/plain/{name}")
        layouts.append(write_layout(read_table(spark, f"{root}/plain/{name}"), f"{root}/{name}", "customer_id", buckets))
    return marts.fct_enriched_colocated(spark, *layouts, m.dim_products(), m.dim_sellers())


def q_mart_order_analytics(spark, d):
    return marts.mart_order_analytics(model(spark, d).enriched(marts.ANALYTICS_COLUMNS), with_load_time=False)


def q_mart_daily_sales(spark, d):
    return model(spark, d).mart("mart_daily_sales")


def q_mart_state_performance(spark, d):
    return model(spark, d).mart("mart_state_performance")


def q_mart_category_performance(spark, d):
    return model(spark, d).mart("mart_category_performance")


def q_mart_order_status_daily(spark, d):
    return model(spark, d).mart("mart_order_status_daily")


def q_dq_ranked_orders(spark, d):
    return quality.rank_orders(model(spark, d).bronze("orders"))


# -- sources and sinks: write derived tables to a scratch folder in shared
# storage (``spark.checkpoint.dir``), then read them back through the operator.

def q_csv_explicit_scan(spark, d):
    path = scratch_path(spark, "csv-explicit") + "/orders"
    write_csv(model(spark, d).bronze("orders"), path)
    return read_raw_csv(spark, path, "orders")


def q_csv_inferred_scan(spark, d):
    path = scratch_path(spark, "csv-inferred") + "/payments"
    write_csv(model(spark, d).bronze("order_payments"), path)
    return read_raw_csv(spark, path)


def q_parquet_overwrite_roundtrip(spark, d):
    t = DriverTables(spark, d)
    path = scratch_path(spark, "parquet-roundtrip") + "/items"
    write_parquet(t.table("order_items"), path)
    write_parquet(facts.dedupe_items(t.table("order_items")), path)
    return read_table(spark, path)


def _landed(spark, d, name) -> LayerPaths:
    """Land the driver-derived bronze tables as raw CSV in a scratch folder."""
    paths = LayerPaths.under(scratch_path(spark, name))
    land_tables(DriverTables(spark, d).bronze(), paths)
    return paths


def q_bronze_ingest(spark, d):
    """The content of all bronze tables as the ingest wrote them."""
    paths = _landed(spark, d, "bronze-ingest")
    tables = pipeline.bronze_ingest(spark, paths)
    return table_digests({t: read_table(spark, paths.bronze(t)) for t in tables})


def q_landing_manifest(spark, d):
    """By dataset: rows, whether the manifest's keys, sizes and file counts are
    those of the listing, and the problems found in the content of both copies."""
    paths, stamp = LayerPaths.under(scratch_path(spark, "landing")), "20240101T000000Z"
    man = snapshot_run(spark, DriverTables(spark, d).bronze(), paths, run_ts=stamp)
    listed = discover_csv(spark, paths.raw("", "latest").rstrip("/"), require=False).select(
        F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("key"), "length")
    by_file = man.join(listed, "key", "left").groupBy("dataset").agg(
        F.sum("row_count").cast("long").alias("row_count"),
        (F.count(F.lit(1)) == F.max("file_count")).alias("files_counted"),
        F.coalesce(F.bool_and(F.col("length") == F.col("size_bytes")) & (F.count("length") == F.count(F.lit(1))),
                   F.lit(False)).alias("keys_and_sizes_listed"))
    problems = reduce(DataFrame.unionByName, [
        verify_snapshot(spark, paths).select("dataset"),
        verify_snapshot(spark, paths, f"archive/run_ts={stamp}").select("dataset"),
        compare_snapshots(spark, paths, f"archive/run_ts={stamp}").select("dataset")])
    problems = problems.groupBy("dataset").agg(F.count(F.lit(1)).alias("problems"))
    return by_file.join(problems, "dataset", "left").select(
        "dataset", "row_count", "files_counted", "keys_and_sizes_listed",
        F.coalesce("problems", F.lit(0)).cast("long").alias("problems"))


def q_landing_discovery(spark, d):
    """Rows of every dataset that the listing finds, read through its paths."""
    paths = _landed(spark, d, "discovery")
    files = discover_csv(spark, paths.raw("", "latest").rstrip("/"))
    # One folder per registered dataset: at most nine rows.
    folders = files.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder")).distinct().collect()
    names = {file: name for name, file in DATASET_FILES.items()}
    counts = [read_raw_csv(spark, r["folder"], names[r["folder"].rpartition("/")[2]])
              .agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(names[r["folder"].rpartition("/")[2]]).alias("dataset"), "row_count")
              for r in sorted(folders)]
    return reduce(DataFrame.unionByName, counts)


def _built(spark, d, name) -> LayerPaths:
    """Bronze tables written from the driver tables, then the gate's tables."""
    paths = LayerPaths.under(scratch_path(spark, name))
    for table, df in DriverTables(spark, d).bronze().items():
        write_parquet(df, paths.bronze(table))
    pipeline.orders_gate(spark, paths)
    return paths


def q_gate_tables(spark, d):
    """The content of both tables that the gate wrote."""
    paths = _built(spark, d, "gate")
    return table_digests({pipeline.VALID: pipeline.stg_orders(spark, paths),
                          pipeline.QUARANTINE: pipeline.stg_orders_quarantine(spark, paths)})


def q_silver_tables(spark, d):
    """The content of all tables that the silver stage wrote."""
    paths = _built(spark, d, "silver")
    pipeline.silver_model(spark, paths)
    return table_digests({t: read_table(spark, paths.silver(t)) for t in pipeline.SILVER_TABLES})


def q_gold_tables(spark, d):
    """The content of all marts that the gold stage wrote, but for load times."""
    paths = _built(spark, d, "gold")
    pipeline.silver_model(spark, paths)
    written = pipeline.gold_marts(spark, paths)
    return table_digests({t: read_table(spark, paths.gold(t)) for t in written}, exclude=[marts.LOAD_TIME])


def q_gold_refreshed(spark, d):
    """The marts after two runs: the first without every tenth order's rows and
    without the orders' later versions, the second a refresh of what is new."""
    paths = LayerPaths.under(scratch_path(spark, "refresh"))
    tables = DriverTables(spark, d).bronze()
    # A cast, not ``try_to_number``, which takes 2.5 microseconds a row.
    tenth = F.coalesce(F.col("order_id").try_cast("long") % 10 == 0, F.lit(True))
    new = {t: tenth for t in ("order_items", "order_payments", "order_reviews")}
    new["orders"] = F.col("order_approved_at").isNull()
    for first in (True, False):
        # The second run brings the rows that the first one lacked; a table that
        # lacked none is written again.
        rows = {t: df.filter(~new[t] if first else new[t]) if t in new else df for t, df in tables.items()}
        mode = {t: "overwrite" if first or t not in new else "append" for t in rows}
        # The largest first, so that small ones fill the cores that it leaves.
        pipeline.write_all({t: (lambda t=t: write_parquet(rows[t], paths.bronze(t), mode[t]))
                            for t in sorted(rows, key=lambda t: t != "order_items")}, pipeline.DEFAULT_CONCURRENT_JOBS)
        pipeline.orders_gate(spark, paths)
        pipeline.silver_model(spark, paths)
        late = rows["orders"].select("order_id").unionByName(rows["order_items"].select("order_id"))
        refresh_gold(spark, paths, None if first else late)
    written = {t: read_table(spark, paths.gold(t)) for t in (WIDE, *pipeline.GOLD_MARTS)}
    return table_digests(written, exclude=[marts.LOAD_TIME, PERIOD])


QUERIES: dict[str, Query] = {
    "csv_explicit_scan": q_csv_explicit_scan,
    "csv_inferred_scan": q_csv_inferred_scan,
    "parquet_overwrite_roundtrip": q_parquet_overwrite_roundtrip,
    "bronze_ingest": q_bronze_ingest,
    "landing_manifest": q_landing_manifest,
    "landing_discovery": q_landing_discovery,
    "gate_tables": q_gate_tables,
    "silver_tables": q_silver_tables,
    "gold_tables": q_gold_tables,
    "gold_refreshed": q_gold_refreshed,
    "dq_ranked_orders": q_dq_ranked_orders,
    "dq_null_violations": q_dq_null_violations,
    "dq_gate_valid": q_dq_gate_valid,
    "dq_gate_quarantine": q_dq_gate_quarantine,
    "dq_gate_summary": q_dq_gate_summary,
    "dedupe_items": q_dedupe_items,
    "orders_parsed": q_orders_parsed,
    "delivery_delay_flag": q_delivery_delay_flag,
    "dim_customers": q_dim_customers,
    "dim_sellers": q_dim_sellers,
    "dim_products": q_dim_products,
    "dim_geolocation": q_dim_geolocation,
    "payments_per_order": q_payments_per_order,
    "reviews_per_order": q_reviews_per_order,
    "fct_order_items": q_fct_order_items,
    "fct_enriched": q_fct_enriched,
    "fct_enriched_colocated": q_fct_enriched_colocated,
    "mart_order_analytics": q_mart_order_analytics,
    "mart_daily_sales": q_mart_daily_sales,
    "mart_state_performance": q_mart_state_performance,
    "mart_category_performance": q_mart_category_performance,
    "mart_order_status_daily": q_mart_order_status_daily,
}


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)
