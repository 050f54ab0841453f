"""The layered pipeline (K1-K5): the only module that writes tables.

Stages hand over through tables in shared storage (``LayerPaths``), as
separate jobs would; a stage failure stops the run.  Instead of caching the
enriched fact on executors (lost with them), the gold stage writes the wide
analytics mart once and derives the four aggregate marts from that table:
the three dimension joins run once and lineage is cut at a durable table.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.operators import dims, facts, marts, quality
from tillroll.operators.joins import hot_classes
from tillroll.paths import LayerPaths
from tillroll.schemas import DATASET_FILES, build_schema
from tillroll.session import scratch_path
from tillroll.sinks.files import write_parquet
from tillroll.sources.csv import read_raw_csv
from tillroll.sources.parquet import read_identified, read_table

log = logging.getLogger(__name__)

SILVER_TABLES = ("dim_customers", "dim_sellers", "dim_products", "dim_geolocation",
                 "fct_order_items")
GOLD_MARTS = ("mart_daily_sales", "mart_state_performance", "mart_category_performance",
              "mart_order_status_daily")


DEFAULT_CONCURRENT_JOBS = 4


def write_all(writes: Mapping[str, Callable[[], None]], concurrent_jobs: int) -> list[str]:
    """Run independent table writes as concurrent Spark jobs.

    Each write is its own distributed job; submitting a few at once keeps
    the executors busy while one job waits on its last stragglers.  The
    first failure is raised once every submitted write has finished.
    """
    if concurrent_jobs <= 1:
        for write in writes.values():
            write()
        return list(writes)
    with ThreadPoolExecutor(max_workers=concurrent_jobs) as pool:
        futures = [pool.submit(write) for write in writes.values()]
        for f in futures:
            f.result()
    return list(writes)


def bronze_ingest(spark: SparkSession, paths: LayerPaths,
                  datasets: Mapping[str, str] = DATASET_FILES,
                  concurrent_jobs: int = DEFAULT_CONCURRENT_JOBS) -> list[str]:
    """Raw CSV -> bronze Parquet, one write per registered table."""
    def ingest(table: str, filename: str) -> Callable[[], None]:
        def run() -> None:
            log.info("ingesting %s from %s", table, paths.raw(filename))
            write_parquet(read_raw_csv(spark, paths.raw(filename), table), paths.bronze(table))
        return run
    return write_all({t: ingest(t, f) for t, f in datasets.items()}, concurrent_jobs)


def _hot(rows: DataFrame) -> list[int]:
    """The hash classes of orders with very many of these rows: a stage may count
    before it plans.  Fewer than rows / ``HOT`` come to the driver."""
    return [r["class"] for r in hot_classes(rows, "order_id").collect()]


VALID, QUARANTINE = "stg_orders", "stg_orders_quarantine"


def orders_gate(spark: SparkSession, paths: LayerPaths) -> dict[str, int]:
    """Bronze orders -> ``stg_orders`` and ``stg_orders_quarantine`` (K2, V8).

    The orders are tagged once, into a table of the shared scratch folder;
    the two tables are written from that.  Counts are observed during the
    writes instead of by extra jobs.  Any of the tables may be empty.
    """
    orders = read_identified(spark, paths.bronze("orders"), quality.IDENTITY)
    quality.require_columns(orders)
    tagged = quality.tag_by_class(orders, _hot(orders))
    path = scratch_path(spark, "gate")
    write_parquet(tagged, path)
    tagged = spark.read.schema(tagged.schema).parquet(path)
    valid = F.col(quality.REASON).isNull()
    counts = {}
    for name, table, rows in (("valid", VALID, tagged.filter(valid).drop(quality.REASON)),
                              ("quarantined", QUARANTINE, tagged.filter(~valid))):
        seen = Observation(name)
        write_parquet(rows.observe(seen, F.count(F.lit(1)).alias("n")), paths.silver(table))
        counts[name] = seen.get["n"] or 0
    log.info("valid rows: %d | quarantined: %d", counts["valid"], counts["quarantined"])
    if counts["quarantined"]:
        log.warning("%d rows sent to quarantine", counts["quarantined"])
    return counts


def _orders_schema() -> StructType:
    return build_schema("orders")


def stg_orders(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    """Valid orders, bronze schema."""
    return spark.read.schema(_orders_schema()).parquet(paths.silver(VALID))


def stg_orders_quarantine(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    """Quarantined orders with their ``dq_reason``."""
    schema = StructType([*_orders_schema(), StructField(quality.REASON, StringType())])
    return spark.read.schema(schema).parquet(paths.silver(QUARANTINE))


def silver_model(spark: SparkSession, paths: LayerPaths,
                 concurrent_jobs: int = DEFAULT_CONCURRENT_JOBS) -> dict[str, DataFrame]:
    """Bronze + ``stg_orders`` -> four dimensions and the fact (K3)."""
    b = {t: read_table(spark, paths.bronze(t)) for t in DATASET_FILES}
    stg = stg_orders(spark, paths)
    classes = _hot(b["order_items"])
    out = {
        "dim_customers": dims.dim_customers(b["customers"]),
        "dim_sellers": dims.dim_sellers(b["sellers"]),
        "dim_products": dims.dim_products(b["products"], b["category_translation"]),
        "dim_geolocation": dims.dim_geolocation(b["geolocation"]),
        "fct_order_items": facts.fct_order_items(b["order_items"], stg, b["order_payments"],
                                                 b["order_reviews"], classes=classes),
    }
    write_all({name: (lambda df=df, name=name: write_parquet(df, paths.silver(name)))
               for name, df in out.items()}, concurrent_jobs)
    return out


def gold_marts(spark: SparkSession, paths: LayerPaths,
               concurrent_jobs: int = DEFAULT_CONCURRENT_JOBS) -> list[str]:
    """Silver -> wide analytics mart -> four aggregate marts (K4)."""
    s = {t: read_table(spark, paths.silver(t)) for t in SILVER_TABLES}
    enriched = marts.fct_enriched(s["fct_order_items"], s["dim_customers"], s["dim_products"],
                                  s["dim_sellers"])
    write_parquet(marts.mart_order_analytics(enriched), paths.gold("mart_order_analytics"))
    wide = read_table(spark, paths.gold("mart_order_analytics"))
    builders = {
        "mart_daily_sales": marts.mart_daily_sales,
        "mart_state_performance": marts.mart_state_performance,
        "mart_category_performance": marts.mart_category_performance,
        "mart_order_status_daily": marts.mart_order_status_daily,
    }
    write_all({name: (lambda name=name: write_parquet(builders[name](wide, stored=True), paths.gold(name)))
               for name in GOLD_MARTS}, concurrent_jobs)
    return ["mart_order_analytics", *GOLD_MARTS]


def stages(spark: SparkSession, paths: LayerPaths,
           concurrent_jobs: int = DEFAULT_CONCURRENT_JOBS) -> dict[str, Callable[[], object]]:
    """The stages in order; each returns its report (names or counts)."""
    return {
        "bronze": lambda: bronze_ingest(spark, paths, concurrent_jobs=concurrent_jobs),
        "gate": lambda: orders_gate(spark, paths),
        "silver": lambda: list(silver_model(spark, paths, concurrent_jobs)),
        "gold": lambda: gold_marts(spark, paths, concurrent_jobs),
    }


def run_pipeline(spark: SparkSession, paths: LayerPaths,
                 concurrent_jobs: int = DEFAULT_CONCURRENT_JOBS) -> dict[str, object]:
    """Bronze -> gate -> silver -> gold, stopping at the first failure (K5)."""
    return {name: run() for name, run in stages(spark, paths, concurrent_jobs).items()}
