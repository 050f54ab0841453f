"""Arriving versions of keyed rows, one row kept per key (A1, A2 over a stream).

The batch de-duplication keeps the lowest row of every key in a total order.
That minimum can be kept as state: each micro-batch of newly landed files is
reduced to one row per key and task before the shuffle, the state store holds
the lowest row of every key seen so far, and a batch hands on the keys that
occur in it, with their lowest rows.  The order in which files arrive does not
matter, and state is one row per key, not per version.

Batches are written as ``<target>/batch=<number>``, replaced whole when a batch
is repeated after a failure, so a row is never counted twice.  A key's later
rows are never higher, so ``current`` needs no batch numbers: it takes the lowest
again.  ``compact`` folds the batches written so far into one.

State grows with the number of keys; on a cluster set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider, which
keeps it on disk.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillroll.operators.dedupe import keep_first
from tillroll.paths import LayerPaths
from tillroll.schemas import build_schema
from tillroll.sinks.files import children, remove, write_parquet
from tillroll.streaming.landing import arriving, stream_checkpoint


def versions_path(paths: LayerPaths, table: str) -> str:
    return paths.bronze(f"_versions/{table}")


def keep_lowest_versions(spark: SparkSession, paths: LayerPaths, table: str, keys: Sequence[str],
                         order: Sequence[str] | None = None, wait: bool = True) -> StreamingQuery:
    """Take in the CSV files of ``table`` that are new since the last call and
    keep the lowest row of every key (``keep_first``), NULL keys as one."""
    lowest = keep_first(arriving(spark, paths, table), keys, order)
    target = versions_path(paths, table)

    def put(rows: DataFrame, batch: int) -> None:
        write_parquet(rows, f"{target}/batch={batch}")

    query = (lowest.writeStream.outputMode("update").foreachBatch(put)
             .option("checkpointLocation", stream_checkpoint(paths, table) + "-versions")
             .trigger(availableNow=True).start())
    if wait:
        query.awaitTermination()
    return query


def _written(spark: SparkSession, paths: LayerPaths, table: str, batches: Sequence[str]) -> DataFrame:
    schema: StructType = build_schema(table)
    target = versions_path(paths, table)
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{target}/{b}" for b in batches])


def current(spark: SparkSession, paths: LayerPaths, table: str, keys: Sequence[str],
            order: Sequence[str] | None = None) -> DataFrame:
    """One row per key of all files taken in so far."""
    return keep_first(_written(spark, paths, table, children(spark, versions_path(paths, table))), keys, order)


def compact(spark: SparkSession, paths: LayerPaths, table: str, keys: Sequence[str],
            order: Sequence[str] | None = None) -> None:
    """Fold all written batches into one row per key; not while the stream runs.

    The folded rows are put in place before the batches go; a compaction that
    dies in between leaves rows that ``current`` takes the lowest of as before.
    """
    target = versions_path(paths, table)
    batches = children(spark, target)
    numbers = [int(b.partition("=")[2].partition("-")[0]) for b in batches]
    folded = f"batch={max(numbers, default=0)}-folded-{len(batches)}"
    write_parquet(keep_first(_written(spark, paths, table, batches), keys, order), f"{target}/{folded}")
    for b in batches:
        if b != folded:
            remove(spark, f"{target}/{b}")
