"""Bronze ingest as an incremental file stream (S8, delivered incrementally).

The batch ingest rewrites every bronze table from the whole landing folder.
When raw files keep arriving, the same schema-enforced read can run as a
Structured Streaming file source with ``Trigger.AvailableNow``: each run
picks up only files not seen before, appends them to bronze Parquet, and
records progress in a checkpoint folder beside the bronze tables, so the next
run, of this or another application, continues, and one that
dies (or loses executors) restarts where it stopped with exactly-once file
output.  No state, watermark or window is involved: the reference has no
streaming semantics, only files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.paths import LayerPaths
from tillroll.schemas import DATASET_FILES, MULTILINE_TABLES, build_schema


def stream_checkpoint(paths: LayerPaths, table: str) -> str:
    """Progress folder of a table's stream: beside its bronze folder, and so
    the same for every application that continues the ingest."""
    return paths.bronze(f"_streams/{table}")


def arriving(spark: SparkSession, paths: LayerPaths, table: str) -> DataFrame:
    """Stream of the rows of ``table`` in newly landed CSV files."""
    schema = build_schema(table)
    if schema is None:
        raise ValueError(f"streaming ingest needs a registered schema; {table!r} has none")
    reader = spark.readStream.schema(schema).option("header", True).option("escape", '"')
    if table in MULTILINE_TABLES:
        reader = reader.option("multiLine", True)
    return reader.csv(paths.raw(DATASET_FILES[table]))


def ingest_incrementally(spark: SparkSession, paths: LayerPaths, table: str,
                         checkpoint: str | None = None, wait: bool = True) -> StreamingQuery:
    """Append newly landed CSV files of ``table`` to its bronze folder."""
    source = arriving(spark, paths, table)
    checkpoint = checkpoint or stream_checkpoint(paths, table)
    query = (source.writeStream.format("parquet")
             .option("checkpointLocation", checkpoint)
             .option("path", paths.bronze(table))
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
    if wait:
        query.awaitTermination()
    return query
