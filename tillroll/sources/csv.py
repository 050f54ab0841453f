"""Raw CSV scan.

A registered table is read with its explicit schema: no inference pass over
the files, keys stay strings, unparseable numbers become NULL (permissive
mode).  Binding is positional, as with any CSV schema.  An unknown or empty
table name falls back to header + schema inference (one extra pass).

Quotes inside quoted fields are doubled (RFC 4180), as this library writes
them, in every table.  Free-text tables (``MULTILINE_TABLES``) are also read
with ``multiLine``, so a quoted newline stays inside its field; such files
cannot be split, so every other table keeps the splittable line reader.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from tillroll.schemas import MULTILINE_TABLES, build_schema

log = logging.getLogger(__name__)


def read_raw_csv(spark: SparkSession, path: str, table: str = "") -> DataFrame:
    schema = build_schema(table)
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        log.info("reading %s with explicit schema (%d fields)", path, len(schema))
        reader = reader.schema(schema)
    else:
        log.warning("no explicit schema for table %r, inferring from %s", table, path)
        reader = reader.option("inferSchema", True)
    if table in MULTILINE_TABLES:
        reader = reader.option("multiLine", True)
    return reader.csv(path)
