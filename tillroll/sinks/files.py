"""Parquet and CSV writers.

Both are plain distributed writes through Spark's committer: a failed or
retried task never leaves partial files in the target, and a lost executor
only re-runs its tasks.
"""

from __future__ import annotations

import logging
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

#: Of written tables: a third less to write and read than Spark's default.
CODEC = "zstd"
#: Columns with about as many values as rows: building a dictionary of theirs,
#: which is then given up, takes a third of the time of writing a wide row.
MANY_VALUES = ("order_id", "customer_id", "customer_unique_id", "product_id", "review_id", "order_number",
               "price", "freight_value", "payment_value", "payment_value_total")
WRITE_OPTIONS = {"compression": CODEC} | {f"parquet.enable.dictionary#{c}": "false" for c in MANY_VALUES}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> None:
    """Write ``df`` as Parquet; overwrite replaces the whole folder by default."""
    writer = df.write.mode(mode).options(**WRITE_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    log.info("written %s (mode=%s)", path, mode)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write raw-style CSV: header, RFC-4180 quotes, blanks kept as they are."""
    (df.write.mode(mode)
       .option("header", True)
       .option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False)
       .csv(path))
    log.info("written %s (csv, mode=%s)", path, mode)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them, so that any store works."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def holds_file(spark: SparkSession, path: str, ending: str) -> bool:
    """Whether any visible file below a folder has that ending."""
    fs, p = _hadoop(spark, path)
    files = fs.listFiles(p, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if name.endswith(ending) and not name.startswith((".", "_")):
            return True
    return False


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file."""
    fs, p = _hadoop(spark, path)
    return fs.getFileStatus(p).getLen()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the warehouse with all below it; none is no error."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place whole: written under another name, renamed."""
    fs, p = _hadoop(spark, path)
    half = spark._jvm.org.apache.hadoop.fs.Path(path + ".half")
    stream = fs.create(half, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    fs.delete(p, False)
    if not fs.rename(half, p):
        raise OSError(f"could not put {path} in place")
