"""Helpers the operators share: reading tables, cutting lineage, shipping code."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.session import scratch_path

#: Spark's setting to remove a query's shuffle files when it has ended.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    The folder is under the session's ``spark.checkpoint.dir``, so a lost
    executor loses nothing that was already written; the write's own shuffle
    files are of no more use and are removed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(REMOVE_SHUFFLES)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_tillroll_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tillroll-code-"), "tillroll_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tillroll", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._tillroll_shipped = True


#: glibc's numbers of two settings of its allocator: free memory kept at the
#: top, and the size from which a block is mapped, and so given back, on its own.
_TRIM, _MAP = -1, -3


#: What this worker remembers between tasks: by owner, how to forget it.
HELD: dict[str, Callable[[], None]] = {}


def map_large_blocks() -> None:
    """From now on this process gives large blocks back when they are freed."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(_MAP, 1 << 18)
        libc.mallopt(_TRIM, 1 << 20)
        pa.set_memory_pool(pa.system_memory_pool())


def give_back() -> None:
    """Give the memory that this process does not use back to the system."""
    libc = ctypes.CDLL(None)
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def lean(run: Callable, owner: str = "") -> Callable:
    """A function for mapInArrow that keeps little memory: large blocks go back
    to the system when they are freed, the rest when the task ends, and what
    tasks of another owner remember is forgotten.  Workers live on between
    tasks, so else each keeps the most that any of its tasks took, beside an
    executor's heap."""
    def task(batches):
        from tillroll.llm import common     # the worker's own, not a copy sent along
        for name in [n for n in common.HELD if n != owner]:
            common.HELD.pop(name)()
        common.map_large_blocks()
        try:
            yield from run(batches)
        finally:
            common.give_back()
    return task


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def by_size(spark: SparkSession) -> int:
    """Number of partitions for a shuffle this library deals itself."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
