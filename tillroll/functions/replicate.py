"""Expand ``(row, count)`` pairs back into ``count`` identical rows.

Used where identical copies were collapsed before a shuffle (the DQ gate).
A count can be huge: a replayed batch may be a third of the table.  Counts
are cut twice, into runs of ``chunk * chunk`` copies and these into chunks,
and the chunks are spread over the cluster by a hash exchange before the
last expansion, so no task holds more than a chunk of a group and no array
is longer than ``chunk`` for up to ``chunk ** 3`` copies.

With ``index_col`` every copy also gets its position ``1..count``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_CHUNK = 4096


def _numbers(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first.cast("long"), last.cast("long")))


def replicate_rows(df: DataFrame, count_col: str, chunk: int = DEFAULT_CHUNK,
                   index_col: str | None = None) -> DataFrame:
    cols = [c for c in df.columns if c != count_col]
    idx = index_col or "_i"
    n = F.col("_n")
    runs = (df.filter(F.col(count_col) > 0)
              .select(*cols, F.col(count_col).cast("long").alias("_n"))
              .select(*cols, n, _numbers(F.lit(0), F.floor((n - 1) / (chunk * chunk))).alias("_run")))
    chunks = runs.select(*cols, n, _numbers(
        F.col("_run") * chunk,
        F.least(F.col("_run") * chunk + chunk - 1, F.floor((n - 1) / chunk))).alias("_c"))
    out = chunks.repartition(*cols, "_c").select(*cols, _numbers(
        F.col("_c") * chunk + 1, F.least((F.col("_c") + 1) * chunk, n)).alias(idx))
    return out if index_col else out.drop(idx)
