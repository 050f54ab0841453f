"""Keyed de-duplication with a deterministic survivor (A1, A2).

``dropDuplicates`` keeps an arbitrary row per key; here the survivor is the
lowest row in a total order (given columns, else every non-key column,
ascending, NULLs first), so reruns and repartitionings agree.

It is an aggregation — ``min`` of the row as a struct, compared field by
field — rather than a ``row_number()`` window, for two reasons:

* it aggregates map-side before the shuffle, so a key holding a third of the
  rows crosses the network as one row per map task;
* the result is known to the optimizer as unique per key, so a left join to
  it whose columns a query never uses is removed from the plan (a mart that
  needs no customer attribute never joins, or even builds, the customers).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    keys = list(keys)
    ties = list(order) if order is not None else [c for c in df.columns if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in ties]
    first = df.groupBy(*keys).agg(F.min(F.struct(*ties, *rest)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns])
