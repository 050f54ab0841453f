"""Left join to a table that is unique per key, whatever the key's spread.

Adaptive execution splits a skewed join only where both inputs are shuffles
that the join itself asked for.  A de-duplicated or aggregated side keeps its
aggregation's partitioning, so the join would reuse that and could not be
split.  ``fresh_key`` is an expression the optimizer does not identify with
the column, so the join deals both sides anew; Spark still broadcasts the
smaller side when its size allows.

Rows of the left side without a key match nothing, but as one hash partition
they would all meet in one task: they get a key of their own, made of
``spread_by``, that no key of the right side can equal.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# a character that no key starts with
NO_KEY = "\x00"

#: Keys share a hash class; those of one with more than HOT rows are kept apart.
CLASSES, HOT = 1 << 16, 1 << 20


def key_class(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(CLASSES))


def hot_classes(df: DataFrame, key: str, hot: int = HOT) -> DataFrame:
    """The classes of more than ``hot`` rows, fewer than rows / ``hot``: a third of
    the rows without a key count as one key, too."""
    counts = df.groupBy(key_class(key).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > hot).select("class")


def fresh_key(c: Column) -> Column:
    return F.concat(F.lit(""), c)


def left_join_unique(fact: DataFrame, dim: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """``fact`` with the columns of ``dim``; keys are strings, unique in ``dim``."""
    own = F.concat(F.lit(NO_KEY), F.xxhash64(*spread_by).cast("string"))
    left = fact.withColumn("_key", F.coalesce(F.col(key), own))
    right = dim.select(fresh_key(F.col(key)).alias("_key"), *[c for c in dim.columns if c != key])
    return left.join(right, on="_key", how="left").drop("_key")
