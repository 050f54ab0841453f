"""Order-independent digest of a table's whole content (K1-K4 checks).

One aggregation per table: the number of rows, the sum of the rows' hashes and
the NULLs of every column.  Sums do not depend on the order or the partitioning
of the rows, and partial sums are merged map-side, so a digest costs one row
per task however large the table; nothing is shuffled by key.

A row's text names its columns' values in the order of the column names, with
NULL told apart from every text; a double counts in millionths, half up, so
that the last digits of a sum do not decide.  Two tables with the same digest
hold the same rows, repeats included, but for a chance of about 2**-60.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

SEPARATOR = "\x1f"
#: Doubles from here on are taken as they are printed.
LARGE = 9e12


def value_text(name: str, kind: DataType) -> Column:
    """``=<value>``, or ``-`` for NULL."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (DoubleType, FloatType)):
        x = c.cast("double")
        text = F.when(F.abs(x) < LARGE, F.floor(x * 1000000.0 + 0.5).cast("string")).otherwise(x.cast("string"))
    else:
        text = c.cast("string")
    return F.coalesce(F.concat(F.lit("="), text), F.lit("-"))


def row_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """60 bits of the row's text."""
    columns = sorted(df.columns if columns is None else columns)
    text = F.concat_ws(SEPARATOR, *[value_text(c, df.schema[c].dataType) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_sum(h: Column) -> Column:
    """The sum of 60-bit numbers as text, "0" without any.

    Thirds of 20 bits are summed as longs, which overflow beyond 2**43 rows and
    are several times as fast as decimals; they are put together once.
    """
    thirds = [F.sum(F.shiftright(h, 20 * i).bitwiseAND(F.lit((1 << 20) - 1).cast("long"))) for i in range(3)]
    parts = [t.cast("decimal(19,0)") * F.lit(1 << 20 * i).cast("decimal(13,0)") for i, t in enumerate(thirds)]
    return F.coalesce((parts[0] + parts[1] + parts[2]).cast("string"), F.lit("0"))


def table_digest(df: DataFrame, name: str, exclude: Iterable[str] = ()) -> DataFrame:
    """One row: table_name, row_count, row_digest, null_counts (by column name).

    ``exclude`` names columns that differ between equal runs (a load time).
    An empty table has the digest 0.
    """
    columns = sorted(set(df.columns) - set(exclude))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        hash_sum(row_hash(df, columns)).alias("row_digest"),
        F.concat_ws(",", *[F.count_if(F.col(f"`{c}`").isNull()).cast("string") for c in columns]).alias("null_counts"),
    ).select(F.lit(name).alias("table_name"), "row_count", "row_digest", "null_counts")


def table_digests(tables: Mapping[str, DataFrame], exclude: Iterable[str] = ()) -> DataFrame:
    """``table_digest`` of each table, one row each."""
    return reduce(DataFrame.unionByName, [table_digest(df, name, exclude) for name, df in tables.items()])
