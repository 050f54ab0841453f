"""Parquet table scan (S6): vectorised, column-pruned, filter push-down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.sinks.files import size

#: Bytes of a table that is dealt anew: at most what one scan task may have anyway.
WORTH, SMALL = 1 << 20, 128 << 20


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame, by: str) -> DataFrame:
    """The rows of a small table, dealt by ``by`` over all cores.

    A file with one row group is one task, whatever is computed from it.  Only a
    table of fewer files than cores and of ``WORTH`` to ``SMALL`` bytes, by the
    file listing, is dealt anew: there the shuffle is cheaper than idle cores.
    Any other is returned as it is.
    """
    sc = df.sparkSession.sparkContext
    files = df.inputFiles()
    if not 0 < len(files) < sc.defaultParallelism:
        return df
    if not WORTH <= sum(size(df.sparkSession, f) for f in files) <= SMALL:
        return df
    return df.repartition(sc.defaultParallelism, by)


def row_identity() -> Column:
    """A Parquet row's file and place in it: the same in every evaluation of a
    scan of files that are not rewritten meanwhile."""
    return F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def read_identified(spark: SparkSession, path: str, name: str = "_row") -> DataFrame:
    """The table with its rows' identities in one more column."""
    return read_table(spark, path).withColumn(name, row_identity())
