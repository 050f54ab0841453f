"""Tables laid out for a join (storage layout of J5-J7).

A fact and a dimension that are both bucketed by the join key, into the same
number of buckets, are joined where they lie: neither side is shuffled or
sorted again, however often the join runs.  Bucketing alone would put a key
with a third of all rows into one file and one task.  So rows of very frequent
keys, and rows without a key, are kept apart, as plain files; their side of the
dimension has fewer rows than there are buckets, and is broadcast.

A layout is a folder::

    <path>/near            bucketed by the key, one file a bucket
    <path>/far             rows of frequent keys and rows without a key
    <path>/frequent        those keys, at most buckets / FREQUENT of them

Spark keeps the bucketing of a table in its catalog; ``Layout.near`` names the
table there again in every session that reads the folder.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillroll.sinks.files import write_parquet

#: A key is frequent if it has this many times the rows of an even bucket.
FREQUENT = 4


@dataclass(frozen=True)
class Layout:
    """A bucketed table and its frequent keys' rows, below ``path``."""

    path: str
    key: str
    buckets: int
    schema: StructType

    def _table(self) -> str:
        name = "tillroll_" + hashlib.md5(f"{self.path}|{self.buckets}".encode()).hexdigest()
        return name

    def near(self, spark: SparkSession) -> DataFrame:
        """The bucketed rows, known to the optimizer as such."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self._table()} ({columns}) USING parquet "
                  f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}/near'")
        return spark.table(self._table())

    def far(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/far")

    def frequent(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(StructType([self.schema[self.key]])).parquet(f"{self.path}/frequent")

    def whole(self, spark: SparkSession) -> DataFrame:
        """All rows, without regard to the layout."""
        return self.near(spark).unionByName(self.far(spark))


def frequent_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Keys with more than FREQUENT / buckets of the rows: fewer than
    buckets / FREQUENT of them, whatever the data."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > FREQUENT * max(df.count() / buckets, 1)).select(key)


def write_layout(df: DataFrame, path: str, key: str, buckets: int) -> Layout:
    """Write ``df`` as a layout; an older one at ``path`` is replaced.

    ``df`` is read three times (total, frequent keys, rows): hand over a table,
    not an expensive plan.
    """
    spark = df.sparkSession
    layout = Layout(path.rstrip("/"), key, buckets, df.schema)
    write_parquet(frequent_keys(df, key, buckets), f"{layout.path}/frequent")
    frequent = F.broadcast(layout.frequent(spark))          # under buckets / FREQUENT keys
    known = df.filter(F.col(key).isNotNull())
    far = known.join(frequent, key, "left_semi").unionByName(df.filter(F.col(key).isNull()))
    write_parquet(far.select(df.columns), f"{layout.path}/far")
    # The shuffle deals rows as the buckets do, so a task writes one file.
    (known.join(frequent, key, "left_anti").select(df.columns).repartition(buckets, key)
          .write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
          .option("path", f"{layout.path}/near").format("parquet").saveAsTable(layout._table()))
    return layout


def join_layouts(spark: SparkSession, fact: Layout, dim: Layout) -> DataFrame:
    """``fact`` left join ``dim``, unique per key: near rows bucket by bucket,
    rows of frequent keys against their own few dimension rows."""
    if (fact.key, fact.buckets) != (dim.key, dim.buckets):
        raise ValueError(f"layouts differ: {fact.key} x {fact.buckets}, {dim.key} x {dim.buckets}")
    own = dim.whole(spark).join(F.broadcast(fact.frequent(spark)), fact.key, "left_semi")
    near = fact.near(spark).join(dim.near(spark), fact.key, "left")
    far = fact.far(spark).join(F.broadcast(own), fact.key, "left")
    return near.unionByName(far)
