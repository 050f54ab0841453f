"""Left join to a unique table: same rows as a plain join, hot and missing keys
dealt over many tasks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators.joins import left_join_unique


@pytest.fixture(scope="module")
def sides(spark):
    """3,000 rows: a third on one key, a third without a key."""
    n = F.col("id")
    fact = spark.range(3000).select(
        n.cast("string").alias("order_id"), (n % 3).cast("int").alias("order_item_id"),
        F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.lit(None)).otherwise(n.cast("string")).alias("customer_id"))
    dim = spark.range(3000).select(F.col("id").cast("string").alias("customer_id"), F.lit("x").alias("customer_state"))
    dim = dim.unionByName(spark.createDataFrame([("hot", "h"), (None, "never")], "customer_id string, customer_state string"))
    return fact, dim.groupBy("customer_id").agg(F.min("customer_state").alias("customer_state"))


def rows(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_same_rows_as_plain_join(sides):
    fact, dim = sides
    got = left_join_unique(fact, dim, "customer_id", ["order_id", "order_item_id"])
    assert rows(got) == rows(fact.join(dim, "customer_id", "left"))


def test_hot_and_missing_keys_are_split(spark, sides):
    fact, dim = sides
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = left_join_unique(fact.repartition(16), dim, "customer_id", ["order_id", "order_item_id"])
        out.write.format("noop").mode("overwrite").save()
        missing = out.where("customer_id IS NULL").groupBy(F.spark_partition_id().alias("p")).count().collect()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        assert len(missing) > 4
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
