"""The gate over identified rows: the same rule in one pass, skew included."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators import quality
from tillroll.plans.queries import all_queries
from tillroll.sources.parquet import read_identified, read_table

import test_quality
from test_plans import optimized, physical
from test_quality import EARLIER, LATER, PATTERNS, SCHEMA, expected, version


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Write rows as Parquet; read them with and without identities."""
    def put(rows_or_df):
        path = str(tmp_path_factory.mktemp("orders") / "t")
        df = rows_or_df if hasattr(rows_or_df, "write") else spark.createDataFrame(rows_or_df, SCHEMA)
        df.write.parquet(path)
        return read_table(spark, path), read_identified(spark, path, quality.IDENTITY)
    return put


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_rule_over_all_null_patterns(stored):
    data = []
    for i, pattern in enumerate(PATTERNS):
        for twin in (None, EARLIER, LATER):
            data.append(version(pattern, f"k{i}{twin}"))
            if twin:
                data.append(version((False,) * 4, f"k{i}{twin}", twin))
    _, identified = stored(data)
    assert rows(quality.tag_orders(identified)) == expected(data)


def test_agrees_with_the_path_without_identities(stored):
    plain, identified = stored(test_quality.TestCoverAndCopies.ROWS * 3)
    assert rows(quality.tag_orders(identified)) == rows(quality.tag_orders(plain))
    assert rows(quality.valid_orders(plain)) == rows(quality.split_orders(identified)[0])
    assert rows(quality.gate_summary(identified)) == rows(quality.gate_summary(plain))
    _, none = stored([])
    assert quality.tag_orders(none).count() == quality.gate_summary(none).count() == 0


def test_identities_are_stable_and_unique(spark, stored):
    _, identified = stored(spark.range(5000).select(
        F.lit("k").alias("order_id"), *[F.lit("x").alias(c) for c in quality.REQUIRED_COLUMNS[1:]]).repartition(5))
    ids = [r[0] for r in identified.select(quality.IDENTITY).collect()]
    assert len(set(ids)) == 5000
    assert set(ids) == {r[0] for r in identified.select(quality.IDENTITY).collect()}
    assert quality.tag_orders(identified).filter("dq_reason IS NULL").count() == 1


def test_a_third_on_one_key_and_a_third_on_none(spark, stored):
    """The join deals the hot key's rows over several tasks, the NULL keys' too."""
    n = F.col("id")
    df = spark.range(30_000).select(
        F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.lit(None)).otherwise(F.floor(n / 6).cast("string")).alias("order_id"),
        F.lit("c").alias("customer_id"), F.lit("d").alias("order_status"),
        F.format_string("2017-01-%02d 00:00:00", (n % 28 + 1).cast("int")).alias("order_purchase_timestamp"))
    plain, identified = stored(df.repartition(8))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        tagged = quality.tag_orders(identified)
        got = tagged.groupBy("order_id", "dq_reason").count()
        assert rows(got) == rows(quality.tag_orders(plain).groupBy("order_id", "dq_reason").count())
        tagged.collect()
        assert "skew=true" in physical(tagged).split("Initial Plan")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_aggregation_of_whole_rows_and_no_expansion(spark, smoke_dir):
    plan = optimized(all_queries()["dq_gate_quarantine"](spark, smoke_dir))
    assert "Generate explode" not in plan and "RepartitionByExpression" not in plan
    grouped = [line for line in plan.split("\n") if "Aggregate [" in line]
    assert grouped and all(line.split("Aggregate [")[1].split("]")[0].count(",") == 0 for line in grouped)
