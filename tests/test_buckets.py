"""Bucketed layouts: same rows as a plain join, no shuffle, hot keys apart."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.plans.oracle import oracle_sql
from tillroll.plans.queries import all_queries
from tillroll.sinks.buckets import FREQUENT, Layout, frequent_keys, join_layouts, write_layout

BUCKETS = 16


def rows(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


def physical(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    """6,000 rows: a third on one customer, a third without one, some unknown."""
    n = F.col("id")
    fact = spark.range(6000).select(
        n.cast("string").alias("order_id"),
        F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.lit(None)).otherwise((n % 900).cast("string")).alias("customer_id"),
        (n * 1.5).alias("price"))
    dim = spark.range(800).select(n.cast("string").alias("customer_id"), (n % 27).cast("string").alias("customer_state"))
    dim = dim.unionByName(spark.createDataFrame([("hot", "SP")], dim.schema))
    root = str(tmp_path_factory.mktemp("layouts"))
    return (fact, dim, write_layout(fact, root + "/fact", "customer_id", BUCKETS),
            write_layout(dim, root + "/dim/", "customer_id", BUCKETS))


def test_same_rows_as_a_plain_join(spark, sides):
    fact, dim, near, by = sides
    assert rows(join_layouts(spark, near, by)) == rows(fact.join(dim, "customer_id", "left"))
    assert rows(near.whole(spark)) == rows(fact) and rows(by.whole(spark)) == rows(dim)


def test_neither_side_of_the_near_join_is_shuffled(spark, sides):
    _, _, fact, dim = sides
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        near = physical(fact.near(spark).join(dim.near(spark), "customer_id", "left"))
        assert "SortMergeJoin" in near and "Exchange" not in near
        whole = physical(join_layouts(spark, fact, dim))
        assert "Exchange hashpartitioning" not in whole
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_and_missing_keys_lie_apart(spark, sides):
    fact_rows, dim_rows, fact, dim = sides
    assert [r[0] for r in fact.frequent(spark).collect()] == ["hot"]
    assert rows(fact.far(spark).groupBy("customer_id").count()) == Counter({(2000, None): 1, (2000, "hot"): 1})
    files = fact.near(spark).groupBy(F.input_file_name()).count().collect()
    assert len(files) <= BUCKETS and max(r["count"] for r in files) < FREQUENT * 6000 / BUCKETS
    assert dim.frequent(spark).count() == dim.far(spark).count() == 0


def test_frequent_keys_are_few_whatever_the_data(spark):
    even = spark.range(1000).select((F.col("id") % 8).cast("string").alias("k"))
    for buckets in (1, 4, 16, 64, 1000):
        assert frequent_keys(even, "k", buckets).count() <= buckets / FREQUENT


def test_a_later_session_reads_the_folder(spark, sides):
    """The table of a folder is named in the catalog when it is read."""
    fact_rows, _, fact, _ = sides
    spark.sql(f"DROP TABLE IF EXISTS {fact._table()}")
    again = Layout(fact.path, fact.key, fact.buckets, fact.schema)
    assert rows(again.whole(spark)) == rows(fact_rows)


def test_written_again_and_empty(spark, sides, tmp_path):
    fact, _, _, dim = sides
    path = str(tmp_path / "t")
    write_layout(fact, path, "customer_id", BUCKETS)
    empty = write_layout(fact.limit(0), path, "customer_id", BUCKETS)
    assert empty.whole(spark).count() == join_layouts(spark, empty, dim).count() == 0
    with pytest.raises(ValueError, match="layouts differ"):
        join_layouts(spark, write_layout(fact, path, "customer_id", 4), dim)


def test_query_is_checked_against_the_same_sql():
    assert "fct_enriched_colocated" in all_queries()
    assert oracle_sql()["fct_enriched_colocated"] == oracle_sql()["fct_enriched"]
