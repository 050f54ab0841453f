"""Versions that arrive in files: state across batches equals the batch query."""

import itertools
import random
from collections import Counter

import pytest

from tillroll.operators.dedupe import keep_first
from tillroll.operators.dims import dim_sellers
from tillroll.paths import LayerPaths
from tillroll.schemas import DATASET_FILES, build_schema
from tillroll.sinks.files import children
from tillroll.streaming.versions import compact, current, keep_lowest_versions, versions_path

KEY = ["seller_id"]


def versions(seed):
    """Three files of sellers, keys in several of them, one on a third of all rows."""
    rng = random.Random(seed)
    return [[(rng.choice(["hot", f"s{rng.randrange(12)}", f"s{rng.randrange(12)}"]), f"{rng.randrange(100):05d}",
              rng.choice(["porto", " Lisboa ", None]), rng.choice(["PT", None])) for _ in range(40)] for _ in range(3)]


def land(spark, paths, rows):
    df = spark.createDataFrame(rows, build_schema("sellers"))
    (df.coalesce(1).write.mode("append").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(
        paths.raw(DATASET_FILES["sellers"])))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_any_order_of_batches_equals_the_batch_query(spark, tmp_path, order):
    paths, files = LayerPaths.under(str(tmp_path)), versions(1)
    for i in order:
        land(spark, paths, files[i])
        keep_lowest_versions(spark, paths, "sellers", KEY)
    whole = spark.createDataFrame(sum(files, []), build_schema("sellers"))
    assert rows(current(spark, paths, "sellers", KEY)) == rows(keep_first(whole, KEY))
    assert rows(dim_sellers(current(spark, paths, "sellers", KEY))) == rows(dim_sellers(whole))


def test_a_batch_hands_on_its_own_keys_only(spark, tmp_path):
    paths = LayerPaths.under(str(tmp_path))
    land(spark, paths, [("a", "5", "x", "PT"), ("b", "5", "x", "PT"), (None, "7", "x", "PT")])
    keep_lowest_versions(spark, paths, "sellers", KEY)
    land(spark, paths, [("a", "3", "x", "PT"), ("c", "1", "x", "PT")])
    keep_lowest_versions(spark, paths, "sellers", KEY)
    target = versions_path(paths, "sellers")
    second = spark.read.parquet(f"{target}/{children(spark, target)[-1]}")
    assert {r["seller_id"] for r in second.collect()} == {"a", "c"}
    assert {(r[0], r[1]) for r in current(spark, paths, "sellers", KEY).collect()} == {
        ("a", "3"), ("b", "5"), ("c", "1"), (None, "7")}


def test_a_repeated_batch_and_compaction_change_nothing(spark, tmp_path):
    paths, files = LayerPaths.under(str(tmp_path)), versions(2)
    assert current(spark, paths, "sellers", KEY).count() == 0
    for i, f in enumerate(files):
        land(spark, paths, f)
        keep_lowest_versions(spark, paths, "sellers", KEY)
        keep_lowest_versions(spark, paths, "sellers", KEY)      # nothing new
        want = keep_first(spark.createDataFrame(sum(files[:i + 1], []), build_schema("sellers")), KEY)
        assert rows(current(spark, paths, "sellers", KEY)) == rows(want)
        compact(spark, paths, "sellers", KEY)
        compact(spark, paths, "sellers", KEY)
        assert rows(current(spark, paths, "sellers", KEY)) == rows(want)
        assert len(children(spark, versions_path(paths, "sellers"))) == 1
