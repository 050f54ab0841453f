"""Verified snapshots: manifests with content digests, archive against latest."""

import glob
import os

import pytest

from tillroll.paths import LayerPaths
from tillroll.schemas import DATASET_FILES, build_schema
from tillroll.sinks.files import write_csv
from tillroll.sources.landing import compare_snapshots, discover_csv, snapshot_run, verify_snapshot

STAMP = "20240101T000000Z"
ARCHIVE = f"archive/run_ts={STAMP}"


@pytest.fixture()
def landed(spark, tmp_path):
    paths = LayerPaths.under(str(tmp_path))
    sellers = spark.createDataFrame([(f"s{i}", f"{i:05d}", "porto, sul", "PT") for i in range(50)],
                                    build_schema("sellers")).repartition(3)
    reviews = spark.createDataFrame([("r", "o", 5, "a\nb", 'he said "x"', None, None)], build_schema("order_reviews"))
    none = spark.createDataFrame([], build_schema("category_translation"))
    man = snapshot_run(spark, {"sellers": sellers, "order_reviews": reviews, "category_translation": none}, paths, run_ts=STAMP)
    return paths, sellers, man


def files(paths, dataset, snapshot="latest"):
    return sorted(glob.glob(paths.raw(DATASET_FILES[dataset], snapshot) + "/part-*.csv"))


def found(df):
    return sorted(tuple(r) for r in df.collect())


def key(path):
    return "/".join(path.split("/")[-2:])


def test_both_copies_are_as_their_manifests_say(spark, landed):
    paths, _, man = landed
    assert found(verify_snapshot(spark, paths)) == found(verify_snapshot(spark, paths, ARCHIVE)) == []
    assert found(compare_snapshots(spark, paths, ARCHIVE)) == []
    rows = [r for r in man.collect() if r["dataset"] == "sellers"]
    assert {r["key"] for r in rows} == {key(f) for f in files(paths, "sellers")}
    assert all(r["size_bytes"] == os.path.getsize(f) for r in rows for f in files(paths, "sellers") if key(f) == r["key"])
    assert {r["file_count"] for r in rows} == {3} and len({r["content"] for r in rows}) == 3


def test_a_changed_file_is_reported(spark, landed):
    paths, _, _ = landed
    changed = files(paths, "sellers")[1]
    text = open(changed).read()
    open(changed, "w").write(text.replace("porto", "parto", 1))     # the same size
    os.remove(changed.replace("part-", ".part-") + ".crc")
    assert found(verify_snapshot(spark, paths)) == [("sellers", key(changed), "changed")]
    assert found(verify_snapshot(spark, paths, ARCHIVE)) == []
    assert found(compare_snapshots(spark, paths, ARCHIVE)) == [("sellers", "differs")]


def test_missing_and_added_files_are_reported(spark, landed):
    paths, _, _ = landed
    first = files(paths, "sellers")[0]
    added = os.path.join(os.path.dirname(first), "part-late.csv")
    with open(added, "w") as f:
        f.write("seller_id\n")
    os.remove(first)
    assert found(verify_snapshot(spark, paths)) == sorted([("sellers", key(first), "missing"), ("sellers", key(added), "added")])


def test_rows_are_compared_however_they_are_split(spark, landed):
    paths, sellers, _ = landed
    write_csv(sellers.repartition(1), paths.raw(DATASET_FILES["sellers"]))
    assert found(compare_snapshots(spark, paths, ARCHIVE)) == []
    write_csv(sellers.union(sellers.limit(1)), paths.raw(DATASET_FILES["sellers"]))
    write_csv(spark.createDataFrame([("c", "u", "1", "x", "SP")], build_schema("customers")), paths.raw(DATASET_FILES["customers"]))
    assert found(compare_snapshots(spark, paths, ARCHIVE)) == [("customers", "only in latest"), ("sellers", "differs")]


def test_discovery_runs_no_job_when_it_is_built(spark, landed, tmp_path):
    paths, _, _ = landed
    sc = spark.sparkContext
    sc.setJobGroup("discovery", "")
    try:
        files_found = discover_csv(spark, paths.raw("", "latest").rstrip("/"))
        (tmp_path / "none" / "deep").mkdir(parents=True)
        (tmp_path / "none" / "deep" / "notes.txt").write_text("x")
        with pytest.raises(ValueError, match="no CSV files"):
            discover_csv(spark, str(tmp_path / "none"))
        assert list(sc.statusTracker().getJobIdsForGroup("discovery")) == []
    finally:
        sc._jsc.clearJobGroup()
    assert files_found.count() == len(glob.glob(paths.raw("*/part-*.csv")))
