"""Incremental bronze ingest: only new files are appended, restarts resume."""

from tillroll.paths import LayerPaths
from tillroll.schemas import DATASET_FILES, DATASET_FOLDER
from tillroll.streaming import ingest_incrementally
from tillroll.streaming.landing import stream_checkpoint


def test_incremental_ingest_appends_new_files_only(spark, tmp_path):
    paths = LayerPaths.under(str(tmp_path))
    landing = tmp_path / "raw" / DATASET_FOLDER / "latest" / DATASET_FILES["sellers"]
    landing.mkdir(parents=True)
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    (landing / "part-1.csv").write_text(header + "s1,01000,sp,SP\ns2,02000,rio,RJ\n")
    ckpt = str(tmp_path / "ckpt")
    ingest_incrementally(spark, paths, "sellers", checkpoint=ckpt)
    assert spark.read.parquet(paths.bronze("sellers")).count() == 2
    (landing / "part-2.csv").write_text(header + "s3,03000,bh,MG\n")
    ingest_incrementally(spark, paths, "sellers", checkpoint=ckpt)
    out = spark.read.parquet(paths.bronze("sellers"))
    assert sorted(r["seller_id"] for r in out.collect()) == ["s1", "s2", "s3"]
    ingest_incrementally(spark, paths, "sellers", checkpoint=ckpt)   # nothing new
    assert spark.read.parquet(paths.bronze("sellers")).count() == 3


def test_incremental_ingest_of_free_text_reviews(spark, tmp_path):
    paths = LayerPaths.under(str(tmp_path))
    landing = tmp_path / "raw" / DATASET_FOLDER / "latest" / DATASET_FILES["order_reviews"]
    landing.mkdir(parents=True)
    (landing / "part-1.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"two\nlines, ""quoted""",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        "r2,o2,4,,,2018-03-10 00:00:00,2018-03-11 03:05:13\n")
    ingest_incrementally(spark, paths, "order_reviews", checkpoint=str(tmp_path / "ckpt"))
    rows = {r["review_id"]: r for r in spark.read.parquet(paths.bronze("order_reviews")).collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"]["review_comment_message"] == 'two\nlines, "quoted"'
    assert rows["r2"]["review_score"] == 4


def test_progress_is_kept_across_sessions(spark, tmp_path):
    """Without an explicit checkpoint a later application goes on where the
    last one stopped: every landed row arrives once."""
    paths = LayerPaths.under(str(tmp_path))
    landing = tmp_path / "raw" / DATASET_FOLDER / "latest" / DATASET_FILES["sellers"]
    landing.mkdir(parents=True)
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    for run in range(3):
        session = spark.newSession()
        (landing / f"part-{run}.csv").write_text(header + "".join(f"s{run}{i},0,x,Y\n" for i in range(3)))
        ingest_incrementally(session, paths, "sellers")
    got = [r["seller_id"] for r in spark.read.parquet(paths.bronze("sellers")).collect()]
    assert sorted(got) == sorted(f"s{run}{i}" for run in range(3) for i in range(3))
    assert str(tmp_path) in stream_checkpoint(paths, "sellers")
