"""Raw landing zone: discovery, run snapshots and manifests.

The landing layout is ``<raw>/<dataset>/<snapshot>/<file name>/part-*.csv``
with ``snapshot`` = ``archive/run_ts=<UTC stamp>`` for every run and
``latest`` for the current copy; each snapshot holds a ``_manifest`` (JSON)
describing its files.  All of it is distributed Spark I/O: the listing is a
``binaryFile`` scan that never reads file contents, and the manifest's row
counts come from one pass over the landed files with ``_metadata``, joined to
the listing so that files without data rows are described too.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.operators.digest import table_digest
from tillroll.paths import LayerPaths
from tillroll.schemas import DATASET_FILES, build_schema
from tillroll.sinks.files import children, holds_file, write_csv
from tillroll.sources.csv import read_raw_csv


MANIFEST = ("dataset string, key string, size_bytes long, row_count long, file_count long, "
            "content string, run_ts_utc string, source string")


def discover_csv(spark: SparkSession, root: str, require: bool = True) -> DataFrame:
    """Every ``*.csv`` below ``root`` by path: path, length, modification time.

    With ``require``, raises ``ValueError`` when nothing is found: the folder is
    listed up to the first such file.  No job runs here.
    """
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", True)
             .load(root)
             .select("path", "length", "modificationTime"))
    if require and not holds_file(spark, root, ".csv"):
        raise ValueError(f"no CSV files found under {root}")
    return files.orderBy("path")


def run_stamp(now: _dt.datetime | None = None) -> str:
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%SZ")


def land_tables(tables: Mapping[str, DataFrame], paths: LayerPaths, snapshot: str = "latest",
                files: Mapping[str, str] = DATASET_FILES) -> dict[str, str]:
    """Write raw tables as CSV into one landing snapshot; returns their paths."""
    out = {}
    for name, df in tables.items():
        out[name] = paths.raw(files[name], snapshot)
        write_csv(df, out[name])
    return out


def _described(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, size_bytes, content) of the CSV files of one folder.

    ``content`` is the sum of the hashes of a file's lines: large files are
    split over tasks and nothing is held whole.  A file without lines has 0.
    """
    files = discover_csv(spark, path, require=False).select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.col("length").alias("size_bytes"))
    line = F.conv(F.substring(F.md5("value"), 1, 15), 16, 10).cast("decimal(28,0)")
    lines = (spark.read.option("pathGlobFilter", "*.csv").text(path)
             .groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.sum(line).cast("string").alias("content")))
    return files.join(lines, "file_name", "left").select("file_name", "size_bytes", F.coalesce("content", F.lit("0")).alias("content"))


def manifest(spark: SparkSession, landed: Mapping[str, str], run_ts: str, source: str = "") -> DataFrame:
    """One row per landed file, by dataset and key.

    dataset, key (the path below the landing folder of the snapshot), size in
    bytes, data rows (0 for a file with a header alone), the dataset's number
    of files, a digest of the content, the run's stamp and where the data came
    from.
    """
    out = None
    for name, path in landed.items():
        folder = path.rstrip("/").rpartition("/")[2]
        files = _described(spark, path)
        rows = (read_raw_csv(spark, path, name if build_schema(name) else "")
                .select(F.col("_metadata.file_name").alias("file_name"))
                .groupBy("file_name").agg(F.count(F.lit(1)).alias("row_count")))
        part = files.join(rows, "file_name", "left").select(
            F.lit(name).alias("dataset"), F.concat(F.lit(folder + "/"), F.col("file_name")).alias("key"),
            "size_bytes", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"), "content")
        out = part if out is None else out.unionByName(part)
    counts = out.groupBy("dataset").agg(F.count(F.lit(1)).alias("file_count"))
    return (out.join(counts, "dataset").withColumns({"run_ts_utc": F.lit(run_ts), "source": F.lit(source)})
               .select("dataset", "key", "size_bytes", "row_count", "file_count", "content", "run_ts_utc", "source")
               .orderBy("dataset", "key"))


def snapshot_run(spark: SparkSession, tables: Mapping[str, DataFrame], paths: LayerPaths,
                 run_ts: str | None = None, source: str = "") -> DataFrame:
    """Land a run under ``archive/run_ts=..`` and as ``latest``, with a manifest
    next to each copy that describes that copy's own files; returns the
    manifest of ``latest``.

    Both copies are written from the source tables, so neither is a typed
    re-reading of the other.
    """
    run_ts = run_ts or run_stamp()
    out = ""
    for snapshot in (f"archive/run_ts={run_ts}", "latest"):
        landed = land_tables(tables, paths, snapshot)
        out = paths.raw("_manifest", snapshot)
        manifest(spark, landed, run_ts, source).write.mode("overwrite").json(out)
    return spark.read.schema(MANIFEST).json(out)


def verify_snapshot(spark: SparkSession, paths: LayerPaths, snapshot: str = "latest") -> DataFrame:
    """(dataset, key, problem) of every file that is not as the snapshot's
    manifest says: ``missing``, ``added`` or ``changed`` (size or content).

    The files are read once.  No rows: the snapshot is whole.
    """
    said = spark.read.schema(MANIFEST).json(paths.raw("_manifest", snapshot))
    now = None
    names = {file: name for name, file in DATASET_FILES.items()}
    for folder in children(spark, paths.raw("", snapshot).rstrip("/")):
        if folder in names:
            part = _described(spark, paths.raw(folder, snapshot)).select(
                F.lit(names[folder]).alias("dataset"), F.concat(F.lit(folder + "/"), F.col("file_name")).alias("key"),
                F.col("size_bytes").alias("size_now"), F.col("content").alias("content_now"))
            now = part if now is None else now.unionByName(part)
    if now is None:
        return said.select("dataset", "key", F.lit("missing").alias("problem"))
    problem = (F.when(F.col("size_now").isNull(), "missing").when(F.col("size_bytes").isNull(), "added")
                .when((F.col("size_now") != F.col("size_bytes")) | (F.col("content_now") != F.col("content")), "changed"))
    return (said.join(now, ["dataset", "key"], "full").select("dataset", "key", problem.alias("problem"))
                .where(F.col("problem").isNotNull()))


def compare_snapshots(spark: SparkSession, paths: LayerPaths, one: str, other: str = "latest") -> DataFrame:
    """(dataset, problem) of every registered dataset whose rows differ between
    two snapshots (``differs``), or that only one of them has (its name).

    The rows themselves are compared, by digest: how they are split into files
    differs between copies.
    """
    have = [set(children(spark, paths.raw("", s).rstrip("/"))) for s in (one, other)]
    out = [spark.createDataFrame([], "dataset string, problem string")]
    for name, file in DATASET_FILES.items():
        if file in have[0] & have[1]:
            a, b = (table_digest(read_raw_csv(spark, paths.raw(file, s), name), name) for s in (one, other))
            out.append(a.join(b, ["table_name", "row_count", "row_digest", "null_counts"], "left_anti")
                        .select(F.col("table_name").alias("dataset"), F.lit("differs").alias("problem")))
        elif file in have[0] | have[1]:
            alone = one if file in have[0] else other
            out.append(spark.createDataFrame([(name, f"only in {alone}")], "dataset string, problem string"))
    return reduce(DataFrame.unionByName, out)
