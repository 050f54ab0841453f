"""Command line: run one pipeline stage or all of them.

    spark-submit tillroll_main.py all --raw s3a://raw --clean s3a://clean/shop --mart s3a://mart/shop
    python -m tillroll gate --root /data/warehouse

Base folders default to the environment variables RAW_BASE_PATH,
CLEAN_BASE_PATH and MART_BASE_PATH.  The session comes from the submitter
(``getOrCreate``): master, memory, shuffle partitions, AQE and the shared
``spark.checkpoint.dir`` are cluster settings, not library settings.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

from tillroll.paths import LayerPaths
from tillroll.schemas import DATASET_FOLDER

STAGES = ("bronze", "gate", "silver", "gold", "all")


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tillroll", description=__doc__.split("\n")[0])
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--root", help="one folder holding raw/, clean/ and mart/")
    p.add_argument("--raw", default=os.environ.get("RAW_BASE_PATH"))
    p.add_argument("--clean", default=os.environ.get("CLEAN_BASE_PATH"))
    p.add_argument("--mart", default=os.environ.get("MART_BASE_PATH"))
    p.add_argument("--dataset", default=DATASET_FOLDER)
    p.add_argument("--concurrent-jobs", type=int, default=4)
    p.add_argument("--shuffle-bytes", type=float, default=None,
                   help="expected largest shuffle in bytes; sizes shuffle partitions (opt-in)")
    p.add_argument("--resume", action="store_true",
                   help="with all: start after the last stage that a run over the same raw files finished")
    return p.parse_args(argv)


def layer_paths(args: argparse.Namespace) -> LayerPaths:
    if args.root:
        return LayerPaths.under(args.root, args.dataset)
    missing = [n for n in ("raw", "clean", "mart") if not getattr(args, n)]
    if missing:
        raise SystemExit(f"missing base paths: {missing} (give --root or --raw/--clean/--mart)")
    return LayerPaths(args.raw, args.clean, args.mart, args.dataset)


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession
    from tillroll.plans import pipeline
    from tillroll.plans.resume import resume_pipeline

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    args = parse_args(argv)
    paths = layer_paths(args)
    spark = SparkSession.builder.appName(f"tillroll-{args.stage}").getOrCreate()
    if args.shuffle_bytes:
        from tillroll.session import scale_conf
        for key, value in scale_conf(int(args.shuffle_bytes)).items():
            spark.conf.set(key, value)
    n = args.concurrent_jobs
    run = (pipeline.stages(spark, paths, n) | {
        "all": lambda: (resume_pipeline if args.resume else pipeline.run_pipeline)(spark, paths, n)})[args.stage]
    print(json.dumps({"stage": args.stage, "result": run()}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
