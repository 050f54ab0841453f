"""Resumable runs (K5): a rerun starts after the last whole stage.

A run is named by what it reads: a digest of the landed raw files (path, size,
modification time).  When a stage has written all its tables, a marker with its
report is put below ``<mart>/gold/runs/<run>``: written under another name,
then renamed, so that there is a whole marker or none.  A rerun over the same
raw files answers a marked stage from its marker and runs the others.

The layers hold one run's tables at a time.  So before a stage runs, the markers
of the stages after it go, and those of every other run: what they describe is
about to be replaced.  Markers are a few names and counts; a stage's own tables
are safe by Spark's committer, and a stage that died is run from its start.
"""

from __future__ import annotations

import json
import logging
from typing import Callable, Mapping

from pyspark.sql import SparkSession, functions as F

from tillroll.paths import LayerPaths
from tillroll.plans import pipeline
from tillroll.sinks.files import children, exists, read_text, remove, write_text
from tillroll.sources.landing import discover_csv

log = logging.getLogger(__name__)

RUNS = "runs"


def raw_digest(spark: SparkSession, paths: LayerPaths) -> str:
    """Hex name of the raw files as they lie: one aggregation over the listing."""
    files = discover_csv(spark, paths.raw("", "latest").rstrip("/"))
    one = F.conv(F.substring(F.md5(F.concat_ws("|", "path", "length", F.unix_micros("modificationTime"))), 1, 15), 16, 10)
    n, total = files.agg(F.count(F.lit(1)), F.sum(one.cast("decimal(28,0)"))).first()
    return f"{int(total):x}-{n}"


class Run:
    """The stages of one run, in order, with their markers."""

    def __init__(self, spark: SparkSession, paths: LayerPaths, name: str):
        self.spark, self.paths, self.name = spark, paths, name
        self.ran: list[str] = []

    def _marker(self, stage: str = "") -> str:
        return self.paths.gold(f"{RUNS}/{self.name}/{stage}").rstrip("/")

    def _begin(self, stage: str, later: list[str]) -> None:
        for other in children(self.spark, self.paths.gold(RUNS)):
            if other != self.name:
                remove(self.spark, self.paths.gold(f"{RUNS}/{other}"))
        for s in (stage, *later):
            remove(self.spark, self._marker(s))

    def go(self, stages: Mapping[str, Callable[[], object]]) -> dict[str, object]:
        """Reports of all stages; those that are marked are not run."""
        out: dict[str, object] = {}
        names = list(stages)
        for i, stage in enumerate(names):
            if not self.ran and exists(self.spark, self._marker(stage)):
                out[stage] = json.loads(read_text(self.spark, self._marker(stage)))
                log.info("%s: done before", stage)
                continue
            # Once a stage has run, those after it read new tables.
            self._begin(stage, names[i + 1:])
            report = stages[stage]()
            self.ran.append(stage)
            write_text(self.spark, self._marker(stage), json.dumps(report))
            out[stage] = report
        return out


def resume_pipeline(spark: SparkSession, paths: LayerPaths,
                    concurrent_jobs: int = pipeline.DEFAULT_CONCURRENT_JOBS) -> dict[str, object]:
    """``run_pipeline`` over the raw files as they lie, after the last stage
    that an earlier call finished for them."""
    return Run(spark, paths, raw_digest(spark, paths)).go(pipeline.stages(spark, paths, concurrent_jobs))
