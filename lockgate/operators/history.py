"""Past reports as a table, one partition per stage and run."""

from __future__ import annotations

import logging
from collections import Counter
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lockgate.operators.evaluate import RESULT_FIELDS
from lockgate.operators.gate import verdicts
from lockgate.sources import storage

log = logging.getLogger(__name__)

RUN = ("stage", "run_id")
DEFAULT_KEEP = 30

_STORED = f"recorded_at string, ruleset string, {RESULT_FIELDS}, stage string, run_id string"
_STORED_NAMES = [field.split()[0] for field in _STORED.split(",")]

_AGE = ("recorded_at", "run_id")


def new_run_id(now: datetime | None = None) -> str:
    """UTC, sorts by time as text, and is safe in a path."""
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def timestamp_text(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime(
        "%Y-%m-%dT%H:%M:%SZ"
    )


def run_id_of(moment: Column) -> Column:
    """:func:`new_run_id` for a column of UTC wall-clock times."""
    return F.date_format(moment, "yyyyMMdd'T'HHmmss'Z'")


def recorded_at_of(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def age() -> Column:
    """Runs sort by when they were recorded; the id only breaks ties.

    A backfill may carry run ids that are older than its recording.
    """
    return F.struct(*_AGE)


def runs(results: DataFrame) -> DataFrame:
    """One row per recorded run with its verdict."""
    return verdicts(results, by=[*RUN, "recorded_at"])


def stages(results: DataFrame) -> DataFrame:
    return results.select("stage").distinct().orderBy("stage")


def latest(results: DataFrame, *, before: str | None = None) -> DataFrame:
    """The report of each stage's newest run, or of the newest before a run.

    Where ``before`` names no recorded run of a stage, all of its runs count
    as earlier: the run in progress is not recorded yet.
    """
    known = results.select(*RUN, "recorded_at").distinct()
    newest = known
    if before is not None:
        cutoff = known.groupBy("stage").agg(
            F.max(F.when(F.col("run_id") == before, age())).alias("cutoff")
        )
        newest = known.join(cutoff, "stage").filter(
            F.col("cutoff").isNull() | (age() < F.col("cutoff"))
        )
    newest = newest.groupBy("stage").agg(F.max(age()).alias("newest"))
    newest = newest.select("stage", "newest.*")
    return results.join(newest, [*RUN, "recorded_at"], "left_semi")


def beyond_newest(results: DataFrame, keep: int) -> DataFrame:
    """The runs of each stage that retention no longer covers."""
    if keep < 0:
        raise ValueError(f"keep must be non-negative: {keep}")
    known = results.select(*RUN, "recorded_at").distinct()
    newest_first = W.partitionBy("stage").orderBy(*[F.col(c).desc() for c in _AGE])
    ranked = known.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter(F.col("_rank") > keep).drop("_rank")


class History:
    """Recorded reports under one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def record(
        self, results: DataFrame, *, run_id: str | None = None, recorded_at: str | None = None
    ) -> None:
        """Stores reports; a run recorded again under the same id is replaced.

        ``results`` may bring ``run_id`` and ``recorded_at`` columns of its
        own, to record the reports of many runs in one write.
        """
        given = {
            "run_id": run_id or new_run_id(),
            "recorded_at": recorded_at or timestamp_text(),
        }
        missing = {k: F.lit(v) for k, v in given.items() if k not in results.columns}
        rows = results.withColumns(missing).select(*_STORED_NAMES)
        # Reports of one run are a handful of rows; those of many runs are
        # brought together so that every run becomes one file.
        rows = rows.coalesce(1) if "run_id" in missing else rows.repartition(*RUN)
        writer = rows.write.mode("overwrite").partitionBy(*RUN)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def results(self) -> DataFrame:
        """All recorded results; unreadable files are passed over."""
        if not storage.exists(self.spark, self.path):
            return self.spark.createDataFrame([], _STORED)
        reader = self.spark.read.schema(_STORED).option("ignoreCorruptFiles", True)
        return reader.parquet(self.path)

    def entries(self, stage: str | None = None) -> DataFrame:
        """Runs, oldest first."""
        found = self.results()
        if stage is not None:
            found = found.filter(F.col("stage") == stage)
        return runs(found).orderBy("stage", *_AGE)

    def stages(self) -> DataFrame:
        return stages(self.results())

    def latest(self, *, before: str | None = None) -> DataFrame:
        return latest(self.results(), before=before)

    def unreadable(self) -> list[tuple[str, str]]:
        """(stage, run_id) of recorded runs that :meth:`results` has to pass over.

        Told by directory names, of which there are as many as retention leaves.
        """
        held = {tuple(row) for row in self.results().select(*RUN).distinct().collect()}
        return [run for run, _ in self._directories() if run not in held]

    def _directories(self, stage: str | None = None) -> list[tuple[tuple[str, str], str]]:
        return [
            ((name, run_id), directory)
            for name, path in storage.partitions(self.spark, self.path, "stage")
            if stage in (None, name)
            for run_id, directory in storage.partitions(self.spark, path, "run_id")
        ]

    def prune(self, keep: int = DEFAULT_KEEP, stage: str | None = None) -> list[tuple[str, str]]:
        """Drops all but the newest ``keep`` runs per stage; returns what went.

        A run that cannot be read has no age. It is logged, and goes once its id sorts before
        those of all runs that stay. The list holds run names only, and is as long as what was
        removed.
        """
        if keep < 0:
            raise ValueError(f"keep must be non-negative: {keep}")
        directories = dict(self._directories(stage))
        sizes = Counter(name for name, _ in directories)
        crowded = [name for name, size in sizes.items() if size > keep]
        if not crowded:
            return []
        found = self.results().filter(F.col("stage").isin(crowded))
        doomed = beyond_newest(found, keep).orderBy("stage", *_AGE)
        removed = [tuple(row) for row in doomed.select(*RUN).collect()]
        held = {tuple(row) for row in found.select(*RUN).distinct().collect()}
        for run in sorted(set(directories) - held):
            if run[0] not in crowded:
                continue
            log.warning("run %s of %s cannot be read", run[1], run[0])
            staying = [run_id for name, run_id in held - set(removed) if name == run[0]]
            if len(staying) >= keep and all(run[1] < run_id for run_id in staying):
                removed.append(run)
        for run in removed:
            storage.delete(self.spark, directories[run])
        return removed
