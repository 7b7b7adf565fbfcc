"""Verdicts over reports, and the exceptions that stop a run."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate.operators.report import rule_line
from lockgate.operators.rules import Severity

log = logging.getLogger(__name__)


def blocking() -> Column:
    return ~F.col("passed") & (F.col("severity") == str(Severity.ERROR))


def warning() -> Column:
    return ~F.col("passed") & (F.col("severity") == str(Severity.WARN))


def _names(condition: Column) -> Column:
    """Rule names in rule order; a report is as long as its rule set."""
    pairs = F.sort_array(F.collect_list(F.when(condition, F.struct("position", "name"))))
    return F.transform(pairs, lambda pair: pair["name"])


def verdicts(results: DataFrame, by: Sequence[str] = ("stage",)) -> DataFrame:
    """One row per report: passed unless a rule of error severity failed."""
    return (
        results.groupBy(*by)
        .agg(
            F.max("total_rows").alias("total_rows"),
            F.count(F.lit(1)).alias("rules"),
            F.count_if(blocking()).alias("error_count"),
            F.count_if(warning()).alias("warning_count"),
            _names(blocking()).alias("errors"),
            _names(warning()).alias("warnings"),
        )
        .withColumn("passed", F.col("error_count") == 0)
    )


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("passed"))


class QualityGateFailed(RuntimeError):
    """A blocking rule is below its threshold. ``report`` holds all results."""

    def __init__(self, stage: str, errors: list[str], warnings: list[str], report) -> None:
        super().__init__(
            f"{stage}: blocked by {', '.join(errors)}"
            f" ({len(errors)} blocking, {len(warnings)} warning)"
        )
        self.stage, self.errors, self.warnings, self.report = stage, errors, warnings, report


def enforce(results: DataFrame, *, strict: bool = True) -> bool:
    """Logs what failed; raises on blocking failures unless ``strict`` is off.

    Takes the report of one stage. Brings at most one row per rule to the
    driver.
    """
    lines = failures(results).withColumn("line", rule_line()).orderBy("position")
    failed = lines.select("stage", "name", "severity", "line").collect()
    errors = [row for row in failed if row.severity == Severity.ERROR]
    warnings = [row for row in failed if row.severity == Severity.WARN]
    for row in failed:
        log.log(logging.ERROR if row in errors else logging.WARNING, "%s %s", row.stage, row.line)
    if errors and strict:
        raise QualityGateFailed(
            errors[0].stage, [r.name for r in errors], [r.name for r in warnings], results
        )
    return not errors
