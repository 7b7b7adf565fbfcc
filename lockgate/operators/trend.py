"""How rules move from one run to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lockgate.functions.expressions import ratio
from lockgate.functions.text import percent
from lockgate.operators.history import RUN

# --- Fixed values: grades and their markers ---

REGRESSED = "regressed"
IMPROVED = "improved"
STEADY = "steady"
NEW = "new"
DROPPED = "dropped"

MARKERS = {REGRESSED: "DOWN", IMPROVED: " UP ", STEADY: "  = ", NEW: "NEW ", DROPPED: "GONE"}

#: A pass rate has to move by more than this to count as a change.
DEFAULT_TOLERANCE = 0.005

# --- End of fixed values ---


def _movement(tolerance: float) -> Column:
    """A changed verdict outweighs the size of the move; without rates nothing moves."""
    was, now, delta = F.col("previous_passed"), F.col("current_passed"), F.col("delta")
    return (
        F.when(was.isNull(), NEW)
        .when(now.isNull(), DROPPED)
        .when((was & ~now) | ((was == now) & (delta < -tolerance)), REGRESSED)
        .when((~was & now) | ((was == now) & (delta > tolerance)), IMPROVED)
        .otherwise(STEADY)
    )


def _trend(previous: DataFrame, current: DataFrame, tolerance: float) -> DataFrame:
    if tolerance < 0:
        raise ValueError(f"tolerance must be non-negative: {tolerance}")

    def side(results: DataFrame, prefix: str) -> DataFrame:
        run = F.col("run_id") if "run_id" in results.columns else F.lit(prefix)
        return results.select(
            "stage",
            "name",
            F.col("position").alias(f"{prefix}_position"),
            F.col("severity").alias(f"{prefix}_severity"),
            F.col("pass_rate").alias(f"{prefix}_pass_rate"),
            F.col("passed").alias(f"{prefix}_passed"),
            F.col("total_rows").alias(f"{prefix}_rows"),
            run.alias(f"{prefix}_run_id"),
        )

    paired = side(previous, "previous").join(side(current, "current"), ["stage", "name"], "full")
    # Every rule of a report carries its run and row count; a rule found on one
    # side only takes the other side's from its neighbours.
    per_stage = W.partitionBy("stage")
    for name in ("previous_rows", "current_rows", "previous_run_id", "current_run_id"):
        paired = paired.withColumn(name, F.max(name).over(per_stage))
    return (
        paired.withColumn("delta", F.col("current_pass_rate") - F.col("previous_pass_rate"))
        .withColumns(
            {
                "kind": _movement(tolerance),
                "broke": F.coalesce(
                    F.col("previous_passed") & ~F.col("current_passed"), F.lit(False)
                ),
                "severity": F.coalesce("current_severity", "previous_severity"),
                "position": F.coalesce("current_position", "previous_position"),
                "tolerance": F.lit(float(tolerance)),
            }
        )
        .drop("current_severity", "previous_severity", "current_position", "previous_position")
    )


def compare_reports(
    previous: DataFrame, current: DataFrame, *, tolerance: float = DEFAULT_TOLERANCE
) -> DataFrame:
    """Two reports, rule by rule, matched by stage and rule name.

    Either side may hold several stages, but both have to hold the same ones;
    a stage without a counterpart fails the query that reads the comparison.
    """
    compared = _trend(previous, current, tolerance)
    alone = F.col("previous_rows").isNull() | F.col("current_rows").isNull()
    refusal = F.concat(F.lit("no report to compare with for stage "), F.col("stage"))
    return compared.withColumn(
        "stage", F.when(alone, F.raise_error(refusal).cast("string")).otherwise(F.col("stage"))
    )


def compare_runs(results: DataFrame, *, tolerance: float = DEFAULT_TOLERANCE) -> DataFrame:
    """The two newest runs of every stage; a stage with one run has no rows."""
    known = results.select(*RUN, "recorded_at").distinct()
    newest_first = W.partitionBy("stage").orderBy(F.desc("recorded_at"), F.desc("run_id"))
    ranked = known.withColumn("_rank", F.row_number().over(newest_first))
    ranked = ranked.filter(F.col("_rank") <= 2)
    paired = ranked.groupBy("stage").agg(
        F.max(F.when(F.col("_rank") == 1, F.col("run_id"))).alias("current"),
        F.max(F.when(F.col("_rank") == 2, F.col("run_id"))).alias("previous"),
    )
    paired = paired.filter(F.col("previous").isNotNull())

    def report_of(which: str) -> DataFrame:
        run = paired.select("stage", F.col(which).alias("run_id"))
        return results.join(run, [*RUN], "left_semi")

    return _trend(report_of("previous"), report_of("current"), tolerance)


def trend_line() -> Column:
    was, now = F.col("previous_pass_rate"), F.col("current_pass_rate")

    def verdict(passed: Column) -> Column:
        return F.when(passed, "pass").otherwise("fail")

    def rate(value: Column) -> Column:
        return F.coalesce(percent(value, 4), F.lit("-"))

    moved = F.format_string(
        "%s -> %s (%s)", rate(was), rate(now), percent(F.col("delta"), 4, signed=True)
    )
    detail = (
        F.when(F.col("kind") == NEW, F.format_string("not checked last run, now %s", rate(now)))
        .when(F.col("kind") == DROPPED, F.format_string("was %s, no longer checked", rate(was)))
        .when(
            F.col("delta").isNull(),
            F.format_string(
                "%s -> %s", verdict(F.col("previous_passed")), verdict(F.col("current_passed"))
            ),
        )
        .otherwise(moved)
    )
    marker = F.lit("  ? ")
    for kind, text in MARKERS.items():
        marker = F.when(F.col("kind") == kind, text).otherwise(marker)
    suffix = F.when(F.col("broke"), ", now below its threshold").otherwise("")
    return F.concat(F.format_string("[%s] %s: ", marker, F.col("name")), detail, suffix)


def trend_summary(trend: DataFrame) -> DataFrame:
    """One row per stage: counts of movements, row counts, and a JSON record."""
    of_kind = {REGRESSED: "regression_count", IMPROVED: "improvement_count"}
    # One record per rule of the two reports.
    fields = ["name", "kind", "previous_pass_rate", "current_pass_rate"]
    fields += ["previous_passed", "current_passed", "severity"]
    record = F.struct((F.col("kind") == DROPPED).alias("gone"), "position", F.struct(*fields).alias("r"))
    rules = F.transform(F.sort_array(F.collect_list(record)), lambda x: x["r"])
    run = ["previous_run_id", "current_run_id", "previous_rows", "current_rows", "tolerance"]
    summary = trend.groupBy("stage", *run).agg(
        *[F.count_if(F.col("kind") == kind).alias(name) for kind, name in of_kind.items()],
        F.count_if("broke").alias("broken_count"),
        rules.alias("rules"),
    )
    summary = summary.withColumns(
        {
            "row_delta": F.col("current_rows") - F.col("previous_rows"),
            "stable": F.col("regression_count") == 0,
        }
    ).withColumn("row_change", ratio(F.col("row_delta"), F.col("previous_rows")))
    document = F.struct(
        "stage", *run[:4], "row_delta", "row_change", "tolerance", "stable", "regression_count", "rules"
    )
    options = {"ignoreNullFields": "false"}
    return summary.withColumn("document", F.to_json(document, options)).drop("rules")


class QualityRegressed(RuntimeError):
    """A rule regressed since the previous run."""


def block_on_regression(summary: DataFrame) -> None:
    """Optional gate on trends; at most one row per stage comes to the driver."""
    moved = summary.filter(~F.col("stable")).select("stage", "regression_count").collect()
    if moved:
        raise QualityRegressed(", ".join(f"{r.stage}: {r.regression_count} rules" for r in moved))
