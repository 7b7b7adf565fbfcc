"""Reports as rows, as one JSON document each, and as lines of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lockgate.functions.text import percent, six_digits, thousands
from lockgate.operators.evaluate import RESULT_FIELDS

_RESULT_NAMES = [field.split()[0] for field in RESULT_FIELDS.split(",")]
_DOCUMENT = (
    f"stage string, ruleset string, total_rows bigint, results array<struct<{RESULT_FIELDS}>>"
)


def rule_line() -> Column:
    """``[FAIL] rule: 97.0000% pass (need 98.00%), 30 bad rows``"""
    rate = F.concat(
        percent(F.col("pass_rate"), 4),
        F.lit(" pass"),
        F.coalesce(
            F.concat(F.lit(" (need "), percent(F.col("threshold"), 2), F.lit(")")), F.lit("")
        ),
        F.when(
            F.col("failing_rows") > 0,
            F.concat(F.lit(", "), thousands(F.col("failing_rows")), F.lit(" bad rows")),
        ).otherwise(""),
    )
    metric = F.coalesce(
        F.concat(F.lit("metric="), six_digits(F.col("metric"))), F.lit("no metric")
    )
    has_rate = (F.col("kind") == "row") & F.col("pass_rate").isNotNull()
    return F.concat(
        F.when(F.col("passed"), "[PASS] ").otherwise("[FAIL] "),
        F.col("name"),
        F.lit(": "),
        F.when(has_rate, rate).otherwise(metric),
    )


def to_documents(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One JSON document per report. ``by`` names run columns to keep."""
    blocked = ~F.col("passed") & (F.col("severity") == "error")
    warned = ~F.col("passed") & (F.col("severity") == "warn")
    # A report has one record per rule, so the list is as long as the rule set.
    records = F.sort_array(F.collect_list(F.struct(*_RESULT_NAMES)))
    reports = results.groupBy(*by, "stage", "ruleset").agg(
        F.max("total_rows").alias("total_rows"),
        F.count_if(blocked).alias("error_count"),
        F.count_if(warned).alias("warning_count"),
        records.alias("results"),
    )
    document = F.struct(
        "stage",
        "ruleset",
        "total_rows",
        (F.col("error_count") == 0).alias("passed"),
        "error_count",
        "warning_count",
        "results",
    )
    return reports.select(*by, "stage", F.to_json(document).alias("document"))


def from_documents(documents: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Back to one row per rule.

    Documents that do not parse are left out. Keys that an older writer did
    not know come back as null, and a document's own verdict is not read:
    :func:`lockgate.operators.gate.verdicts` works it out again.
    """
    parsed = documents.select(*by, F.from_json("document", _DOCUMENT).alias("d"))
    rest = [f"r.{name}" for name in _RESULT_NAMES if name != "position"]
    whole = F.col("d.stage").isNotNull() & F.col("d.results").isNotNull()
    whole = whole & F.col("d.ruleset").isNotNull() & F.col("d.total_rows").isNotNull()
    # Rules keep the order they have in the document.
    rows = parsed.filter(whole).select(
        *by, "d.stage", "d.ruleset", F.posexplode("d.results").alias("position", "r")
    )
    return rows.select(*by, "stage", "ruleset", "position", *rest)
