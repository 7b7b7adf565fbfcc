"""Measuring rule sets and splitting rows by them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate.functions.expressions import all_true, constant, packed_text
from lockgate.operators.rules import DatasetRule, Rule, RuleSet

#: Added to quarantined rows: the names of all the rules they broke, in order.
FAILURES = "_dq_failures"

#: Added to routed rows: whether a row keeps every quarantine rule.
KEPT = "_dq_kept"

#: One record per rule, as produced by :func:`evaluate`, after stage and ruleset.
RESULT_FIELDS = """
    position int, name string, description string, severity string, kind string,
    passed boolean, columns array<string>, threshold double, pass_rate double,
    failing_rows bigint, total_rows bigint, metric double
"""

_KNOWN = (
    "name: string, description: string, severity: string, columns: array<string>, threshold: double"
)


def _count_true(flag: Column) -> Column:
    return F.coalesce(F.sum(flag.cast("bigint")), F.lit(0).cast("bigint"))


def _flags(ruleset: RuleSet) -> tuple[dict[str, Column], Column]:
    """A column for every row rule, and whether a row keeps all quarantine rules.

    Flags get columns of their own first: each predicate is then computed once per row,
    however many counts it takes part in.
    """
    flags = {f"_holds_{i}": rule.holds for i, rule in enumerate(ruleset.row_rules)}
    clean = all_true(
        F.col(f"_holds_{i}") for i, rule in enumerate(ruleset.row_rules) if rule.quarantine
    )
    return flags, clean


def _counts(flags: dict[str, Column], clean: Column) -> list[Column]:
    counts = [F.count(F.lit(1)).alias("total_rows"), _count_true(clean).alias("clean_rows")]
    return counts + [_count_true(F.col(f)).alias(f.removeprefix("_")) for f in flags]


def _metrics(ruleset: RuleSet) -> list[tuple[DatasetRule, str, Column]]:
    return [
        (rule, f"metric_{i}", rule.metric.cast("double").alias(f"metric_{i}"))
        for i, rule in enumerate(ruleset.dataset_rules)
    ]


def route(
    df: DataFrame, ruleset: RuleSet, *, keyed_by: str | None = None, within: Sequence[str] = ()
) -> tuple[DataFrame, Observation]:
    """``df`` with :data:`FAILURES` and :data:`KEPT`, and what is measured while it is written.

    The observation holds the columns of :func:`measure` once an action has run, so
    measuring needs no pass of its own. Put the rows behind the last shuffle: there, every
    task's counts enter once, however often executors are lost.

    ``keyed_by`` says that equal values of that column already share a task, as behind a
    deduplication by it. Its surplus copies are then counted in place, without a shuffle;
    distinct counts of other columns are left out (see :func:`measured_apart`). ``within``
    names helper columns that equal values share, by which the rows were dealt out; they go.
    """
    flags, clean = _flags(ruleset)
    broken = [
        F.when(~F.col(f"_holds_{i}"), F.lit(rule.name))
        for i, rule in enumerate(ruleset.row_rules)
        if rule.quarantine
    ]
    failures = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    counts = _counts(flags, clean)
    names = [c for c in df.columns if c not in within]
    if keyed_by:
        nth = F.row_number().over(Window.partitionBy(*within, keyed_by).orderBy(keyed_by))
        df = df.withColumn("_surplus", F.col(keyed_by).isNotNull() & (nth > 1))
    for rule, name, metric in _metrics(ruleset):
        if not rule.distinct:
            counts.append(metric)
        elif rule.columns == (keyed_by,):
            counts.append(_count_true(F.col("_surplus")).cast("double").alias(name))
    seen = Observation()
    rows = df.withColumns(flags).withColumn(KEPT, clean).observe(seen, *counts)
    return rows.select(*names, failures.alias(FAILURES), KEPT), seen


def measured_apart(staged: DataFrame, ruleset: RuleSet, known: Iterable[str]) -> dict[str, object]:
    """The metrics that :func:`route` left out, each from its own column of the staged rows."""
    missing = [m for m in _metrics(ruleset) if m[0].distinct and m[1] not in set(known)]
    return {name: _coded(staged, rule).agg(metric).first()[0] for rule, name, metric in missing}


def _coded(df: DataFrame, rule: DatasetRule, by: Sequence[str] = ()) -> DataFrame:
    """``df`` with the texts that a distinct count shuffles in fewer bytes."""
    if not rule.any_code or len(rule.columns) != 1 or rule.columns[0] in by:
        return df
    column = rule.columns[0]
    if column not in df.columns or df.schema[column].dataType != T.StringType():
        return df
    return df.withColumn(column, packed_text(column))


def as_measures(spark: SparkSession, values: dict[str, object], ruleset: RuleSet) -> DataFrame:
    """Observed values as the one row that :func:`measure` would give."""
    counts = ["total_rows", "clean_rows", *(f"holds_{i}" for i in range(len(ruleset.row_rules)))]
    metrics = [f"metric_{i}" for i in range(len(ruleset.dataset_rules))]
    ddl = ", ".join([f"{c} bigint" for c in counts] + [f"{m} double" for m in metrics])
    return spark.createDataFrame([tuple(values[name] for name in counts + metrics)], ddl)


def measure(df: DataFrame, ruleset: RuleSet, by: Sequence[str] = ()) -> DataFrame:
    """Everything a report needs, in one query: one row per ``by`` group.

    ``clean_rows`` counts the rows that no quarantine rule rejects, so the
    sizes of both halves of :func:`split` are known before either is written.

    Counts are combined on the map side, so a group of any size shuffles one
    record per input partition. A distinct count has to shuffle its values; it
    gets an aggregation of its own, which then carries that one column only,
    instead of every other count along with each distinct value.
    """
    flags, clean = _flags(ruleset)
    counts = _counts(flags, clean)
    metrics = [(rule, metric) for rule, _, metric in _metrics(ruleset)]
    counts += [metric for rule, metric in metrics if not rule.distinct]
    result = df.withColumns(flags).groupBy(*by).agg(*counts)
    apart = [(rule, metric) for rule, metric in metrics if rule.distinct]
    if not apart:
        return result
    for rule, metric in apart:
        counted = _coded(df, rule, by).groupBy(*by).agg(metric)
        result = result.unionByName(counted, allowMissingColumns=True)
    # One row per group again; each column is known in one of the united rows.
    known = [F.max(name).alias(name) for name in result.columns if name not in by]
    return result.groupBy(*by).agg(*known)


def results_of(
    measures: DataFrame, ruleset: RuleSet, *, stage: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Turns :func:`measure` output into one row per rule (and ``by`` group)."""
    row_rules, dataset_rules = ruleset.row_rules, ruleset.dataset_rules
    measured = [
        F.struct(
            F.col(f"holds_{i}").alias("held"),
            F.lit(None).cast("double").alias("metric"),
            F.lit(None).cast("boolean").alias("accepted"),
        )
        for i in range(len(row_rules))
    ]
    measured += [
        F.struct(
            F.lit(None).cast("bigint").alias("held"),
            F.col(f"metric_{i}").alias("metric"),
            rule.accepts(F.col(f"metric_{i}")).alias("accepted"),
        )
        for i, rule in enumerate(dataset_rules)
    ]
    exploded = measures.select(*by, "total_rows", F.posexplode(F.array(*measured)))

    # What does not depend on the data is one constant, looked up by position:
    # the generated code stays small for any number of rules.
    known = [
        {
            "name": rule.name,
            "description": rule.description,
            "severity": str(rule.severity),
            "columns": rule.columns,
            "threshold": float(rule.threshold) if rule in row_rules else None,
        }
        for rule in (*row_rules, *dataset_rules)
    ]
    rule = F.get(constant(known, f"array<struct<{_KNOWN}>>"), F.col("pos"))

    is_row = F.col("pos") < len(row_rules)
    held, total = F.col("col.held"), F.col("total_rows")
    # No rows, no violations: an empty dataset is caught by a row count rule,
    # not by rates.
    rate = F.when(is_row, F.when(total == 0, 1.0).otherwise(held / total))
    threshold = rule["threshold"]
    return exploded.select(
        *by,
        F.lit(stage or ruleset.name).alias("stage"),
        F.lit(ruleset.name).alias("ruleset"),
        F.col("pos").alias("position"),
        rule["name"].alias("name"),
        rule["description"].alias("description"),
        rule["severity"].alias("severity"),
        F.when(is_row, "row").otherwise("dataset").alias("kind"),
        F.when(is_row, rate >= threshold).otherwise(F.col("col.accepted")).alias("passed"),
        rule["columns"].alias("columns"),
        threshold.alias("threshold"),
        rate.alias("pass_rate"),
        (total - held).alias("failing_rows"),
        "total_rows",
        F.col("col.metric").alias("metric"),
    )


def evaluate(
    df: DataFrame, ruleset: RuleSet, *, stage: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The report of ``ruleset`` over ``df``: one row per rule, one pass over the data.

    With ``by``, one report per group, still in one pass.
    """
    return results_of(measure(df, ruleset, by), ruleset, stage=stage, by=by)


def split(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with :data:`FAILURES` added.

    The clean half filters on the bare predicates, which reach the scan as
    pushed filters; reasons are worked out for the rejected rows only.
    """
    rules = tuple(rules)
    if not rules:
        return df, df.limit(0).withColumn(FAILURES, F.array().cast("array<string>"))
    clean = df.filter(all_true(rule.predicate for rule in rules))
    broken = F.array(*[F.when(~rule.holds, F.lit(rule.name)) for rule in rules])
    rejected = df.filter(~all_true(rule.holds for rule in rules))
    return clean, rejected.withColumn(FAILURES, F.array_compact(broken))
