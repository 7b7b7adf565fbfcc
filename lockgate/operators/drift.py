"""Stored layouts against a declared one.

Works on the relation of :func:`lockgate.sources.raw.stored_layouts`: one row for each
layout that an extract holds. The declared layout is a constant array, so comparing any
number of layouts is a projection; the reports then add up an extract's layouts.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate.functions.expressions import constant
from lockgate.layouts import RAW_LAYOUT
from lockgate.sources.raw import LAYOUT_FIELDS

log = logging.getLogger(__name__)

# --- Fixed values: kinds of drift, and stored types that read losslessly ---

MISSING = "missing"
UNEXPECTED = "unexpected"
WIDENED = "widened"
MISMATCHED = "mismatched"
RECASED = "recased"
BLOCKING_KINDS = (MISSING, MISMATCHED)

# declared type: stored types it can take without losing a value
WIDENINGS = {
    "smallint": ("tinyint",),
    "int": ("tinyint", "smallint"),
    "bigint": ("tinyint", "smallint", "int"),
    "float": ("tinyint", "smallint", "int"),
    "double": ("tinyint", "smallint", "int", "bigint", "float"),
    "timestamp": ("date",),
}

# --- End of fixed values ---

_WANTED = "array<struct<name: string, type: string, narrower: array<string>>>"
_DRIFT = "struct<column: string, kind: string, expected: string, actual: string>"


def layout_of(spark: SparkSession, schema: T.StructType, extract: str = "") -> DataFrame:
    """A schema at hand, in the shape of ``stored_layouts``."""
    columns = [(f.name, f.dataType.simpleString()) for f in schema]
    return spark.createDataFrame([(extract, columns, 1)], LAYOUT_FIELDS)


def _entry(column, kind, expected, actual) -> Column:
    parts = [p if isinstance(p, Column) else F.lit(p) for p in (column, kind, expected, actual)]
    return F.struct(*parts).cast(_DRIFT)


def with_drift(
    layouts: DataFrame,
    declared: T.StructType = RAW_LAYOUT,
    *,
    check_types: bool = True,
    case_sensitive: bool = False,
) -> DataFrame:
    """Adds ``drift``, an array of differences, to every layout.

    Column order does not matter. Names match as Spark resolves them, without
    regard to case, unless ``case_sensitive``. With ``check_types`` off only
    names are compared, which is all that CSV has.
    """

    def key(name: Column) -> Column:
        return name if case_sensitive else F.lower(name)

    wanted = [
        {
            "name": field.name,
            "type": field.dataType.simpleString(),
            "narrower": WIDENINGS.get(field.dataType.simpleString(), ()),
        }
        for field in declared
    ]
    stored, want = F.col("columns"), constant(wanted, _WANTED)

    def paired(d: Column) -> Column:
        same = F.filter(stored, lambda s: key(s["name"]) == key(d["name"]))
        return F.struct(d.alias("want"), F.try_element_at(same, F.lit(-1)).alias("have"))

    def differences(pair: Column) -> Column:
        d, have = pair["want"], pair["have"]
        type_kind = F.when(F.array_contains(d["narrower"], have["type"]), WIDENED).otherwise(
            MISMATCHED
        )
        retyped = have["type"] != d["type"] if check_types else F.lit(False)
        return F.array_compact(
            F.array(
                F.when(have.isNull(), _entry(d["name"], MISSING, d["type"], None)),
                F.when(
                    have["name"] != d["name"], _entry(d["name"], RECASED, d["name"], have["name"])
                ),
                F.when(retyped, _entry(d["name"], type_kind, d["type"], have["type"])),
            )
        )

    def undeclared(s: Column) -> Column:
        return ~F.exists(want, lambda d: key(d["name"]) == key(s["name"]))

    on_declared = F.flatten(F.transform(F.transform(want, paired), differences))
    extra = F.transform(
        F.filter(stored, undeclared), lambda s: _entry(s["name"], UNEXPECTED, None, s["type"])
    )
    return layouts.withColumns(
        {
            "declared_columns": F.lit(len(declared)),
            "stored_columns": F.size(stored),
            "types_checked": F.lit(check_types),
            "drift": F.concat(on_declared, extra),
        }
    )


def _blocks(kind: Column) -> Column:
    return kind.isin(*BLOCKING_KINDS)


def drift_line() -> Column:
    expected, actual = F.col("expected"), F.col("actual")
    detail = (
        F.when(F.col("kind") == MISSING, F.format_string("declared %s, absent from the source", expected))
        .when(F.col("kind") == UNEXPECTED, F.format_string("stored as %s, never declared", actual))
        .when(
            F.col("kind") == RECASED,
            F.format_string("declared '%s', stored as '%s'", expected, actual),
        )
        .otherwise(F.format_string("declared %s, stored as %s", expected, actual))
    )
    marker = F.when(F.col("blocking"), "BLOCK").otherwise("WARN ")
    return F.format_string("[%s] %s[%s]: %s", marker, F.col("kind"), F.col("column"), detail)


def drift_rows(compared: DataFrame) -> DataFrame:
    """One row per difference, with the number of files that show it, a verdict and a line.

    A difference that several layouts of an extract share is one row, at its first position.
    """
    rows = compared.select("extract", "files", F.posexplode("drift").alias("position", "d"))
    return (
        rows.groupBy("extract", "d")
        .agg(F.min("position").alias("position"), F.sum("files").alias("files"))
        .select("extract", "position", "d.*", "files")
        .withColumn("blocking", _blocks(F.col("kind")))
        .withColumn("summary", drift_line())
    )


def drift_summary(compared: DataFrame) -> DataFrame:
    """One row per extract, conforming ones included, with a JSON record.

    An extract of several layouts has the differences of all of them, and the stored
    columns of the widest.
    """
    merged = compared.groupBy("extract").agg(
        F.first("declared_columns").alias("declared_columns"),
        F.max("stored_columns").alias("stored_columns"),
        F.first("types_checked").alias("types_checked"),
        F.array_distinct(F.flatten(F.sort_array(F.collect_set("drift")))).alias("drift"),
    )
    blocking = F.size(F.filter("drift", lambda d: _blocks(d["kind"])))
    counted = merged.withColumns(
        {"blocking_count": blocking, "advisory_count": F.size("drift") - blocking}
    ).withColumn("conforms", F.col("blocking_count") == 0)
    names = ["conforms", "declared_columns", "stored_columns", "types_checked"]
    names += ["blocking_count", "advisory_count"]
    record = F.struct(F.col("extract").alias("dataset"), *names, F.col("drift").alias("columns"))
    options = {"ignoreNullFields": "false"}
    return counted.select("extract", *names, F.to_json(record, options).alias("document"))


class SchemaDriftError(RuntimeError):
    """An extract would not read as declared.

    ``drift`` holds all differences and ``blocking`` those that block; the message
    shows the first of them.
    """

    def __init__(self, shown: list[str], blocking: int, advisory: int, drift: DataFrame) -> None:
        more = f", and {blocking - len(shown)} more" * (blocking > len(shown))
        super().__init__(
            f"schema drift: {', '.join(shown)}{more} ({blocking} blocking, {advisory} advisory)"
        )
        self.drift, self.blocking = drift, drift.filter("blocking")


def enforce_schema(rows: DataFrame, *, strict: bool = True) -> bool:
    """Logs drift; raises if any of it blocks, unless ``strict`` is off.

    With many extracts the log and the message show the first differences;
    the counts cover all of them.
    """
    shown = rows.orderBy(~F.col("blocking"), "extract", "position").limit(50).collect()
    for row in shown:
        level = logging.ERROR if row.blocking else logging.WARNING
        log.log(level, "schema drift in %s: %s", row.extract or "the source", row.summary)
    first = [f"{row.kind}[{row.column}]" for row in shown if row.blocking]
    if first and strict:
        counts = rows.agg(F.count_if("blocking").alias("b"), F.count(F.lit(1)).alias("n")).first()
        raise SchemaDriftError(first, counts.b, counts.n - counts.b, rows)
    return not first
