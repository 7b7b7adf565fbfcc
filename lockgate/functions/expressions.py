"""Arithmetic and time expressions shared by the operators.

The time helpers take the frame as well as the column name, because a
``timestamp`` and a ``timestamp_ntz`` need different expressions to reach the
same UTC wall clock, and the result must not move with the session time zone.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate.layouts import DAY_PARTS

#: Decimal places that exact sums add as text; holds values below 1e16.
TEXT = "decimal(28,12)"
#: Type of the whole parts of exact sums; holds 10^14 of the largest of them.
PART = "decimal(24,0)"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def is_instant(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampType)


def utc_clock(df: DataFrame, name: str) -> Column:
    """The UTC wall clock of a time column, whatever the session zone is."""
    if is_instant(df, name):
        return F.timestamp_add("MICROSECOND", F.unix_micros(F.col(name)), _epoch())
    return F.col(name)


def utc_instant(wall_clock: Column) -> Column:
    """Reads a ``timestamp_ntz`` as UTC; the inverse of :func:`utc_clock`."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), wall_clock))


def whole_seconds(df: DataFrame, name: str) -> Column:
    """Seconds of a time column with fractions dropped, for subtraction.

    Only differences are meaningful: the two time types count from different
    origins. Year 1 as origin keeps the count positive, where dropping the
    fraction means rounding down for every time.
    """
    if is_instant(df, name):
        return F.unix_seconds(F.col(name))
    return F.timestamp_diff("SECOND", F.lit("0001-01-01").cast("timestamp_ntz"), F.col(name))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null unless the denominator is positive, so ANSI mode cannot raise."""
    return F.when(denominator > 0, numerator / denominator)


def day_part(hour: Column) -> Column:
    branches = [F.when(hour.between(lo, hi), F.lit(label)) for label, lo, hi in DAY_PARTS]
    return F.coalesce(*branches)


def exact_sum(value: Column) -> Column:
    """A sum that does not depend on the order in which rows arrive and skips no digit.

    Every double is cut in two: the first twelve places of its decimal text, added as a
    decimal, and the rest, which is zero for ordinary money and distances. The rest is cut,
    without rounding, into whole multiples of 2^40, 2^-20 and 2^-80, added as decimals too.
    What lies below 2^-80 (8e-25) is added as a double, and so are values from 2^102 (5e30)
    on, infinities and NaN: they show up in the result rather than being skipped. All values
    go the same way, whatever else their group holds.
    """
    value = value.cast("double")
    text = F.coalesce(value.try_cast(TEXT), F.lit(0).cast(TEXT))
    far = ~(F.abs(value) < F.lit(2.0**102))
    near = F.when(far, F.lit(0.0)).otherwise(value - text.cast("double"))

    def whole(x: Column) -> Column:
        return x.cast("bigint")  # towards zero, so the rest keeps the sign and is exact

    high = whole(near / F.lit(2.0**40))
    rest = near - high.cast("double") * F.lit(2.0**40)
    middle = whole(rest * F.lit(2.0**20))
    rest = rest * F.lit(2.0**20) - middle.cast("double")
    low = whole(rest * F.lit(2.0**60))
    rest = rest * F.lit(2.0**60) - low.cast("double")

    high, middle, low = (F.sum(part.cast(PART)) for part in (high, middle, low))
    joined = F.try_add(F.try_multiply(high, F.lit(2**60).cast("decimal(20,0)")), middle)
    loose = high.cast("double") * F.lit(2.0**60) + middle.cast("double")
    upper = F.coalesce(joined.cast("double"), loose) * F.lit(2.0**-20)
    lower = (low.cast("double") + F.sum(rest)) * F.lit(2.0**-80)
    beyond = F.coalesce(F.sum(F.when(far, value)), F.lit(0.0))
    return F.sum(text).cast("double") + (upper + lower + beyond)


def exact_mean(value: Column) -> Column:
    return ratio(exact_sum(value), F.count(value))


def constant(value: list | dict, ddl: str) -> Column:
    """Nested constant data as one column; the optimizer folds it to a literal."""
    return F.from_json(F.lit(json.dumps(value)), ddl)


def all_true(conditions) -> Column:
    """Conjunction that is true for an empty list."""
    result = None
    for condition in conditions:
        result = condition if result is None else result & condition
    return F.lit(True) if result is None else result


def hex_bytes(name: str) -> Column:
    """The bytes of a lower-case hex text; null for any other text."""
    there = F.unhex(name)
    return F.when(F.lower(F.hex(there)) == F.col(name), there)


def packed_text(name: str) -> Column:
    """Different bytes for different texts, half as many for hex; null stays null."""
    as_text = F.concat(F.lit(b"\1"), F.col(name).cast("binary"))
    return F.coalesce(F.concat(F.lit(b"\0"), hex_bytes(name)), as_text)


def with_hex_packed(df: DataFrame, name: str) -> tuple[DataFrame, Column]:
    """A frame that carries hex texts as bytes, half as wide, and the column that restores them.

    For shuffles: digests do not compress. Any other text, or null, travels as it is.
    """
    packed = f"_{name}_bytes"
    carried = df.withColumn(packed, hex_bytes(name))
    carried = carried.withColumn(name, F.when(F.col(packed).isNull(), F.col(name)))
    return carried, F.coalesce(F.col(name), F.lower(F.hex(packed)))
