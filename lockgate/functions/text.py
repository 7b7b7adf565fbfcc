"""One-line renderings of numbers, as columns.

``format_string`` writes a null as the word; here a null stays null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(value: Column, places: int, *, signed: bool = False) -> Column:
    flag = "+" if signed else ""
    return F.when(value.isNotNull(), F.format_string(f"%{flag}.{places}f%%", value * 100))


def thousands(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%,d", value))


def six_digits(value: Column) -> Column:
    """Six significant digits without trailing zeros, like C's ``%g``."""
    scientific = F.format_string("%.5e", value)
    exponent = F.regexp_extract(scientific, "e(.*)$", 1).try_cast("int")
    fixed = F.regexp_replace(
        F.call_function("format_string", F.concat(F.lit("%."), 5 - exponent, F.lit("f")), value),
        r"(\.\d*?)0+$",
        "$1",
    )
    return (
        F.when(value.isNull(), F.lit(None))
        .when(value == 0, F.lit("0"))
        .when(exponent.between(-4, 5), F.regexp_replace(fixed, r"\.$", ""))
        .otherwise(F.regexp_replace(scientific, r"\.?0*e", "e"))
    )
