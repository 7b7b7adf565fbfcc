"""The rule sets of the three layer boundaries.

Order, names, thresholds and severities are fixed values: the order is the
order in which quarantined rows list what they broke.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lockgate import layouts as L
from lockgate.operators.rules import (
    RuleSet,
    Severity,
    accepted_values,
    in_range,
    non_negative,
    not_null,
    ordered,
    row_count_at_least,
    satisfies,
    unique,
)


def bronze_ruleset(*, min_rows: int = 1) -> RuleSet:
    """Can the row be read at all?"""
    most = {"threshold": 0.98}
    rules = (
        not_null("pickup_at"),
        not_null("dropoff_at"),
        ordered("pickup_at", "dropoff_at", strict=True, **most),
        non_negative("fare_amount", **most),
        in_range("fare_amount", 0.0, L.LARGEST_FARE, **most),
        in_range("trip_distance", 0.0, L.LONGEST_TRIP_MILES, **most),
        in_range("pu_location_id", 1, L.LAST_ZONE, **most),
        in_range("do_location_id", 1, L.LAST_ZONE, **most),
        accepted_values("payment_type", L.PAYMENT_TYPES, **most),
        accepted_values(
            "rate_code_id", L.RATE_CODES, allow_null=True, severity=Severity.WARN, **most
        ),
        not_null("passenger_count", severity=Severity.WARN, threshold=0.95, quarantine=False),
        non_negative("tip_amount", allow_null=True, threshold=0.99),
        non_negative("total_amount", **most),
    )
    return RuleSet("bronze", rules, (row_count_at_least(min_rows),))


def silver_ruleset(*, min_rows: int = 1) -> RuleSet:
    """Are the derived values physically possible?"""
    nearly_all = {"threshold": 0.99}
    rules = (
        not_null("trip_id"),
        in_range("trip_duration_min", 0.0, L.LONGEST_TRIP_MINUTES, **nearly_all),
        satisfies(
            "positive_duration",
            F.col("trip_duration_min") > 0,
            "trip_duration_min must be greater than zero",
            columns=("trip_duration_min",),
            **nearly_all,
        ),
        in_range("avg_speed_mph", 0.0, L.FASTEST_MPH, allow_null=True, **nearly_all),
        in_range(
            "tip_pct", 0.0, L.LARGEST_TIP_PCT, allow_null=True, severity=Severity.WARN, **nearly_all
        ),
        not_null(L.PARTITION),
        in_range("pickup_hour", 0, 23),
    )
    return RuleSet("silver", rules, (unique("trip_id"), row_count_at_least(min_rows)))


def gold_ruleset(*, min_rows: int = 1) -> RuleSet:
    """Does the mart look like an aggregate of trips?"""
    rules = (
        not_null(L.PARTITION),
        not_null("pu_location_id"),
        satisfies(
            "positive_trips",
            F.col("trips") > 0,
            "every published group must contain at least one trip",
            columns=("trips",),
        ),
        non_negative("total_revenue", allow_null=True, threshold=0.99),
        in_range("airport_trip_share", 0.0, 1.0, allow_null=True),
        in_range(
            "median_duration_min", 0.0, L.LONGEST_TRIP_MINUTES, allow_null=True, threshold=0.99
        ),
    )
    return RuleSet("gold", rules, (row_count_at_least(min_rows),))


STAGE_RULESETS = {"bronze": bronze_ruleset, "silver": silver_ruleset, "gold": gold_ruleset}
