"""The SQL side of the checks, written for DuckDB and apart from the library."""

from __future__ import annotations

from checks.trips import CLEAN_FEED, DIRTY_FEED, trips_sql

DATES = ("2026-06-03", "2026-06-05")
DAY = "2026-06-03"
ABSENT_DAY = "2030-01-01"
LAST_DAY = "2026-06-07"


def rnd(value: str, places: int) -> str:
    """Half-up rounding of a double's shortest decimal text."""
    text = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18))"
    return f"CAST(round({text}, {places}) AS DOUBLE)"


def mean(value: str) -> str:
    return f"CAST(SUM(CAST({value} AS DECIMAL(18,6))) AS DOUBLE) / NULLIF(COUNT({value}), 0)"


RENAMED = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_at",
    "tpep_dropoff_datetime": "dropoff_at",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "airport_fee",
}
KEY = (
    "vendor_id pickup_at dropoff_at pu_location_id do_location_id"
    " trip_distance fare_amount total_amount"
).split()

NORMALIZED = (
    "SELECT "
    + ", ".join(f"{old} AS {new}" for old, new in RENAMED.items())
    + ", upper(trim(store_and_fwd_flag)) AS store_and_fwd_flag FROM raw"
)
TRIP_ID = (
    "sha256(concat_ws('|', "
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in KEY)
    + "))"
)
SHAPED = (
    f"SELECT *, {TRIP_ID} AS trip_id, CAST(pickup_at AS DATE) AS pickup_date FROM normalized"
)

DURATION = rnd("date_diff('second', pickup_at, dropoff_at) / CAST(60 AS DOUBLE)", 3)
DAY_PART = (
    "CASE WHEN pickup_hour BETWEEN 0 AND 5 THEN 'overnight'"
    " WHEN pickup_hour BETWEEN 6 AND 11 THEN 'morning'"
    " WHEN pickup_hour BETWEEN 12 AND 16 THEN 'afternoon'"
    " WHEN pickup_hour BETWEEN 17 AND 21 THEN 'evening'"
    " WHEN pickup_hour BETWEEN 22 AND 23 THEN 'night' END"
)
AIRPORT = "(coalesce(rate_code_id IN (2, 3), false) OR coalesce(airport_fee > 0, false))"


def enriched(source: str) -> str:
    hours = "(trip_duration_min / CAST(60 AS DOUBLE))"
    speed = f"CASE WHEN {hours} > 0 THEN trip_distance / {hours} END"
    per_mile = "CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END"
    tip = "CASE WHEN fare_amount > 0 THEN tip_amount * CAST(100 AS DOUBLE) / fare_amount END"
    return f"""SELECT *, {rnd(speed, 2)} AS avg_speed_mph, {rnd(per_mile, 2)} AS fare_per_mile,
      {rnd(tip, 2)} AS tip_pct, {DAY_PART} AS time_of_day, {AIRPORT} AS is_airport_trip
      FROM (SELECT *, {DURATION} AS trip_duration_min,
              CAST(hour(pickup_at) AS INT) AS pickup_hour,
              CAST(dayofweek(pickup_at) + 1 AS INT) AS pickup_day_of_week FROM {source})"""


def mart(source: str) -> str:
    airport = "avg(CASE WHEN is_airport_trip THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"
    revenue = "CAST(SUM(CAST(total_amount AS DECIMAL(18,6))) AS DOUBLE)"
    return f"""SELECT pickup_date, pu_location_id, count(*) AS trips,
      {rnd(revenue, 2)} AS total_revenue, {rnd(mean('trip_distance'), 3)} AS avg_trip_distance,
      {rnd(mean('trip_duration_min'), 2)} AS avg_duration_min,
      {rnd('quantile_disc(trip_duration_min, 0.5)', 2)} AS median_duration_min,
      {rnd(mean('tip_pct'), 2)} AS avg_tip_pct, {rnd(airport, 4)} AS airport_trip_share
      FROM {source} GROUP BY pickup_date, pu_location_id"""


# (name, condition, description, severity, threshold, quarantine, columns)
BRONZE = [
    ("not_null[pickup_at]", "pickup_at IS NOT NULL", "pickup_at must not be null",
     "error", 1.0, True, "pickup_at"),
    ("not_null[dropoff_at]", "dropoff_at IS NOT NULL", "dropoff_at must not be null",
     "error", 1.0, True, "dropoff_at"),
    ("ordered[pickup_at<dropoff_at]", "pickup_at < dropoff_at",
     "pickup_at must be strictly before dropoff_at", "error", 0.98, True, "pickup_at,dropoff_at"),
    ("non_negative[fare_amount]", "fare_amount >= 0", "fare_amount must be >= 0",
     "error", 0.98, True, "fare_amount"),
    ("in_range[fare_amount]", "fare_amount BETWEEN 0 AND 5000",
     "fare_amount must be between 0.0 and 5000.0", "error", 0.98, True, "fare_amount"),
    ("in_range[trip_distance]", "trip_distance BETWEEN 0 AND 200",
     "trip_distance must be between 0.0 and 200.0", "error", 0.98, True, "trip_distance"),
    ("in_range[pu_location_id]", "pu_location_id BETWEEN 1 AND 265",
     "pu_location_id must be between 1 and 265", "error", 0.98, True, "pu_location_id"),
    ("in_range[do_location_id]", "do_location_id BETWEEN 1 AND 265",
     "do_location_id must be between 1 and 265", "error", 0.98, True, "do_location_id"),
    ("accepted_values[payment_type]", "payment_type IN (1, 2, 3, 4, 5, 6)",
     "payment_type must be one of (1, 2, 3, 4, 5, 6)", "error", 0.98, True, "payment_type"),
    ("accepted_values[rate_code_id]",
     "rate_code_id IS NULL OR rate_code_id IN (1, 2, 3, 4, 5, 6)",
     "rate_code_id must be one of (1, 2, 3, 4, 5, 6)", "warn", 0.98, True, "rate_code_id"),
    ("not_null[passenger_count]", "passenger_count IS NOT NULL",
     "passenger_count must not be null", "warn", 0.95, False, "passenger_count"),
    ("non_negative[tip_amount]", "tip_amount IS NULL OR tip_amount >= 0",
     "tip_amount must be null or >= 0", "error", 0.99, True, "tip_amount"),
    ("non_negative[total_amount]", "total_amount >= 0", "total_amount must be >= 0",
     "error", 0.98, True, "total_amount"),
]
SILVER = [
    ("not_null[trip_id]", "trip_id IS NOT NULL", "trip_id must not be null",
     "error", 1.0, True, "trip_id"),
    ("in_range[trip_duration_min]", "trip_duration_min BETWEEN 0 AND 720",
     "trip_duration_min must be between 0.0 and 720", "error", 0.99, True, "trip_duration_min"),
    ("positive_duration", "trip_duration_min > 0", "trip_duration_min must be greater than zero",
     "error", 0.99, True, "trip_duration_min"),
    ("in_range[avg_speed_mph]", "avg_speed_mph IS NULL OR avg_speed_mph BETWEEN 0 AND 90",
     "avg_speed_mph must be null or between 0.0 and 90.0", "error", 0.99, True, "avg_speed_mph"),
    ("in_range[tip_pct]", "tip_pct IS NULL OR tip_pct BETWEEN 0 AND 1000",
     "tip_pct must be null or between 0.0 and 1000.0", "warn", 0.99, True, "tip_pct"),
    ("not_null[pickup_date]", "pickup_date IS NOT NULL", "pickup_date must not be null",
     "error", 1.0, True, "pickup_date"),
    ("in_range[pickup_hour]", "pickup_hour BETWEEN 0 AND 23",
     "pickup_hour must be between 0 and 23", "error", 1.0, True, "pickup_hour"),
]
GOLD = [
    ("not_null[pickup_date]", "pickup_date IS NOT NULL", "pickup_date must not be null",
     "error", 1.0, True, "pickup_date"),
    ("not_null[pu_location_id]", "pu_location_id IS NOT NULL", "pu_location_id must not be null",
     "error", 1.0, True, "pu_location_id"),
    ("positive_trips", "trips > 0", "every published group must contain at least one trip",
     "error", 1.0, True, "trips"),
    ("non_negative[total_revenue]", "total_revenue IS NULL OR total_revenue >= 0",
     "total_revenue must be null or >= 0", "error", 0.99, True, "total_revenue"),
    ("in_range[airport_trip_share]",
     "airport_trip_share IS NULL OR airport_trip_share BETWEEN 0 AND 1",
     "airport_trip_share must be null or between 0.0 and 1.0",
     "error", 1.0, True, "airport_trip_share"),
    ("in_range[median_duration_min]",
     "median_duration_min IS NULL OR median_duration_min BETWEEN 0 AND 720",
     "median_duration_min must be null or between 0.0 and 720",
     "error", 0.99, True, "median_duration_min"),
]
# (name, metric, bound, description, severity, columns)
ROW_COUNT = ("row_count_at_least", "count(*)", ">= 1",
             "dataset must contain at least 1 rows", "error", "")
UNIQUE = ("unique[trip_id]", "count(trip_id) - count(DISTINCT trip_id)", "= 0",
          "trip_id must be unique", "error", "trip_id")


def holds(rules) -> str:
    return " AND ".join(f"coalesce({rule[1]}, false)" for rule in rules if rule[5])


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def broken(rules) -> str:
    """The broken rules as one comma-separated text, in rule order."""
    names = [
        f"CASE WHEN NOT coalesce({rule[1]}, false) THEN {quote(rule[0])} END"
        for rule in rules
        if rule[5]
    ]
    return f"concat_ws(',', {', '.join(names)})"


def report(source: str, stage: str, row_rules, dataset_rules=(), by: str = "") -> str:
    """One row per rule; ``by`` adds a leading column with one report per value."""
    key = f"{by}, " if by else ""
    counts = ["count(*) AS total_rows"]
    counts += [
        f"count(*) FILTER (WHERE coalesce({r[1]}, false)) AS h{i}" for i, r in enumerate(row_rules)
    ]
    counts += [f"CAST({d[1]} AS DOUBLE) AS m{i}" for i, d in enumerate(dataset_rules)]
    group = f" GROUP BY {by}" if by else ""
    measured = f"(SELECT {key}{', '.join(counts)} FROM {source}{group})"
    parts = []
    head = f"{key}{quote(stage)} AS stage"
    for i, (name, _, text, severity, threshold, _, columns) in enumerate(row_rules):
        rate = f"(CASE WHEN total_rows = 0 THEN CAST(1 AS DOUBLE) ELSE h{i} / total_rows END)"
        parts.append(
            f"SELECT {head}, CAST({i} AS INT) AS position, {quote(name)} AS rule,"
            f" {quote(text)} AS description, '{severity}' AS severity, 'row' AS kind,"
            f" {rate} >= CAST({threshold} AS DOUBLE) AS passed, {quote(columns)} AS columns,"
            f" CAST({threshold} AS DOUBLE) AS threshold, {rate} AS pass_rate,"
            f" total_rows - h{i} AS failing_rows, total_rows, CAST(NULL AS DOUBLE) AS metric"
            f" FROM measured"
        )
    for i, (name, _, bound, text, severity, columns) in enumerate(dataset_rules):
        parts.append(
            f"SELECT {head}, CAST({len(row_rules) + i} AS INT) AS position, {quote(name)} AS rule,"
            f" {quote(text)} AS description, '{severity}' AS severity, 'dataset' AS kind,"
            f" coalesce(m{i} {bound}, false) AS passed, {quote(columns)} AS columns,"
            f" CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS DOUBLE) AS pass_rate,"
            f" CAST(NULL AS BIGINT) AS failing_rows, total_rows, m{i} AS metric FROM measured"
        )
    return f"(WITH measured AS {measured} " + "\nUNION ALL ".join(parts) + ")"


def with_views(select: str, *, period: int = CLEAN_FEED, gated: bool = True) -> str:
    """Prefixes the layers as common table expressions.

    ``gated`` off models a run without quarantine.
    """
    keep_bronze = holds(BRONZE) if gated else "true"
    keep_silver = holds(SILVER) if gated else "true"
    columns = ", ".join([*RENAMED.values(), "store_and_fwd_flag"])
    return f"""WITH raw AS ({trips_sql(period)}),
    dirty_raw AS ({trips_sql(DIRTY_FEED)}),
    normalized AS ({NORMALIZED}),
    dirty_normalized AS ({NORMALIZED.replace('FROM raw', 'FROM dirty_raw')}),
    shaped AS ({SHAPED}),
    dirty_shaped AS ({SHAPED.replace('FROM normalized', 'FROM dirty_normalized')}),
    bronze AS (SELECT * FROM shaped WHERE {keep_bronze}),
    rejected AS (SELECT *, {broken(BRONZE)} AS dq_failures FROM shaped WHERE NOT ({holds(BRONZE)})),
    deduplicated AS (SELECT * EXCLUDE (copy_number) FROM (
      SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY {columns}) AS copy_number
      FROM bronze) WHERE copy_number = 1),
    silver_in AS ({enriched('deduplicated')}),
    silver AS (SELECT * FROM silver_in WHERE {keep_silver}),
    gold AS ({mart('silver')})
    {select}"""


BRONZE_REPORT = report("shaped", "bronze", BRONZE, [ROW_COUNT])
DIRTY_REPORT = report("dirty_shaped", "bronze", BRONZE, [ROW_COUNT])
SILVER_REPORT = report("silver_in", "silver", SILVER, [UNIQUE, ROW_COUNT])
GOLD_REPORT = report("gold", "gold", GOLD, [ROW_COUNT])


def custom(rules, dataset_rules=(), source: str = "shaped") -> str:
    return with_views(f"SELECT * FROM {report(source, 'custom', rules, dataset_rules)}")


VERDICT_COLUMNS = """max(total_rows) AS total_rows, count(*) AS rules,
    count(*) FILTER (WHERE NOT passed AND severity = 'error') AS error_count,
    count(*) FILTER (WHERE NOT passed AND severity = 'warn') AS warning_count,
    coalesce(string_agg(CASE WHEN NOT passed AND severity = 'error' THEN rule END, ','
             ORDER BY position), '') AS errors,
    coalesce(string_agg(CASE WHEN NOT passed AND severity = 'warn' THEN rule END, ','
             ORDER BY position), '') AS warnings,
    count(*) FILTER (WHERE NOT passed AND severity = 'error') = 0 AS passed"""


def verdict(source: str, by: str = "stage") -> str:
    return f"SELECT {by}, {VERDICT_COLUMNS} FROM {source} GROUP BY {by}"


RULE_LINE = """CASE WHEN passed THEN '[PASS] ' ELSE '[FAIL] ' END || rule || ': ' ||
    CASE WHEN kind = 'row' THEN printf('%.4f%%', pass_rate * 100) || ' pass (need '
              || printf('%.2f%%', threshold * 100) || ')'
              || CASE WHEN failing_rows > 0
                      THEN ', ' || format('{:,}', failing_rows) || ' bad rows' ELSE '' END
         ELSE 'metric=' || format('{:g}', metric) END"""

#: What two loads of late trips bring: one group of zones comes late, and for two days only.
ARRIVED = "(pu_location_id % 10 <> 3 OR day(pickup_date) IN (2, 4))"
UNDATED = f"""SELECT count(*) FILTER (WHERE inside) AS rows_in,
    count(*) FILTER (WHERE inside AND kept) AS rows_out,
    count(*) FILTER (WHERE inside AND NOT kept) AS rows_quarantined,
    count(*) FILTER (WHERE missing) AS rows_without_date
    FROM (SELECT pu_location_id % 50 = 7 AS missing, {holds(BRONZE)} AS kept, pu_location_id % 50 <> 7
            AND pickup_date BETWEEN DATE '{DATES[0]}' AND DATE '{DATES[1]}' AS inside FROM shaped)"""

# --- history: one run per pickup day; the last day of "bronze" is dirty ---


def run_columns(day: str) -> str:
    return (
        f"strftime(CAST({day} AS TIMESTAMP), '%Y%m%dT%H%M%SZ') AS run_id,"
        f" strftime(CAST({day} AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') AS recorded_at"
    )


_BY_DAY = report("shaped", "bronze", BRONZE, [ROW_COUNT], by="pickup_date")
_DIRTY_BY_DAY = report("dirty_shaped", "bronze", BRONZE, [ROW_COUNT], by="pickup_date")
_OTHER_BY_DAY = report("dirty_shaped", "dirty", BRONZE, [ROW_COUNT], by="pickup_date")
HISTORY = f"""(SELECT * EXCLUDE (pickup_date), {run_columns('pickup_date')} FROM (
    SELECT * FROM {_BY_DAY} WHERE pickup_date <> DATE '{LAST_DAY}'
    UNION ALL SELECT * FROM {_DIRTY_BY_DAY} WHERE pickup_date = DATE '{LAST_DAY}'
    UNION ALL SELECT * FROM {_OTHER_BY_DAY}))"""
RUNS = f"({verdict(HISTORY, 'stage, run_id, recorded_at')})"
RESULT_COLUMNS = (
    "stage, position, rule, description, severity, kind, passed, columns, threshold,"
    " pass_rate, failing_rows, total_rows, metric"
)


def trend(previous: str, current: str, tolerance: float = 0.005) -> str:
    """``previous`` and ``current`` are reports with a run_id column."""
    delta = "(c.pass_rate - p.pass_rate)"
    kind = f"""CASE WHEN p.rule IS NULL THEN 'new' WHEN c.rule IS NULL THEN 'dropped'
      WHEN p.passed AND NOT c.passed THEN 'regressed'
      WHEN NOT p.passed AND c.passed THEN 'improved'
      WHEN {delta} < -CAST({tolerance} AS DOUBLE) THEN 'regressed'
      WHEN {delta} > CAST({tolerance} AS DOUBLE) THEN 'improved' ELSE 'steady' END"""
    return f"""(SELECT stage, rule, p.pass_rate AS previous_pass_rate,
      c.pass_rate AS current_pass_rate, p.passed AS previous_passed, c.passed AS current_passed,
      max(p.total_rows) OVER s AS previous_rows, max(c.total_rows) OVER s AS current_rows,
      max(p.run_id) OVER s AS previous_run_id, max(c.run_id) OVER s AS current_run_id,
      {delta} AS delta, {kind} AS kind,
      coalesce(p.passed AND NOT c.passed, false) AS broke,
      coalesce(c.severity, p.severity) AS severity, coalesce(c.position, p.position) AS position,
      CAST({tolerance} AS DOUBLE) AS tolerance
      FROM {previous} p FULL JOIN {current} c USING (stage, rule)
      WINDOW s AS (PARTITION BY stage))"""


# The current report lacks one rule and has one more than the previous one.
_EXTRA_RULE = ("in_range[extra]", "extra BETWEEN 0 AND 1",
               "extra must be between 0.0 and 1.0", "error", 0.5, True, "extra")
CHANGED_RULES = [rule for rule in BRONZE if rule[0] != "non_negative[tip_amount]"] + [_EXTRA_RULE]
TREND = trend(
    f"(SELECT *, 'clean' AS run_id FROM {BRONZE_REPORT})",
    "(SELECT *, 'dirty' AS run_id FROM "
    f"{report('dirty_shaped', 'bronze', CHANGED_RULES, [ROW_COUNT])})",
)
_PREVIOUS = f"(SELECT * FROM {HISTORY} WHERE run_id = '20260606T000000Z')"
_CURRENT = f"(SELECT * FROM {HISTORY} WHERE run_id = '20260607T000000Z')"
TREND_LATEST = trend(_PREVIOUS, _CURRENT)
TREND_SUMMARY = f"""SELECT stage, previous_run_id, current_run_id, previous_rows, current_rows,
    tolerance, count(*) FILTER (WHERE kind = 'regressed') AS regression_count,
    count(*) FILTER (WHERE kind = 'improved') AS improvement_count,
    count(*) FILTER (WHERE broke) AS broken_count,
    current_rows - previous_rows AS row_delta,
    count(*) FILTER (WHERE kind = 'regressed') = 0 AS stable,
    CASE WHEN previous_rows > 0 THEN (current_rows - previous_rows) / previous_rows END AS row_change
    FROM {TREND_LATEST}
    GROUP BY stage, previous_run_id, current_run_id, previous_rows, current_rows, tolerance"""
TREND_LINE = """'[' || CASE kind WHEN 'regressed' THEN 'DOWN' WHEN 'improved' THEN ' UP '
      WHEN 'steady' THEN '  = ' WHEN 'new' THEN 'NEW ' ELSE 'GONE' END || '] ' || rule || ': ' ||
    CASE WHEN kind = 'new'
           THEN 'not checked last run, now ' || coalesce(printf('%.4f%%', current_pass_rate * 100), '-')
         WHEN kind = 'dropped'
           THEN 'was ' || coalesce(printf('%.4f%%', previous_pass_rate * 100), '-') || ', no longer checked'
         WHEN delta IS NULL THEN CASE WHEN previous_passed THEN 'pass' ELSE 'fail' END || ' -> '
           || CASE WHEN current_passed THEN 'pass' ELSE 'fail' END
         ELSE printf('%.4f%%', previous_pass_rate * 100) || ' -> '
           || printf('%.4f%%', current_pass_rate * 100) || ' (' || printf('%+.4f%%', delta * 100) || ')'
    END || CASE WHEN broke THEN ', now below its threshold' ELSE '' END"""

# --- layouts of the seven daily extracts ---

LAYOUT = [
    ("VendorID", "int"), ("tpep_pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "timestamp"), ("passenger_count", "bigint"),
    ("trip_distance", "double"), ("RatecodeID", "bigint"), ("store_and_fwd_flag", "string"),
    ("PULocationID", "int"), ("DOLocationID", "int"), ("payment_type", "bigint"),
    ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"),
    ("tip_amount", "double"), ("tolls_amount", "double"), ("improvement_surcharge", "double"),
    ("total_amount", "double"), ("congestion_surcharge", "double"), ("airport_fee", "double"),
]


def _stored_layouts() -> dict[int, list[tuple[str, str]]]:
    retyped = {"VendorID": "smallint", "passenger_count": "int"}
    recased = {"VendorID": "vendorid", "PULocationID": "pulocationid"}
    return {
        1: LAYOUT,
        2: LAYOUT[::-1],
        3: [(name, retyped.get(name, kind)) for name, kind in LAYOUT],
        4: [column for column in LAYOUT if column[0] != "airport_fee"],
        5: [*LAYOUT, ("vendor_note", "string")],
        6: [(recased.get(n, n), "float" if n == "trip_distance" else k) for n, k in LAYOUT],
        7: [(n, "string" if n == "fare_amount" else k) for n, k in LAYOUT],
    }


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(rows_) + ")" for rows_ in rows)


STORED_SCHEMA = (
    "SELECT CAST(d AS INT) AS day, CAST(o AS INT) AS ordinal, c AS column_name, t AS stored_type"
    " FROM (VALUES "
    + _values(
        (str(day), str(i), quote(name), quote(kind))
        for day, layout in _stored_layouts().items()
        for i, (name, kind) in enumerate(layout)
    )
    + ") v(d, o, c, t) WHERE (SELECT count(*) FROM lineitem) > 0"
)
# day, position, column, kind, expected, actual, blocking, summary
DRIFT = [
    (3, 0, "VendorID", "widened", "int", "smallint", False,
     "[WARN ] widened[VendorID]: declared int, stored as smallint"),
    (3, 1, "passenger_count", "widened", "bigint", "int", False,
     "[WARN ] widened[passenger_count]: declared bigint, stored as int"),
    (4, 0, "airport_fee", "missing", "double", None, True,
     "[BLOCK] missing[airport_fee]: declared double, absent from the source"),
    (5, 0, "vendor_note", "unexpected", None, "string", False,
     "[WARN ] unexpected[vendor_note]: stored as string, never declared"),
    (6, 0, "VendorID", "recased", "VendorID", "vendorid", False,
     "[WARN ] recased[VendorID]: declared 'VendorID', stored as 'vendorid'"),
    (6, 1, "trip_distance", "widened", "double", "float", False,
     "[WARN ] widened[trip_distance]: declared double, stored as float"),
    (6, 2, "PULocationID", "recased", "PULocationID", "pulocationid", False,
     "[WARN ] recased[PULocationID]: declared 'PULocationID', stored as 'pulocationid'"),
    (7, 0, "fare_amount", "mismatched", "double", "string", True,
     "[BLOCK] mismatched[fare_amount]: declared double, stored as string"),
]


def drift_sql(rows) -> str:
    cells = (
        (
            str(day), str(position), quote(column), quote(kind),
            "NULL" if expected is None else quote(expected),
            "NULL" if actual is None else quote(actual),
            str(blocking).lower(), quote(summary),
        )
        for day, position, column, kind, expected, actual, blocking, summary in rows
    )
    return (
        "SELECT CAST(d AS INT) AS day, CAST(p AS INT) AS position, c AS column_name, k AS kind,"
        " CAST(e AS VARCHAR) AS expected, CAST(a AS VARCHAR) AS actual, b AS blocking, s AS summary"
        f" FROM (VALUES {_values(cells)}) v(d, p, c, k, e, a, b, s)"
        " WHERE (SELECT count(*) FROM lineitem) > 0"
    )


# Without types only the renamed, missing and added columns show.
NAMES_DRIFT = [
    (day, 1 if column == "PULocationID" else 0, column, kind, *rest)
    for day, _, column, kind, *rest in DRIFT
    if kind in ("recased", "missing", "unexpected")
]
DRIFT_SUMMARY = """SELECT CAST(d AS INT) AS day, b = 0 AS conforms, CAST(19 AS INT) AS declared_columns,
    CAST(n AS INT) AS stored_columns, true AS types_checked, CAST(b AS INT) AS blocking_count,
    CAST(a AS INT) AS advisory_count
    FROM (VALUES (1, 19, 0, 0), (2, 19, 0, 0), (3, 19, 0, 2), (4, 18, 1, 0), (5, 20, 0, 1),
                 (6, 19, 0, 3), (7, 19, 1, 0)) v(d, n, b, a)
    WHERE (SELECT count(*) FROM lineitem) > 0"""

# 2^-30 and 2^44 times whole numbers: sums of whole numbers are exact.
EXACT_SUMS = """SELECT l_returnflag, CAST(n AS DOUBLE) * power(2, -30) AS tiny_sum,
    CAST(odd AS DOUBLE) * power(2, 44) + CAST(n - odd AS DOUBLE) * power(2, -30) AS wide_sum,
    odds > 0 AS sum_is_nan
    FROM (SELECT l_returnflag, SUM(CAST(floor(l_quantity) AS BIGINT)) AS n,
            SUM(CASE WHEN l_linenumber = 7 THEN CAST(floor(l_quantity) AS BIGINT) ELSE 0 END) AS odd,
            SUM(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS odds
          FROM lineitem GROUP BY l_returnflag)"""

RAW_COLUMNS = ", ".join(name for name, _ in LAYOUT)
BRONZE_COLUMNS = ", ".join([*RENAMED.values(), "store_and_fwd_flag", "trip_id", "pickup_date"])
SILVER_COLUMNS = BRONZE_COLUMNS + (
    ", trip_duration_min, avg_speed_mph, fare_per_mile, tip_pct, pickup_hour,"
    " pickup_day_of_week, time_of_day, is_airport_trip"
)


def _stage_counts() -> str:
    return with_views(
        """SELECT 'bronze' AS stage, (SELECT count(*) FROM shaped) AS rows_in,
             (SELECT count(*) FROM bronze) AS rows_out,
             (SELECT count(*) FROM rejected) AS rows_quarantined, true AS passed
           UNION ALL SELECT 'silver', (SELECT count(*) FROM bronze), (SELECT count(*) FROM silver),
             (SELECT count(*) FROM silver_in) - (SELECT count(*) FROM silver), true
           UNION ALL SELECT 'gold', (SELECT count(*) FROM silver), (SELECT count(*) FROM gold),
             CAST(0 AS BIGINT), true"""
    )


def _rule(name, condition, text, columns, severity="error", threshold=1.0):
    return (name, condition, text, severity, threshold, True, columns)


def oracle() -> dict[str, str]:
    v = with_views
    dirty_gold = f"({mart('dirty_silver')})"
    dirty_layers = f""", dirty_bronze AS (SELECT * FROM dirty_shaped WHERE {holds(BRONZE)}),
      dirty_distinct AS (SELECT DISTINCT * FROM dirty_bronze),
      dirty_silver_in AS ({enriched('dirty_distinct')}),
      dirty_silver AS (SELECT * FROM dirty_silver_in WHERE {holds(SILVER)})"""
    dirty = lambda select: v("SELECT 1").replace("\n    SELECT 1", f"{dirty_layers} {select}")
    found = {
        # sources and sinks
        "scan_declared": v(
            f"SELECT {RAW_COLUMNS.replace('airport_fee', '')}"
            " CASE WHEN CAST(tpep_pickup_datetime AS DATE) = DATE '2026-06-04' THEN NULL"
            " ELSE airport_fee END AS airport_fee FROM raw"
        ),
        "scan_csv_declared": v(f"SELECT {RAW_COLUMNS} FROM raw"),
        "stored_schema": STORED_SCHEMA,
        "schema_drift": drift_sql(DRIFT),
        "schema_drift_names_only": drift_sql(NAMES_DRIFT),
        "schema_drift_summary": DRIFT_SUMMARY,
        "flat_overwrite": v(f"SELECT * FROM gold WHERE pickup_date = DATE '{DAY}'"),
        "backfill_one_day": dirty(
            f"SELECT * FROM gold WHERE pickup_date <> DATE '{DAY}' UNION ALL"
            f" SELECT * FROM {dirty_gold} WHERE pickup_date = DATE '{DAY}'"
        ),
        "stale_partitions": v(
            f"SELECT {BRONZE_COLUMNS} FROM bronze"
            f" WHERE pickup_date NOT BETWEEN DATE '{DATES[0]}' AND DATE '{DATES[1]}'"
            f" OR pickup_date = DATE '{DAY}'"
        ),
        "publish_guard": v(
            f"""SELECT '{DAY}' AS day, count(*) AS rows_in,
                count(*) FILTER (WHERE {holds(BRONZE)}) AS rows_out, 'published' AS outcome
                FROM shaped WHERE pickup_date = DATE '{DAY}'
              UNION ALL SELECT '{ABSENT_DAY}', count(*), CAST(0 AS BIGINT), 'refused'
                FROM shaped WHERE pickup_date = DATE '{ABSENT_DAY}'"""
        ),
        # projections and filters
        "normalize": v(
            f"SELECT {', '.join(RENAMED.values())}, store_and_fwd_flag FROM normalized"
        ),
        "trip_id": v(f"SELECT {', '.join(KEY)}, trip_id FROM shaped"),
        "pickup_date": v("SELECT pickup_at, dropoff_at, pickup_date FROM shaped"),
        "clean": v(f"SELECT {BRONZE_COLUMNS} FROM shaped"),
        "safe_divide": v(
            """SELECT fare_amount, trip_distance, tip_amount,
               CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END AS fare_per_mile,
               CASE WHEN tip_amount > 0 THEN fare_amount / tip_amount END AS fare_per_tip,
               CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount END AS tip_share
               FROM shaped"""
        ),
        "enrich": f"{v('SELECT 1')}".replace(
            "\n    SELECT 1",
            f", enriched_bronze AS ({enriched('bronze')})"
            f" SELECT {SILVER_COLUMNS} FROM enriched_bronze",
        ),
        "calendar": v("SELECT 1").replace(
            "\n    SELECT 1",
            f", e AS ({enriched('shaped')}) SELECT pickup_at, pickup_date, pickup_hour,"
            " pickup_day_of_week, time_of_day FROM e",
        ),
        "airport_flag": v(
            f"SELECT rate_code_id, airport_fee, {AIRPORT} AS is_airport_trip, count(*) AS trips"
            " FROM shaped GROUP BY 1, 2, 3"
        ),
        "window_filter": v(
            f"SELECT {BRONZE_COLUMNS} FROM shaped"
            f" WHERE pickup_date BETWEEN DATE '{DATES[0]}' AND DATE '{DATES[1]}'"
        ),
        # rules
        "rule_not_null": custom(
            [
                _rule("not_null[passenger_count]", "passenger_count IS NOT NULL",
                      "passenger_count must not be null", "passenger_count"),
                _rule("not_null[rate_code_id]", "rate_code_id IS NOT NULL",
                      "rate_code_id must not be null", "rate_code_id", "warn", 0.9),
            ]
        ),
        "rule_in_range": custom(
            [
                _rule("in_range[trip_distance]", "trip_distance BETWEEN 1 AND 10",
                      "trip_distance must be between 1.0 and 10.0", "trip_distance"),
                _rule("in_range[rate_code_id]", "rate_code_id BETWEEN 1 AND 3",
                      "rate_code_id must be between 1 and 3", "rate_code_id"),
                _rule("rate_code_or_null", "rate_code_id IS NULL OR rate_code_id BETWEEN 1 AND 3",
                      "rate_code_id must be null or between 1 and 3", "rate_code_id"),
            ]
        ),
        "rule_non_negative": custom(
            [
                _rule("non_negative[fare_amount]", "fare_amount >= 0",
                      "fare_amount must be >= 0", "fare_amount", "error", 0.99),
                _rule("non_negative[passenger_count]", "passenger_count >= 0",
                      "passenger_count must be >= 0", "passenger_count"),
                _rule("passengers_or_null", "passenger_count IS NULL OR passenger_count >= 0",
                      "passenger_count must be null or >= 0", "passenger_count"),
            ]
        ),
        "rule_accepted_values": custom(
            [
                _rule("accepted_values[payment_type]", "payment_type IN (1, 2)",
                      "payment_type must be one of (1, 2)", "payment_type"),
                _rule("accepted_values[store_and_fwd_flag]", "store_and_fwd_flag IN ('Y', 'N')",
                      "store_and_fwd_flag must be one of (Y, N)", "store_and_fwd_flag"),
                _rule("rate_code_or_null", "rate_code_id IS NULL OR rate_code_id IN (1)",
                      "rate_code_id must be one of (1)", "rate_code_id"),
            ]
        ),
        "rule_ordered": custom(
            [
                _rule("ordered[pickup_at<dropoff_at]", "pickup_at < dropoff_at",
                      "pickup_at must be strictly before dropoff_at", "pickup_at,dropoff_at"),
                _rule("ordered[tip_amount<fare_amount]", "tip_amount <= fare_amount",
                      "tip_amount must be at or before fare_amount", "tip_amount,fare_amount"),
                _rule("ordered[rate_code_id<payment_type]", "rate_code_id < payment_type",
                      "rate_code_id must be strictly before payment_type",
                      "rate_code_id,payment_type"),
            ]
        ),
        "rule_satisfies": custom(
            [
                _rule("standard_rate", "rate_code_id = 1", "most trips run at rate 1",
                      "rate_code_id", "warn", 0.75),
                _rule("total_covers_fare", "total_amount >= fare_amount",
                      "the total includes the fare", "total_amount,fare_amount"),
            ]
        ),
        "rule_unique": custom([], [UNIQUE]),
        "rule_row_count": custom(
            [],
            [
                ROW_COUNT,
                ("a_billion_rows", "count(*)", ">= 1000000000",
                 "dataset must contain at least 1000000000 rows", "warn", ""),
            ],
        ),
        "quality_bronze": v(f"SELECT * FROM {BRONZE_REPORT}"),
        "quality_silver": v(f"SELECT * FROM {SILVER_REPORT}"),
        "quality_gold": v(f"SELECT * FROM {GOLD_REPORT}"),
        "quality_by_day": v(f"SELECT * FROM {_BY_DAY}"),
        "empty_dataset_report": v(
            f"SELECT * FROM {report(f'(SELECT * FROM shaped WHERE pickup_date = DATE {quote(ABSENT_DAY)})', 'bronze', BRONZE, [ROW_COUNT])}"
        ),
        "report_rows": v(f"SELECT * FROM {DIRTY_REPORT}"),
        "report_json_roundtrip": v(
            verdict(f"(SELECT * FROM {DIRTY_REPORT} UNION ALL SELECT * FROM {GOLD_REPORT})")
        ),
        "report_summary_lines": v(
            f"SELECT stage, position, {RULE_LINE} AS line FROM"
            f" (SELECT * FROM {DIRTY_REPORT} UNION ALL SELECT * FROM {SILVER_REPORT})"
        ),
        "gate_verdict": v(
            verdict(
                f"(SELECT * FROM {BRONZE_REPORT} UNION ALL"
                f" SELECT * REPLACE ('dirty' AS stage) FROM {DIRTY_REPORT})"
            )
        ),
        "quarantine_rows": v(f"SELECT {BRONZE_COLUMNS}, dq_failures FROM rejected"),
        "quarantine_preview": v(
            "SELECT trip_id, dq_failures FROM rejected ORDER BY trip_id, dq_failures LIMIT 20"
        ),
        "clean_rows": v(f"SELECT {BRONZE_COLUMNS} FROM bronze"),
        "split_no_rules": v(
            "SELECT 'clean' AS half, count(*) AS rows FROM shaped"
            " UNION ALL SELECT 'rejected', CAST(0 AS BIGINT)"
        ),
        # aggregation and deduplication
        "deduplicate": v(f"SELECT {BRONZE_COLUMNS} FROM deduplicated"),
        "gold_daily_zone": v("SELECT * FROM gold"),
        "incremental_load": v("SELECT * FROM gold"),
        # history and trends
        "history_record": v(
            f"SELECT {RESULT_COLUMNS}, run_id, recorded_at FROM {HISTORY}"
        ),
        "history_entries": v(f"SELECT * FROM {RUNS}"),
        "history_latest": v(
            f"SELECT 'newest' AS asked, stage, run_id FROM {RUNS} WHERE run_id LIKE '20260607%'"
            f" UNION ALL SELECT 'before', stage, run_id FROM {RUNS} WHERE run_id LIKE '20260603%'"
            f" UNION ALL SELECT 'unknown', stage, run_id FROM {RUNS} WHERE run_id LIKE '20260607%'"
        ),
        "history_prune": v(f"SELECT * FROM {RUNS} WHERE recorded_at >= '2026-06-05'"),
        "history_unreadable": v(
            "SELECT 'unreadable' AS state, 'bronze' AS stage, '20260602T000000Z' AS run_id"
            f" UNION ALL SELECT 'kept', stage, run_id FROM {RUNS} WHERE recorded_at >= '2026-06-05'"
        ),
        "history_stages": v(f"SELECT DISTINCT stage FROM {RUNS}"),
        "trend_document": v(
            "SELECT stage, count(*) FILTER (WHERE kind = 'regressed') OVER s AS regression_count,"
            " count(*) FILTER (WHERE kind = 'regressed') OVER s = 0 AS stable,"
            " current_rows - previous_rows AS row_delta, rule, kind, current_pass_rate, severity"
            f" FROM {TREND_LATEST} WINDOW s AS (PARTITION BY stage)"
        ),
        "regression_gate": v(
            "SELECT 'changed' AS compared, CASE WHEN count(*) = 0 THEN 'passed'"
            " ELSE 'bronze: ' || count(*) || ' rules' END AS outcome"
            f" FROM {TREND} WHERE kind = 'regressed' UNION ALL SELECT 'same', 'passed'"
        ),
        "window_validation": v(
            "SELECT min(pickup_date) AS since, max(pickup_date) AS until, count(*) AS trips,"
            " 'read' AS outcome FROM shaped UNION ALL"
            " SELECT max(pickup_date), min(pickup_date), 0, 'refused' FROM shaped UNION ALL"
            " SELECT max(pickup_date), CAST(NULL AS DATE), count(*) FILTER (WHERE pickup_date ="
            " (SELECT max(pickup_date) FROM shaped)), 'read' FROM shaped"
        ),
        "rule_trend": v(f"SELECT * FROM {TREND}"),
        "rule_trend_latest": v(f"SELECT * FROM {TREND_LATEST}"),
        "trend_summary": v(TREND_SUMMARY),
        "trend_summary_lines": v(
            f"SELECT stage, rule, {TREND_LINE} AS line FROM {TREND}"
        ),
        # stages and runs
        "run_bronze": v(f"SELECT {BRONZE_COLUMNS} FROM bronze"),
        "run_silver": v(f"SELECT {SILVER_COLUMNS} FROM silver"),
        "run_gold": v("SELECT * FROM gold"),
        "late_rows_merge": v(f"SELECT * FROM gold WHERE {ARRIVED}"),
        "late_rows_bronze": v(f"SELECT {BRONZE_COLUMNS} FROM deduplicated WHERE {ARRIVED}"),
        "late_rows_quarantine": v(
            "SELECT trip_id, dq_failures, pickup_date FROM (SELECT DISTINCT"
            f" {BRONZE_COLUMNS}, dq_failures FROM rejected WHERE {ARRIVED})"
        ),
        "quarantine_after_clean_rerun": v(
            "SELECT trip_id, dq_failures, pickup_date FROM rejected WHERE day(pickup_date) NOT IN (2, 4)"
        ),
        "undated_rows": v(UNDATED),
        "check_mixed_files": v(f"SELECT * FROM {BRONZE_REPORT}"),
        "run_no_gates": dirty(f"SELECT * FROM {dirty_gold}"),
        "run_no_quarantine": v("SELECT * FROM gold", gated=False),
        "backfill_idempotent": v("SELECT * FROM gold"),
        "stage_counts": _stage_counts(),
    }
    found["scan_mixed_files"] = found["scan_declared"]
    found["schema_drift_mixed_files"] = f"SELECT * EXCLUDE (day) FROM ({found['schema_drift']})"
    found["exact_sums"] = EXACT_SUMS
    return found
