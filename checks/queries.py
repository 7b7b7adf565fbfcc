"""One Spark query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.trips import CLEAN_FEED, DIRTY_FEED, trips
from lockgate import layouts as L
from lockgate.functions.expressions import exact_sum, ratio, utc_clock, utc_instant
from lockgate.operators import drift, gate, history, report, trend
from lockgate.operators.evaluate import FAILURES, evaluate, split
from lockgate.operators.mart import INPUT as MART_INPUT
from lockgate.operators.mart import daily_zone_metrics
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
from lockgate.operators.rulesets import bronze_ruleset, gold_ruleset, silver_ruleset
from lockgate.operators.trips import (
    add_pickup_date,
    add_trip_id,
    between_dates,
    clean,
    deduplicate,
    enrich,
    normalize,
    picked_up_between,
)
from lockgate.plans import stages
from lockgate.plans.config import RunConfig
from lockgate.sources.layers import NothingToPublish, read_layer, write_layer
from lockgate.sources.raw import export, read_dataset, read_raw, stored_layouts
from lockgate.sources.storage import scratch_path, stage_table

DAY = date(2026, 6, 3)
WINDOW = (DAY, date(2026, 6, 5))
ABSENT_DAY = date(2030, 1, 1)
LAST_DAY = date(2026, 6, 7)

TIMES = ("tpep_pickup_datetime", "tpep_dropoff_datetime")

# --- layers ---


def shaped(spark: SparkSession, sf_dir: str, period: int = CLEAN_FEED) -> DataFrame:
    return clean(trips(spark, sf_dir, period=period))


def bronze_halves(spark, sf_dir, period=CLEAN_FEED) -> tuple[DataFrame, DataFrame]:
    return split(shaped(spark, sf_dir, period), bronze_ruleset().quarantine_rules())


def enriched(spark, sf_dir, period=CLEAN_FEED) -> DataFrame:
    """Distinct, enriched trips."""
    kept, _ = bronze_halves(spark, sf_dir, period)
    return enrich(deduplicate(kept))


def silver(spark, sf_dir, period=CLEAN_FEED) -> DataFrame:
    return split(enriched(spark, sf_dir, period), silver_ruleset().quarantine_rules())[0]


def gold(spark, sf_dir, period=CLEAN_FEED, sort=True) -> DataFrame:
    """The mart of silver, which is written once as between two stages, as far as it is read."""
    trips_kept = silver(spark, sf_dir, period).select(*MART_INPUT)
    return daily_zone_metrics(stage_table(trips_kept, "silver")[0], sort=sort)


def utc_times(df: DataFrame) -> DataFrame:
    """Time columns as UTC wall clocks, so that comparing needs no time zone."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: utc_clock(df, name) for name in times})


def report_columns(results: DataFrame) -> DataFrame:
    flat = results.withColumnRenamed("name", "rule").drop("ruleset")
    return flat.withColumn("columns", F.concat_ws(",", "columns"))


def reasons(rejected: DataFrame) -> DataFrame:
    return rejected.withColumn("dq_failures", F.concat_ws(",", FAILURES)).drop(FAILURES)


# --- sources ---


def instants(df: DataFrame) -> DataFrame:
    """The times as the declared layout has them."""
    return df.withColumns({name: utc_instant(F.col(name)) for name in TIMES})


def exported(spark, sf_dir, period=CLEAN_FEED, fmt="parquet") -> str:
    path = scratch_path(spark, "raw")
    feed = instants(trips(spark, sf_dir, period=period))
    export(feed.select(*reversed(feed.columns)) if fmt == "csv" else feed, path, fmt=fmt)
    return path


def daily_extracts(spark, sf_dir, fmt="parquet") -> dict[str, int]:
    """All trips as seven extracts, {path: day}, with a layout that changes daily."""
    by_day = scratch_path(spark, "by-day")
    feed = instants(trips(spark, sf_dir)).withColumn("day", F.dayofmonth(TIMES[0]))
    feed = feed.withColumn("day", F.dayofmonth(utc_clock(feed, TIMES[0])))
    feed.write.partitionBy("day").parquet(by_day)
    stored = spark.read.parquet(by_day)

    def narrowed(df):
        as_small = {"VendorID": "smallint", "passenger_count": "int"}
        return df.withColumns({name: F.col(name).cast(kind) for name, kind in as_small.items()})

    def recased(df):
        df = df.withColumn("trip_distance", F.col("trip_distance").cast("float"))
        return df.withColumnsRenamed({"VendorID": "vendorid", "PULocationID": "pulocationid"})

    variants: dict[int, Callable[[DataFrame], DataFrame]] = {
        1: lambda df: df,
        2: lambda df: df.select(*reversed(df.columns)),
        3: narrowed,
        4: lambda df: df.drop("airport_fee"),
        5: lambda df: df.withColumn("vendor_note", F.lit("new")),
        6: recased,
        7: lambda df: df.withColumn("fare_amount", F.col("fare_amount").cast("string")),
    }
    paths = {}
    for day, variant in variants.items():
        path = scratch_path(spark, f"extract-{day}")
        export(variant(stored.filter(F.col("day") == day).drop("day")), path, fmt=fmt)
        paths[path] = day
    return paths


def _day_of(paths: dict[str, int]):
    days = F.create_map(*[F.lit(x) for pair in paths.items() for x in pair])
    return days[F.col("extract")].alias("day")


def _drift_by_day(rows: DataFrame, paths: dict[str, int]) -> DataFrame:
    named = rows.withColumnRenamed("column", "column_name")
    return named.withColumn("day", _day_of(paths)).drop("extract", "files")


def mixed_extract(spark, sf_dir) -> str:
    """The seven layouts as files of one directory, whose name has a space."""
    path = scratch_path(spark, "all in one")
    for daily in daily_extracts(spark, sf_dir):
        spark.read.parquet(daily).write.mode("append").parquet(path)
    return path


def scan_declared(spark, sf_dir):
    return utc_times(read_raw(spark, list(daily_extracts(spark, sf_dir))))


def scan_mixed_files(spark, sf_dir):
    return utc_times(read_raw(spark, mixed_extract(spark, sf_dir)))


def scan_csv_declared(spark, sf_dir):
    return utc_times(read_raw(spark, exported(spark, sf_dir, fmt="csv"), fmt="csv"))


def stored_schema(spark, sf_dir):
    paths = daily_extracts(spark, sf_dir)
    layouts = stored_layouts(spark, list(paths))
    columns = layouts.select(_day_of(paths), F.posexplode("columns").alias("ordinal", "c"))
    return columns.select(
        "day", "ordinal", F.col("c.name").alias("column_name"), F.col("c.type").alias("stored_type")
    )


def schema_drift(spark, sf_dir):
    paths = daily_extracts(spark, sf_dir)
    rows = drift.drift_rows(drift.with_drift(stored_layouts(spark, list(paths))))
    return _drift_by_day(rows, paths)


def schema_drift_mixed_files(spark, sf_dir):
    layouts = stored_layouts(spark, mixed_extract(spark, sf_dir))
    rows = drift.drift_rows(drift.with_drift(layouts))
    return rows.withColumnRenamed("column", "column_name").drop("extract", "files")


def schema_drift_names_only(spark, sf_dir):
    paths = daily_extracts(spark, sf_dir, fmt="csv")
    layouts = stored_layouts(spark, list(paths), fmt="csv")
    rows = drift.drift_rows(drift.with_drift(layouts, check_types=False))
    return _drift_by_day(rows, paths)


def schema_drift_summary(spark, sf_dir):
    paths = daily_extracts(spark, sf_dir)
    compared = drift.with_drift(stored_layouts(spark, list(paths)))
    drift.enforce_schema(drift.drift_rows(compared), strict=False)
    summary = drift.drift_summary(compared)
    return summary.withColumn("day", _day_of(paths)).drop("extract", "document")


# --- sinks ---


def flat_overwrite(spark, sf_dir):
    path = scratch_path(spark, "flat")
    mart, _ = stage_table(gold(spark, sf_dir, sort=False), "gold")
    write_layer(mart, path, partition_by=())
    write_layer(mart.filter(F.col(L.PARTITION) == F.lit(DAY)), path, partition_by=())
    return read_layer(spark, path, L.GOLD_LAYOUT)


def backfill_one_day(spark, sf_dir):
    path = scratch_path(spark, "backfill")
    write_layer(gold(spark, sf_dir, sort=False), path)
    redone = gold(spark, sf_dir, DIRTY_FEED, sort=False)
    redone = redone.filter(F.col(L.PARTITION) == F.lit(DAY))
    write_layer(redone, path, since=DAY, until=DAY)
    return read_layer(spark, path, L.GOLD_LAYOUT)


def incremental_load(spark, sf_dir):
    """Two loads of different days, neither with a window: all days stay."""
    path = scratch_path(spark, "incremental")
    mart = gold(spark, sf_dir, sort=False)
    early = F.col(L.PARTITION) <= F.lit(DAY)
    write_layer(mart.filter(early), path)
    write_layer(mart.filter(~early), path)
    return read_layer(spark, path, L.GOLD_LAYOUT)


def stale_partitions(spark, sf_dir):
    """A rerun of three days that has rows for one of them only."""
    path = scratch_path(spark, "stale")
    kept, _ = bronze_halves(spark, sf_dir)
    write_layer(kept, path)
    one_day = kept.filter(F.col(L.PARTITION) == F.lit(DAY))
    write_layer(one_day, path, since=WINDOW[0], until=WINDOW[1])
    return spark.read.parquet(path)


#: Zones whose trips arrive late, and the days of which they arrive.
LATE_ZONES, LATE_DAYS = 3, (2, 4)


def late_loads(spark, sf_dir) -> tuple[RunConfig, RunConfig]:
    """Two loads into one warehouse: the second brings late trips of days already loaded,
    and some trips for a second time."""
    feed = instants(trips(spark, sf_dir))
    zone, day = F.col("PULocationID") % 10, F.dayofmonth(utc_clock(feed, TIMES[0]))
    parts = {
        "punctual": zone != LATE_ZONES,
        "late": zone.isin(LATE_ZONES, LATE_ZONES + 1) & day.isin(*LATE_DAYS),
    }
    warehouse = scratch_path(spark, "warehouse")
    loads = []
    for name, chosen in parts.items():
        path = scratch_path(spark, name)
        export(feed.filter(chosen), path)
        # a small load may miss a threshold that the whole feed meets
        loads.append(RunConfig(warehouse, path, run_id=name, write_mode="merge", enforce_gates=False))
    return loads[0], loads[1]


def late_rows_merge(spark, sf_dir):
    first, second = late_loads(spark, sf_dir)
    for load in (first, second):
        stages.run_all(load, spark)
    return read_layer(spark, second.layer_path("gold"), L.GOLD_LAYOUT)


def late_rows_bronze(spark, sf_dir):
    """The same loads in the other order, and one of them twice: bronze holds each trip once."""
    first, second = late_loads(spark, sf_dir)
    for load in (second, first, second):
        stages.run_bronze(load, spark)
    return utc_times(read_layer(spark, second.layer_path("bronze"), L.BRONZE_LAYOUT))


def late_rows_quarantine(spark, sf_dir):
    first, second = late_loads(spark, sf_dir)
    for load in (first, second):
        stages.run_bronze(load, spark)
    rejected = spark.read.parquet(second.quarantine_path("bronze"))
    return reasons(rejected).select("trip_id", "dq_failures", F.col(L.PARTITION).cast("date"))


def quarantine_after_clean_rerun(spark, sf_dir):
    """Two days are loaded again, without a window and without faults: their quarantine goes."""
    settings = config(spark, sf_dir, enforce_gates=False)
    stages.run_bronze(settings, spark)
    feed = instants(trips(spark, sf_dir))
    again = F.dayofmonth(utc_clock(feed, TIMES[0])).isin(*LATE_DAYS)
    sound = (F.col(TIMES[1]) > F.col(TIMES[0])) & (F.col("trip_distance") < 100)
    sound &= (F.col("PULocationID") < 999) & (F.col("payment_type") < 99) & (F.col("fare_amount") >= 0)
    path = scratch_path(spark, "mended")
    export(feed.filter(again & sound), path)
    stages.run_bronze(RunConfig(settings.warehouse, path, enforce_gates=False), spark)
    rejected = spark.read.parquet(settings.quarantine_path("bronze"))
    return reasons(rejected).select("trip_id", "dq_failures", F.col(L.PARTITION).cast("date"))


def undated_rows(spark, sf_dir):
    """Trips without a pickup time, which a window cannot select: counted in the same pass."""
    feed = instants(trips(spark, sf_dir))
    missing = F.col("PULocationID") % 50 == 7
    feed = feed.withColumn(TIMES[0], F.when(~missing, F.col(TIMES[0])))
    path = scratch_path(spark, "undated")
    export(feed, path)
    settings = RunConfig(scratch_path(spark, "warehouse"), path, since=WINDOW[0], until=WINDOW[1])
    result = stages.run_bronze(settings, spark)
    row = (result.rows_in, result.rows_out, result.rows_quarantined, result.rows_without_date)
    names = "rows_in bigint, rows_out bigint, rows_quarantined bigint, rows_without_date bigint"
    return spark.createDataFrame([row], names)


def publish_guard(spark, sf_dir):
    raw = exported(spark, sf_dir)
    outcomes = []
    for day in (DAY, ABSENT_DAY):
        config = RunConfig(
            scratch_path(spark, "guard"), raw, enforce_gates=False, since=day, until=day
        )
        try:
            result = stages.run_bronze(config, spark)
            outcomes.append((str(day), result.rows_in, result.rows_out, "published"))
        except NothingToPublish as nothing:
            outcomes.append((str(day), nothing.rows_in, 0, "refused"))
    return spark.createDataFrame(
        outcomes, "day string, rows_in bigint, rows_out bigint, outcome string"
    )


# --- projections and filters ---


def trip_id(spark, sf_dir):
    return add_trip_id(normalize(trips(spark, sf_dir))).select(*L.TRIP_KEY, "trip_id")


def pickup_date(spark, sf_dir):
    dated = add_pickup_date(normalize(trips(spark, sf_dir)))
    return dated.select("pickup_at", "dropoff_at", L.PARTITION)


def safe_divide(spark, sf_dir):
    fare, miles, tip = (F.col(c) for c in ("fare_amount", "trip_distance", "tip_amount"))
    return trips(spark, sf_dir).select(
        fare,
        miles,
        tip,
        ratio(fare, miles).alias("fare_per_mile"),
        ratio(fare, tip).alias("fare_per_tip"),
        ratio(tip, fare).alias("tip_share"),
    )


def exact_sums(spark, sf_dir):
    """Sums of tiny values, of tiny and huge ones together, and with a NaN."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    number = F.floor("l_quantity").cast("double")
    tiny, huge = number * F.lit(2.0**-30), number * F.lit(2.0**44)
    odd = F.col("l_linenumber") == 7
    return rows.groupBy("l_returnflag").agg(
        exact_sum(tiny).alias("tiny_sum"),
        exact_sum(F.when(odd, huge).otherwise(tiny)).alias("wide_sum"),
        F.isnan(exact_sum(F.when(odd, F.lit("NaN").cast("double")).otherwise(tiny))).alias("sum_is_nan"),
    )


def calendar(spark, sf_dir):
    names = ["pickup_at", L.PARTITION, "pickup_hour", "pickup_day_of_week", "time_of_day"]
    return enrich(normalize(trips(spark, sf_dir))).select(*names)


def airport_flag(spark, sf_dir):
    flagged = enrich(normalize(trips(spark, sf_dir)))
    kinds = flagged.groupBy("rate_code_id", "airport_fee", "is_airport_trip")
    return kinds.agg(F.count(F.lit(1)).alias("trips"))


def window_filter(spark, sf_dir):
    return clean_window(trips(spark, sf_dir))


def clean_window(raw: DataFrame) -> DataFrame:
    return add_pickup_date(add_trip_id(picked_up_between(normalize(raw), *WINDOW)))


# --- rules and reports ---


def _custom(*rules, datasets=()) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        ruleset = RuleSet("custom", tuple(rule() for rule in rules), tuple(d() for d in datasets))
        return report_columns(evaluate(shaped(spark, sf_dir), ruleset))

    return query


rule_not_null = _custom(
    lambda: not_null("passenger_count"),
    lambda: not_null("rate_code_id", severity=Severity.WARN, threshold=0.9),
)
rule_in_range = _custom(
    lambda: in_range("trip_distance", 1.0, 10.0),
    lambda: in_range("rate_code_id", 1, 3),
    lambda: in_range("rate_code_id", 1, 3, allow_null=True, name="rate_code_or_null"),
)
rule_non_negative = _custom(
    lambda: non_negative("fare_amount", threshold=0.99),
    lambda: non_negative("passenger_count"),
    lambda: non_negative("passenger_count", allow_null=True, name="passengers_or_null"),
)
rule_accepted_values = _custom(
    lambda: accepted_values("payment_type", (1, 2)),
    lambda: accepted_values("store_and_fwd_flag", ("Y", "N")),
    lambda: accepted_values("rate_code_id", (1,), allow_null=True, name="rate_code_or_null"),
)
rule_ordered = _custom(
    lambda: ordered("pickup_at", "dropoff_at", strict=True),
    lambda: ordered("tip_amount", "fare_amount"),
    lambda: ordered("rate_code_id", "payment_type", strict=True),
)
rule_satisfies = _custom(
    lambda: satisfies(
        "standard_rate",
        F.col("rate_code_id") == 1,
        "most trips run at rate 1",
        columns=("rate_code_id",),
        severity=Severity.WARN,
        threshold=0.75,
    ),
    lambda: satisfies(
        "total_covers_fare",
        F.col("total_amount") >= F.col("fare_amount"),
        "the total includes the fare",
        columns=("total_amount", "fare_amount"),
    ),
)
rule_unique = _custom(datasets=(lambda: unique("trip_id"),))
rule_row_count = _custom(
    datasets=(
        lambda: row_count_at_least(1),
        lambda: row_count_at_least(1_000_000_000, severity=Severity.WARN, name="a_billion_rows"),
    )
)


def bronze_report(spark, sf_dir, period=CLEAN_FEED, stage="bronze") -> DataFrame:
    return evaluate(shaped(spark, sf_dir, period), bronze_ruleset(), stage=stage)


def quality_bronze(spark, sf_dir):
    return report_columns(bronze_report(spark, sf_dir))


def quality_silver(spark, sf_dir):
    """A stand-alone check of a dataset at a path."""
    kept, _ = bronze_halves(spark, sf_dir)
    _, path = stage_table(enrich(deduplicate(kept)), "enriched")
    dataset = read_dataset(spark, path, L.SILVER_LAYOUT)
    return report_columns(evaluate(dataset, silver_ruleset()))


def check_mixed_files(spark, sf_dir):
    """A stand-alone check of a dataset whose files have seven layouts."""
    dataset = read_dataset(spark, mixed_extract(spark, sf_dir), L.RAW_LAYOUT)
    return report_columns(evaluate(clean(dataset), bronze_ruleset()))


def quality_gold(spark, sf_dir):
    return report_columns(evaluate(gold(spark, sf_dir, sort=False), gold_ruleset()))


def quality_by_day(spark, sf_dir):
    daily = evaluate(shaped(spark, sf_dir), bronze_ruleset(), by=[L.PARTITION])
    return report_columns(daily)


def empty_dataset_report(spark, sf_dir):
    none = shaped(spark, sf_dir).filter(F.col(L.PARTITION) == F.lit(ABSENT_DAY))
    return report_columns(evaluate(none, bronze_ruleset()))


def report_rows(spark, sf_dir):
    """A report as its sink stores it, read back."""
    path = scratch_path(spark, "report")
    report.to_documents(bronze_report(spark, sf_dir, DIRTY_FEED)).write.json(path)
    stored = spark.read.schema("stage string, document string").json(path)
    return report_columns(report.from_documents(stored))


def _flat_verdicts(verdicts: DataFrame) -> DataFrame:
    return verdicts.withColumns({c: F.concat_ws(",", c) for c in ("errors", "warnings")})


def report_json_roundtrip(spark, sf_dir):
    results = bronze_report(spark, sf_dir, DIRTY_FEED).unionByName(
        evaluate(gold(spark, sf_dir, sort=False), gold_ruleset())
    )
    return _flat_verdicts(gate.verdicts(report.from_documents(report.to_documents(results))))


def report_summary_lines(spark, sf_dir):
    """Reports of two layers; of the second, the columns that its rules name are written once."""
    measured = enriched(spark, sf_dir).select(*silver_ruleset().columns())
    measured, _ = stage_table(measured, "enriched")
    results = bronze_report(spark, sf_dir, DIRTY_FEED).unionByName(
        evaluate(measured, silver_ruleset())
    )
    return results.select("stage", "position", report.rule_line().alias("line"))


def gate_verdict(spark, sf_dir):
    results = bronze_report(spark, sf_dir).unionByName(
        bronze_report(spark, sf_dir, DIRTY_FEED, stage="dirty")
    )
    return _flat_verdicts(gate.verdicts(results))


def quarantine_rows(spark, sf_dir):
    return reasons(bronze_halves(spark, sf_dir)[1])


def quarantine_preview(spark, sf_dir):
    rows = reasons(bronze_halves(spark, sf_dir)[1]).select("trip_id", "dq_failures")
    return rows.orderBy("trip_id", "dq_failures").limit(20)


def split_no_rules(spark, sf_dir):
    kept, rejected = split(shaped(spark, sf_dir), ())
    halves = kept.select(F.lit("clean").alias("half")).agg(
        F.lit("clean").alias("half"), F.count(F.lit(1)).alias("rows")
    )
    return halves.unionByName(
        rejected.agg(F.lit("rejected").alias("half"), F.count(FAILURES).alias("rows"))
    )


def dedupe(spark, sf_dir):
    return deduplicate(bronze_halves(spark, sf_dir)[0])


# --- history and trends ---


def recorded_runs(spark, sf_dir) -> DataFrame:
    """One run per pickup day and stage, measured in one pass per feed."""

    def daily(period, stage):
        return evaluate(shaped(spark, sf_dir, period), bronze_ruleset(), stage=stage, by=[L.PARTITION])

    last = F.col(L.PARTITION) == F.lit(LAST_DAY)
    results = (
        daily(CLEAN_FEED, "bronze")
        .filter(~last)
        .unionByName(daily(DIRTY_FEED, "bronze").filter(last))
        .unionByName(daily(DIRTY_FEED, "dirty"))
    )
    moment = F.col(L.PARTITION).cast("timestamp_ntz")
    return results.withColumns(
        {"run_id": history.run_id_of(moment), "recorded_at": history.recorded_at_of(moment)}
    ).drop(L.PARTITION)


def store(spark, sf_dir) -> history.History:
    """A history that first held other results for one run, then replaced them."""
    past = history.History(spark, scratch_path(spark, "history"))
    runs, _ = stage_table(recorded_runs(spark, sf_dir), "runs")
    replaced = (F.col("stage") == "bronze") & (F.col("run_id") == history.new_run_id(_midnight(DAY)))
    past.record(runs.filter(replaced).withColumn("passed", F.lit(False)))
    past.record(runs)
    return past


def _midnight(day: date):
    from datetime import datetime, timezone

    return datetime(day.year, day.month, day.day, tzinfo=timezone.utc)


def history_record(spark, sf_dir):
    return report_columns(store(spark, sf_dir).results())


def history_entries(spark, sf_dir):
    return _flat_verdicts(store(spark, sf_dir).entries())


def history_latest(spark, sf_dir):
    past = store(spark, sf_dir)
    asked = {"newest": None, "before": "20260604T000000Z", "unknown": "20990101T000000Z"}
    found = None
    for label, before in asked.items():
        runs = past.latest(before=before).select(F.lit(label).alias("asked"), "stage", "run_id")
        found = runs.distinct() if found is None else found.unionByName(runs.distinct())
    return found


def history_prune(spark, sf_dir):
    past = store(spark, sf_dir)
    past.prune(3)
    return _flat_verdicts(past.entries())


def history_unreadable(spark, sf_dir):
    """One run whose file is no report: named, passed over, and gone with the retention."""
    past = store(spark, sf_dir)
    broken = f"{past.path}/stage=bronze/run_id=20260602T000000Z"
    spark.range(1).selectExpr("'no report' AS value").write.mode("overwrite").text(broken)
    found = [("unreadable", *run) for run in past.unreadable()]
    past.prune(3)
    found += [("left", *run) for run in past.unreadable()]
    named = spark.createDataFrame(found, "state string, stage string, run_id string")
    return named.unionByName(past.entries().select(F.lit("kept").alias("state"), "stage", "run_id"))


def history_stages(spark, sf_dir):
    return store(spark, sf_dir).stages()


def trend_document(spark, sf_dir):
    """What the JSON record of a trend says, read back from its text."""
    rule = "struct<name: string, kind: string, current_pass_rate: double, severity: string>"
    layout = f"regression_count bigint, stable boolean, row_delta bigint, rules array<{rule}>"
    summary = trend.trend_summary(trend.compare_runs(store(spark, sf_dir).results()))
    read = summary.select("stage", F.from_json("document", layout).alias("d"))
    read = read.select("stage", "d.regression_count", "d.stable", "d.row_delta", F.explode("d.rules").alias("r"))
    return read.select("*", "r.*").drop("r").withColumnRenamed("name", "rule")


def regression_gate(spark, sf_dir):
    past = trend.trend_summary(two_reports(spark, sf_dir))
    same = bronze_report(spark, sf_dir)
    steady = trend.compare_reports(*(same.withColumn("run_id", F.lit(r)) for r in ("one", "two")))
    outcomes = []
    for name, summary in (("changed", past), ("same", trend.trend_summary(steady))):
        try:
            trend.block_on_regression(summary)
            outcomes.append((name, "passed"))
        except trend.QualityRegressed as moved:
            outcomes.append((name, str(moved)))
    return spark.createDataFrame(outcomes, "compared string, outcome string")


def window_validation(spark, sf_dir):
    """The days of the feed as a window, forwards and backwards."""
    rows = shaped(spark, sf_dir)
    first, last = rows.agg(F.min(L.PARTITION), F.max(L.PARTITION)).first()
    outcomes = []
    for since, until in ((first, last), (last, first), (last, None)):
        try:
            outcomes.append((since, until, between_dates(rows, since, until).count(), "read"))
        except ValueError:
            outcomes.append((since, until, 0, "refused"))
    return spark.createDataFrame(outcomes, "since date, until date, trips bigint, outcome string")


def changed_rules() -> RuleSet:
    """The bronze rules with one taken away and one added."""
    rules = [r for r in bronze_ruleset().row_rules if r.name != "non_negative[tip_amount]"]
    rules.append(in_range("extra", 0.0, 1.0, threshold=0.5))
    return RuleSet("bronze", tuple(rules), (row_count_at_least(1),))


def two_reports(spark, sf_dir) -> DataFrame:
    previous = bronze_report(spark, sf_dir).withColumn("run_id", F.lit("clean"))
    current = evaluate(shaped(spark, sf_dir, DIRTY_FEED), changed_rules())
    return trend.compare_reports(previous, current.withColumn("run_id", F.lit("dirty")))


def rule_trend(spark, sf_dir):
    return two_reports(spark, sf_dir).withColumnRenamed("name", "rule")


def rule_trend_latest(spark, sf_dir):
    return trend.compare_runs(store(spark, sf_dir).results()).withColumnRenamed("name", "rule")


def trend_summary(spark, sf_dir):
    return trend.trend_summary(trend.compare_runs(store(spark, sf_dir).results())).drop("document")


def trend_summary_lines(spark, sf_dir):
    lines = two_reports(spark, sf_dir)
    return lines.select("stage", F.col("name").alias("rule"), trend.trend_line().alias("line"))


# --- stages and runs ---


def config(spark, sf_dir, period=CLEAN_FEED, **switches) -> RunConfig:
    raw = exported(spark, sf_dir, period)
    return RunConfig(scratch_path(spark, "warehouse"), raw, run_id="check", **switches)


def run_bronze(spark, sf_dir):
    result = stages.run_bronze(config(spark, sf_dir), spark)
    return utc_times(read_layer(spark, result.output_path, L.BRONZE_LAYOUT))


def run_silver(spark, sf_dir):
    settings = config(spark, sf_dir)
    stages.run_bronze(settings, spark)
    result = stages.run_silver(settings, spark)
    return utc_times(read_layer(spark, result.output_path, L.SILVER_LAYOUT))


def _run_to_gold(spark, sf_dir, period=CLEAN_FEED, **switches):
    settings = config(spark, sf_dir, period, **switches)
    stages.run_all(settings, spark)
    return read_layer(spark, settings.layer_path("gold"), L.GOLD_LAYOUT)


def run_gold(spark, sf_dir):
    return _run_to_gold(spark, sf_dir)


def run_no_gates(spark, sf_dir):
    return _run_to_gold(spark, sf_dir, DIRTY_FEED, enforce_gates=False)


def run_no_quarantine(spark, sf_dir):
    return _run_to_gold(spark, sf_dir, quarantine_enabled=False, enforce_gates=False)


def backfill_idempotent(spark, sf_dir):
    settings = config(spark, sf_dir)
    stages.run_all(settings, spark)
    again = RunConfig(settings.warehouse, settings.input_path, since=DAY, until=DAY)
    stages.run_all(again, spark)
    return read_layer(spark, settings.layer_path("gold"), L.GOLD_LAYOUT)


def stage_counts(spark, sf_dir):
    return stages.stage_counts(spark, stages.run_all(config(spark, sf_dir), spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_declared": scan_declared,
        "scan_mixed_files": scan_mixed_files,
        "scan_csv_declared": scan_csv_declared,
        "stored_schema": stored_schema,
        "schema_drift": schema_drift,
        "schema_drift_mixed_files": schema_drift_mixed_files,
        "schema_drift_names_only": schema_drift_names_only,
        "schema_drift_summary": schema_drift_summary,
        "flat_overwrite": flat_overwrite,
        "backfill_one_day": backfill_one_day,
        "stale_partitions": stale_partitions,
        "incremental_load": incremental_load,
        "late_rows_merge": late_rows_merge,
        "late_rows_bronze": late_rows_bronze,
        "late_rows_quarantine": late_rows_quarantine,
        "quarantine_after_clean_rerun": quarantine_after_clean_rerun,
        "undated_rows": undated_rows,
        "publish_guard": publish_guard,
        "normalize": lambda spark, sf_dir: normalize(trips(spark, sf_dir)),
        "trip_id": trip_id,
        "pickup_date": pickup_date,
        "clean": shaped,
        "safe_divide": safe_divide,
        "exact_sums": exact_sums,
        "enrich": lambda spark, sf_dir: enrich(bronze_halves(spark, sf_dir)[0]),
        "calendar": calendar,
        "airport_flag": airport_flag,
        "window_filter": window_filter,
        "rule_not_null": rule_not_null,
        "rule_in_range": rule_in_range,
        "rule_non_negative": rule_non_negative,
        "rule_accepted_values": rule_accepted_values,
        "rule_ordered": rule_ordered,
        "rule_satisfies": rule_satisfies,
        "rule_unique": rule_unique,
        "rule_row_count": rule_row_count,
        "quality_bronze": quality_bronze,
        "quality_silver": quality_silver,
        "check_mixed_files": check_mixed_files,
        "quality_gold": quality_gold,
        "quality_by_day": quality_by_day,
        "empty_dataset_report": empty_dataset_report,
        "report_rows": report_rows,
        "report_json_roundtrip": report_json_roundtrip,
        "report_summary_lines": report_summary_lines,
        "gate_verdict": gate_verdict,
        "quarantine_rows": quarantine_rows,
        "quarantine_preview": quarantine_preview,
        "clean_rows": lambda spark, sf_dir: bronze_halves(spark, sf_dir)[0],
        "split_no_rules": split_no_rules,
        "deduplicate": dedupe,
        "gold_daily_zone": gold,
        "history_record": history_record,
        "history_entries": history_entries,
        "history_latest": history_latest,
        "history_prune": history_prune,
        "history_unreadable": history_unreadable,
        "history_stages": history_stages,
        "trend_document": trend_document,
        "regression_gate": regression_gate,
        "window_validation": window_validation,
        "rule_trend": rule_trend,
        "rule_trend_latest": rule_trend_latest,
        "trend_summary": trend_summary,
        "trend_summary_lines": trend_summary_lines,
        "run_bronze": run_bronze,
        "run_silver": run_silver,
        "run_gold": run_gold,
        "run_no_gates": run_no_gates,
        "run_no_quarantine": run_no_quarantine,
        "backfill_idempotent": backfill_idempotent,
        "stage_counts": stage_counts,
    }
