from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from lockgate.functions.expressions import day_part, exact_sum, ratio, utc_clock, utc_instant
from lockgate.layouts import GOLD_LAYOUT, TRIP_KEY
from lockgate.operators import trips as t
from lockgate.operators.mart import daily_zone_metrics

TRIP = (
    "pickup_at {0}, dropoff_at {0}, trip_distance double, fare_amount double,"
    " tip_amount double, rate_code_id bigint, airport_fee double"
)
KEY = (
    "vendor_id int, pickup_at timestamp_ntz, dropoff_at timestamp_ntz, pu_location_id int,"
    " do_location_id int, trip_distance double, fare_amount double, total_amount double"
)
NOON = datetime(2026, 6, 1, 12, 0)
HALF_PAST = datetime(2026, 6, 1, 12, 30)


def enriched(spark, row, kind="timestamp_ntz"):
    return t.enrich(spark.createDataFrame([row], TRIP.format(kind))).first()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_enrichment_whatever_the_session(spark, conf, kind, ansi, zone):
    conf("spark.sql.ansi.enabled", ansi)
    conf("spark.sql.session.timeZone", zone)
    times = [NOON, HALF_PAST]
    if kind == "timestamp":
        times = [moment.replace(tzinfo=timezone.utc) for moment in times]
    row = enriched(spark, (*times, 5.0, 20.0, 4.0, 1, 0.0), kind)
    assert (row.trip_duration_min, row.avg_speed_mph) == (30.0, 10.0)
    assert (row.fare_per_mile, row.tip_pct) == (4.0, 20.0)
    assert (row.pickup_date, row.pickup_hour) == (date(2026, 6, 1), 12)
    assert (row.pickup_day_of_week, row.time_of_day) == (2, "afternoon")
    assert row.is_airport_trip is False


def test_no_division_by_zero_or_by_a_negative(spark):
    row = enriched(spark, (NOON, NOON, 0.0, 0.0, 1.0, 1, None))
    assert (row.avg_speed_mph, row.fare_per_mile, row.tip_pct) == (None, None, None)
    assert enriched(spark, (HALF_PAST, NOON, 5.0, -1.0, 1.0, 1, None)).avg_speed_mph is None
    values = spark.createDataFrame([(1.0, 0.0), (1.0, -1.0), (1.0, 4.0)], "n double, d double")
    assert [r[0] for r in values.select(ratio(F.col("n"), F.col("d"))).collect()] == [None, None, 0.25]


@pytest.mark.parametrize(
    "code, fee, airport", [(2, 0.0, True), (3, None, True), (1, 1.75, True), (None, None, False)]
)
def test_the_airport_flag_is_never_null(spark, code, fee, airport):
    assert enriched(spark, (NOON, HALF_PAST, 5.0, 20.0, 4.0, code, fee)).is_airport_trip is airport


def test_day_parts_cover_all_hours(spark):
    hours = spark.createDataFrame([(h,) for h in [*range(24), None]], "h int")
    got = [row[0] for row in hours.select(day_part(F.col("h"))).collect()]
    assert got == (
        ["overnight"] * 6 + ["morning"] * 6 + ["afternoon"] * 5 + ["evening"] * 5 + ["night"] * 2 + [None]
    )


def test_fractions_of_seconds_are_dropped_before_subtracting(spark):
    start, end = NOON.replace(microsecond=900_000), datetime(2026, 6, 1, 12, 1, 0, 100_000)
    assert enriched(spark, (start, end, 1.0, 1.0, 0.0, 1, 0.0)).trip_duration_min == 1.0


def test_normalize_passes_over_absent_columns(spark):
    df = spark.createDataFrame([(1, " y ", 2.0)], "VendorID int, store_and_fwd_flag string, extra double")
    row = t.normalize(t.normalize(df)).first()
    assert row.asDict() == {"vendor_id": 1, "store_and_fwd_flag": "Y", "extra": 2.0}
    assert t.normalize(spark.createDataFrame([(1,)], "x int")).columns == ["x"]


def trip(**changes):
    base = dict(zip(TRIP_KEY, (1, NOON, HALF_PAST, 10, 20, 2.5, 10.0, 12.0)))
    return tuple({**base, **changes}.values())


def test_the_key_tells_nulls_in_neighbouring_fields_apart(spark):
    rows = [trip(pu_location_id=None, do_location_id=10), trip(pu_location_id=10, do_location_id=None)]
    ids = t.add_trip_id(spark.createDataFrame(rows, KEY)).select("trip_id").distinct().count()
    assert ids == 2


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_the_key_does_not_move_with_the_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    aware = trip(pickup_at=NOON.replace(tzinfo=timezone.utc), dropoff_at=HALF_PAST.replace(tzinfo=timezone.utc))
    instants = spark.createDataFrame([aware], KEY.replace("timestamp_ntz", "timestamp"))
    local = spark.createDataFrame([trip()], KEY)
    assert t.add_trip_id(instants).first().trip_id == t.add_trip_id(local).first().trip_id


def test_the_same_copy_survives_under_any_partitioning(spark):
    rows = [(*trip(), tip) for tip in (3.0, None, 1.0, 2.0)] * 5
    df = t.add_trip_id(spark.createDataFrame(rows, KEY + ", tip_amount double"))
    survivors = {
        tuple(t.deduplicate(part).collect())
        for part in (df.repartition(1), df.repartition(7), df.orderBy(F.desc("tip_amount")))
    }
    assert len(survivors) == 1
    assert len(next(iter(survivors))) == 1


def test_copies_are_dropped_before_the_shuffle(spark):
    df = t.add_trip_id(spark.createDataFrame([trip()], KEY))
    plan = t.deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_a_trip_across_midnight_belongs_to_its_pickup_day(spark):
    late = spark.createDataFrame(
        [(datetime(2026, 6, 1, 23, 50), datetime(2026, 6, 2, 0, 10))],
        "pickup_at timestamp_ntz, dropoff_at timestamp_ntz",
    )
    assert t.add_pickup_date(late).first().pickup_date == date(2026, 6, 1)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_windows_are_inclusive_and_may_be_open(spark, conf, kind):
    conf("spark.sql.session.timeZone", "America/New_York")
    moments = [datetime(2026, 6, d, h) for d in (1, 2, 3) for h in (0, 23)]
    df = spark.createDataFrame([(m,) for m in moments] + [(None,)], "pickup_at timestamp_ntz")
    if kind == "timestamp":
        df = df.select(utc_instant(F.col("pickup_at")).alias("pickup_at"))
    day = date(2026, 6, 2)

    def days(since, until):
        raw = t.picked_up_between(df, since, until)
        dated = t.between_dates(t.add_pickup_date(df), since, until)
        assert raw.count() == dated.count()
        return sorted(r[0].day for r in t.add_pickup_date(raw).select("pickup_date").distinct().collect())

    assert days(day, day) == [2]
    assert days(day, None) == [2, 3]
    assert days(None, day) == [1, 2]
    with pytest.raises(ValueError, match="since must not be after until"):
        t.between_dates(df, date(2026, 6, 3), day)


def test_clocks_and_instants_are_inverse(spark, conf):
    conf("spark.sql.session.timeZone", "Europe/Berlin")
    # 01:30 UTC is read twice on Berlin clocks on this day.
    df = spark.sql("SELECT TIMESTAMP_NTZ'2026-10-25 01:30:00' AS n UNION ALL SELECT TIMESTAMP_NTZ'2026-10-25 00:30:00'")
    back = df.select("n", utc_instant(F.col("n")).alias("i"))
    assert back.filter(utc_clock(back, "i") == F.col("n")).count() == 2


SILVER = (
    "pickup_date date, pu_location_id int, total_amount double, trip_distance double,"
    " trip_duration_min double, tip_pct double, is_airport_trip boolean"
)


def test_the_mart(spark):
    day = date(2026, 6, 1)
    rows = [
        (day, 7, 10.0, 2.0, 10.0, 10.0, False),
        (day, 7, 50.0, 10.0, 30.0, 20.0, True),
        (day, 9, 5.0, 1.0, 5.0, None, False),
        (date(2026, 6, 2), 7, 1.0, 1.0, 1.0, 1.0, False),
    ]
    mart = daily_zone_metrics(spark.createDataFrame(rows, SILVER))
    assert mart.columns == GOLD_LAYOUT.fieldNames()
    got = [tuple(row) for row in mart.collect()]
    assert got[0] == (day, 7, 2, 60.0, 6.0, 20.0, 10.0, 15.0, 0.5)
    assert got[1][7] is None
    assert [row[:2] for row in got] == sorted(row[:2] for row in got)


def test_sums_do_not_depend_on_row_order(spark):
    day = date(2026, 6, 1)
    rows = [(day, 1, 0.1 * i, 0.1, 1.0, 0.1, False) for i in range(1, 400)]
    df = spark.createDataFrame(rows, SILVER)
    marts = {tuple(daily_zone_metrics(df.repartition(n)).collect()) for n in (1, 3, 8)}
    assert len(marts) == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_no_decimal_can_hold_are_not_skipped(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    rows = [(date(2026, 6, 1), 1, amount, 1.0, 1.0, 1.0, False) for amount in (1e15, 2.0)]
    assert daily_zone_metrics(spark.createDataFrame(rows, SILVER)).first().total_revenue == 1e15 + 2


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_are_exact_in_any_order(spark, conf, ansi):
    import math
    import random

    conf("spark.sql.ansi.enabled", ansi)
    rng = random.Random(7)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 17) for _ in range(500)] + [4e-7] * 1000
    rng.shuffle(values)
    rows = [("mixed", v) for v in values] + [("tiny", 4e-27)] * 9 + [("none", None), ("some", None), ("some", -2.5)]
    rows += [("nan", 1.0), ("nan", math.nan), ("inf", math.inf), ("inf", -1e300), ("far", 1e200), ("far", 1.0)]
    frame = spark.createDataFrame(rows, "k string, v double")
    sums = [
        {r.k: r.s for r in dealt.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).collect()}
        for dealt in (frame.coalesce(1), frame.repartition(4), frame.repartition(8).sortWithinPartitions("v"))
    ]
    got = sums[0]
    assert all(repr(sorted(s.items())) == repr(sorted(got.items())) for s in sums)
    assert got["mixed"] == pytest.approx(math.fsum(values), rel=1e-15)
    assert got["tiny"] == pytest.approx(3.6e-26) and got["none"] is None and got["some"] == -2.5
    assert math.isnan(got["nan"]) and got["inf"] == math.inf and got["far"] == 1e200


def test_large_input_tasks_are_not_sorted_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(t, "SORTED_ROWS", 2)
    rows = [(*trip(vendor_id=n % 7), float(n % 3)) for n in range(40)]
    df = t.add_trip_id(spark.createDataFrame(rows, KEY + ", tip_amount double"))

    def sorts_early(found):
        plan = found._jdf.queryExecution().executedPlan().toString()
        return plan.rindex("Sort") > plan.index("Exchange")

    once = t.deduplicate(df)
    assert not sorts_early(once) and {r.tip_amount for r in once.collect()} == {0.0}
    monkeypatch.setattr(t, "HOT_ROWS", 3)
    assert sorts_early(t.deduplicate(df))
    assert sorted(map(str, t.deduplicate(df).collect())) == sorted(map(str, once.collect()))


@pytest.mark.parametrize("sorted_rows", [0, 100])
def test_keys_of_any_text_are_told_apart(spark, monkeypatch, sorted_rows):
    monkeypatch.setattr(t, "SORTED_ROWS", sorted_rows)
    keys = ["0aff", "0AFF", "aff", "00", "0", "", "g1", "a b", None]
    df = spark.createDataFrame([(k, n) for n in range(3) for k in keys], "k string, n int").repartition(4)
    found = t.deduplicate(df, "k")
    assert found.columns == ["k", "n"] and sorted(map(str, found.collect())) == sorted(
        map(str, spark.createDataFrame([(k, 0) for k in keys], "k string, n int").collect())
    )
    assert t.deduplicate(df.select("n", "k"), "n").count() == 3
    assert t.deduplicate(df.limit(0), "k").count() == 0
    many = spark.range(60_000).select((F.col("id") % 50_000).alias("k"), F.col("id").alias("n"))
    assert t.deduplicate(many, "k").count() == 50_000


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_ids_worked_out_from_the_row_do_not_cross_a_shuffle(spark, monkeypatch, kind):
    monkeypatch.setattr(t, "SORTED_ROWS", 0)
    fields = KEY.replace("timestamp_ntz", kind) + ", tip_amount double"
    moment = NOON.replace(tzinfo=timezone.utc) if kind == "timestamp" else NOON
    rows = [(1, moment, None, 3, 4, 1.5, -0.0, float(n), 1.0) for n in range(6)]
    rows += [(*row[:-1], 0.5) for row in rows]
    dated = t.add_trip_id(spark.createDataFrame(rows, fields))
    own = ["by-hand", "", "ab", "AB", None, "0" * 64]
    n = F.col("total_amount").cast("int") + 1
    other = dated.withColumn("trip_id", F.get(F.array(*map(F.lit, own)), n - 1))
    both = dated.unionByName(other.withColumn("tip_amount", F.lit(2.0)))
    carried, value = t.narrowed(both, "trip_id")
    crossing = F.col("trip_id").isNotNull() | F.col("_trip_id_bytes").isNotNull()
    assert carried.filter(crossing).count() == 2 * (len(own) - 1)
    restored = carried.select(value.alias("trip_id"), *dated.drop("trip_id").columns)
    assert not restored.exceptAll(both.select(*restored.columns)).count()
    assert not both.select(*restored.columns).exceptAll(restored).count()
    kept = t.deduplicate(both)
    assert kept.count() == 12
    assert {row.tip_amount for row in kept.join(dated, "trip_id", "left_semi").collect()} == {0.5}
    assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1


def test_digests_are_worked_out_behind_the_shuffle(spark, capsys):
    schema = KEY.replace("timestamp_ntz", "timestamp") + ", tip_amount double"
    at = datetime(2026, 6, 3, 1, 2, 3, 450)
    nan = float("nan")
    keys = [(1, at, at, 7, 8, 0.0), (1, at, at, 7, 8, -0.0), (None, at, None, 7, 8, nan), (1, at, at, None, 8, None), (1, at, at, 8, None, 1e300)]
    rows = [(*key, 1.5, 2.5, float(tip)) for key in keys for tip in (3, 2)]
    df = spark.createDataFrame(rows, schema).transform(t.add_trip_id).transform(t.add_pickup_date)
    dealt = t.gathered(df, "trip_id", ["pickup_date"], digests=True)
    found = t.first_copies(dealt, "trip_id", ["pickup_date", t.DEALT])
    found.explain()
    above, shuffle, below = capsys.readouterr().out.partition("Exchange ")
    assert shuffle and "sha2" in above and "sha2" not in below and "Exchange " not in below
    expected = sorted(map(str, t.first_copies(df, "trip_id").collect()))
    assert sorted(map(str, found.drop(t.DEALT).collect())) == expected and len(expected) == len(keys)
