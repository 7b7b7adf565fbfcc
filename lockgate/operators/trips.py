"""Shaping and enriching trip records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate import layouts as L
from lockgate.functions.expressions import (
    all_true,
    day_part,
    is_instant,
    ratio,
    utc_clock,
    whole_seconds,
    with_hex_packed,
)

#: Rows that are sorted before their shuffle; of more, only keys of so many rows get copies dropped early.
SORTED_ROWS, HOT_ROWS = 250_000, 1_000_000


def normalize(df: DataFrame) -> DataFrame:
    """Snake-case names and a tidy flag; absent columns are passed over."""
    renamed = df.withColumnsRenamed(L.RENAMES)
    flag = "store_and_fwd_flag"
    if flag not in renamed.columns:
        return renamed
    return renamed.withColumn(flag, F.upper(F.trim(flag)))


def trip_id(df: DataFrame, columns: Sequence[str] = L.TRIP_KEY) -> Column:
    """Digest of the identifying fields.

    Null gets a text of its own, because ``concat_ws`` skips nulls and would
    let neighbouring fields trade places.
    """
    time_types = (T.TimestampType, T.TimestampNTZType)
    texts = []
    for name in columns:
        is_time = isinstance(df.schema[name].dataType, time_types)
        value = utc_clock(df, name) if is_time else F.col(name)
        texts.append(F.coalesce(value.cast("string"), F.lit(L.KEY_NULL)))
    return F.sha2(F.concat_ws(L.KEY_SEPARATOR, *texts), 256)


def add_trip_id(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_id", trip_id(df))


def pickup_date(df: DataFrame) -> Column:
    return F.to_date(utc_clock(df, "pickup_at"))


def add_pickup_date(df: DataFrame) -> DataFrame:
    return df.withColumn(L.PARTITION, pickup_date(df))


def clean(df: DataFrame) -> DataFrame:
    """Raw trips to the bronze layout."""
    return df.transform(normalize).transform(add_trip_id).transform(add_pickup_date)


#: Helper column of trips that are dealt out by their fields: see :func:`gathered`.
DEALT = "_dealt"


def trip_hash() -> Column:
    """Equal for rows whose fields have one digest, and read off the fields without their texts."""
    return F.xxhash64(*L.TRIP_KEY)


def sorts_first(df: DataFrame, key: str, *, digests: bool = False) -> bool:
    """Whether to drop copies before the shuffle: one scan of the key, which shuffles nothing.

    Few rows may be sorted for it, whose keys then cross as they are; others are only where a
    key has more than :data:`HOT_ROWS` rows. The sketch of frequent items finds such a key if it
    also has more than about one row in 4,000; with fewer, its task is one of many. ``digests``
    says that keys are trip ids which are the digests of their rows' fields; a hash of these
    stands for them.
    """
    keys = df.select((trip_hash() if digests else F.xxhash64(key)).alias("_key"))
    top = F.expr("approx_top_k(_key, 1, 10000)")
    seen = keys.agg(F.count("_key").alias("rows"), top.alias("top")).first()
    if seen.rows <= SORTED_ROWS:
        return True
    return bool(seen.top) and seen.top[0]["count"] > HOT_ROWS


def follows(df: DataFrame) -> bool:
    """Whether every trip id is the digest of its row's fields: one scan."""
    return not df.agg(F.count_if(~F.col("trip_id").eqNullSafe(trip_id(df)))).first()[0]


def narrowed(df: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """A frame that carries ``key`` through a shuffle in little space, and the column that restores it.

    A trip id that is the digest of its row's fields stays behind and is worked out again;
    any other id, and any other key, crosses as bytes if it is hex, or else as it is.
    """
    if not isinstance(df.schema[key].dataType, T.StringType):
        return df, F.col(key)
    if key != "trip_id" or not set(L.TRIP_KEY) <= set(df.columns):
        return with_hex_packed(df, key)
    given = df.withColumn("_given", ~F.col(key).eqNullSafe(trip_id(df)))
    carried, value = with_hex_packed(given.withColumn(key, F.when(F.col("_given"), F.col(key))), key)
    return carried, F.when(F.col("_given"), value).otherwise(trip_id(df))


def gathered(df: DataFrame, key: str, within: Sequence[str] = (), *, digests: bool = False) -> DataFrame:
    """Rows of one key in one task; keys cross the shuffle as :func:`narrowed` has them.

    With ``within``, columns that the rows of a key share, tasks hold ranges of these.
    ``digests`` says that all keys are trip ids which are the digests of their rows' fields:
    rows are then dealt out by a hash of the fields, which :data:`DEALT` keeps for windows over
    them, and digests are worked out once, behind the shuffle.
    """
    if digests:
        bare = df.drop(key)
        dealt = bare.repartitionByRange(*within, trip_hash()) if within else bare.repartition(trip_hash())
        columns = [trip_id(bare).alias(c) if c == key else F.col(c) for c in df.columns]
        return dealt.select(*columns, trip_hash().alias(DEALT))
    carried, value = narrowed(df, key)
    dealt = carried.repartitionByRange(*within, value) if within else carried.repartition(value)
    return dealt.select(*[value.alias(c) if c == key else c for c in df.columns])


def first_copies(df: DataFrame, key: str, within: Sequence[str] = ()) -> DataFrame:
    """Of the rows of one key, the first in the order of all columns."""
    order = [c for c in df.columns if c != key]
    ranked = df.withColumn("_copy", F.row_number().over(W.partitionBy(*within, key).orderBy(*order)))
    return ranked.filter(F.col("_copy") == 1).drop("_copy")


def deduplicate(df: DataFrame, key: str = "trip_id") -> DataFrame:
    """One row per ``key``: the first in the order of all columns.

    The key leaves out fields that later matter (tip, rate code), so copies can
    differ and an arbitrary survivor would make results vary between runs.
    Asking for row 1 lets Spark keep one row per key *before* the shuffle, so that a trip
    with very many copies still sends one row per input partition. That sorts an input task's
    rows, which spills them all once they exceed its memory, and sends ids in full: many rows
    cross unsorted, unless there is such a trip. Reads the key once to decide.
    """
    return first_copies(df if sorts_first(df, key) else gathered(df, key), key)


def enrich(df: DataFrame) -> DataFrame:
    """Adds durations, rates and calendar fields, rounded where they are derived."""
    clock = utc_clock(df, "pickup_at")
    elapsed = whole_seconds(df, "dropoff_at") - whole_seconds(df, "pickup_at")
    with_duration = df.withColumn("trip_duration_min", F.round(elapsed / F.lit(60.0), 3))

    miles, fare = F.col("trip_distance"), F.col("fare_amount")
    hours = F.col("trip_duration_min") / F.lit(60.0)
    tip_times_100 = F.col("tip_amount") * F.lit(100.0)
    airport_code = F.col("rate_code_id").isin(*L.AIRPORT_RATE_CODES)
    airport_fee = F.col("airport_fee") > 0
    return with_duration.withColumns(
        {
            "avg_speed_mph": F.round(ratio(miles, hours), 2),
            "fare_per_mile": F.round(ratio(fare, miles), 2),
            "tip_pct": F.round(ratio(tip_times_100, fare), 2),
            L.PARTITION: F.to_date(clock),
            "pickup_hour": F.hour(clock),
            "pickup_day_of_week": F.dayofweek(clock),
            "time_of_day": day_part(F.hour(clock)),
            "is_airport_trip": F.coalesce(airport_code, F.lit(False))
            | F.coalesce(airport_fee, F.lit(False)),
        }
    )


def check_window(since: date | None, until: date | None) -> None:
    if since and until and since > until:
        raise ValueError(f"since must not be after until: {since} > {until}")


def between_dates(df: DataFrame, since: date | None, until: date | None) -> DataFrame:
    """Rows whose partition date lies in the window; prunes partitions on a layer."""
    check_window(since, until)
    if since:
        df = df.filter(F.col(L.PARTITION) >= F.lit(since))
    if until:
        df = df.filter(F.col(L.PARTITION) <= F.lit(until))
    return df


def picked_up_within(df: DataFrame, since: date | None, until: date | None) -> Column:
    """The window as a condition on ``pickup_at``; null without a pickup time."""
    check_window(since, until)
    # Cast from text: a Python datetime would become an instant either way.
    kind, zone = ("timestamp", "Z") if is_instant(df, "pickup_at") else ("timestamp_ntz", "")

    def midnight(day: date) -> Column:
        return F.lit(f"{day.isoformat()} 00:00:00{zone}").cast(kind)

    bounds = []
    if since:
        bounds.append(F.col("pickup_at") >= midnight(since))
    if until:
        bounds.append(F.col("pickup_at") < midnight(until + timedelta(days=1)))
    return all_true(bounds)


def picked_up_between(df: DataFrame, since: date | None, until: date | None) -> DataFrame:
    """The same window put as a range of ``pickup_at``.

    On raw trips there is no date column to prune by; a plain range on the
    stored timestamp is what the Parquet reader can use.
    """
    return df.filter(picked_up_within(df, since, until))


def on_days(df: DataFrame, days: Sequence[date | None] | None) -> DataFrame:
    """Rows of the given partition dates; all rows without a list."""
    if days is None:
        return df
    found = F.col(L.PARTITION).isin([day for day in days if day is not None])
    return df.filter(found | F.col(L.PARTITION).isNull() if None in days else found)
