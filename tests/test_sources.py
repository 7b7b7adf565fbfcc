from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate.layouts import RAW_LAYOUT
from lockgate.operators.drift import (
    SchemaDriftError,
    drift_rows,
    drift_summary,
    enforce_schema,
    layout_of,
    with_drift,
)
from lockgate.operators.trips import normalize, picked_up_between
from lockgate.sources.raw import conform, export, read_raw, stored_layouts, stored_schema
from lockgate.sources.storage import scratch_path, stage_table

SMALL = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("flag", T.StringType()),
    ]
)
MOMENT = datetime(2026, 6, 1, 12, 0, tzinfo=timezone.utc)


def small(spark, *rows):
    return spark.createDataFrame(rows or [(1, MOMENT, 2.5, " y ")], SMALL)


def kinds(rows):
    return [(row.kind, row.column) for row in rows.orderBy("extract", "position").collect()]


@pytest.mark.parametrize(
    "stored, declared, value",
    [
        ("tinyint", "int", 7),
        ("int", "bigint", 7),
        ("int", "double", 7),
        ("int", "float", 7),
        ("tinyint", "float", 7),
        ("bigint", "double", 7),
        ("float", "double", 7),
    ],
)
def test_lossless_widenings_read(spark, tmp_path, stored, declared, value):
    path = str(tmp_path / "t")
    spark.createDataFrame([(value,)], "v int").select(F.col("v").cast(stored)).write.parquet(path)
    layout = spark.createDataFrame([], f"v {declared}").schema
    assert read_raw(spark, path, declared=layout).first().v == value


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("expression", ["date'2026-06-01'", "timestamp_ntz'2026-06-01 00:00:00'"])
def test_times_without_a_zone_are_utc(spark, conf, zone, expression):
    conf("spark.sql.session.timeZone", zone)
    stored = spark.sql(f"SELECT {expression} AS at")
    read = conform(stored, T.StructType([SMALL["at"]]))
    assert read.select(F.unix_seconds("at")).first()[0] == 1780272000


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_convert_become_null(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    stored = spark.createDataFrame([("x", "3.5")], "id string, amount string")
    row = conform(stored, SMALL).first()
    assert (row.id, row.amount, row.flag) == (None, 3.5, None)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_csv_binds_by_name_and_round_trips(spark, conf, tmp_path, zone):
    conf("spark.sql.session.timeZone", zone)
    path = str(tmp_path / "c")
    export(small(spark).select("flag", "amount", "at", "id"), path, fmt="csv")
    read = read_raw(spark, path, fmt="csv", declared=SMALL)
    assert read.columns == SMALL.fieldNames()
    row = read.select("id", F.unix_seconds("at").alias("at"), "amount", "flag").first()
    assert tuple(row) == (1, int(MOMENT.timestamp()), 2.5, " y ")


def test_csv_times_without_a_zone_are_utc(spark, conf, tmp_path):
    conf("spark.sql.session.timeZone", "Asia/Tokyo")
    (tmp_path / "x.csv").write_text("at,id\n2026-06-01 12:00:00,1\n2026-06-01T12:00:00Z,2\nnoon,3\n")
    read = read_raw(spark, str(tmp_path / "x.csv"), fmt="csv", declared=SMALL)
    got = {r.id: r.s for r in read.select("id", F.unix_seconds("at").alias("s")).collect()}
    assert got == {1: int(MOMENT.timestamp()), 2: int(MOMENT.timestamp()), 3: None}


def test_csv_files_with_other_column_orders_are_not_mixed_up(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount\n1,2.5\n")
    (tmp_path / "b.csv").write_text("amount,id\n3.5,2\n")
    (tmp_path / "c.csv").write_text("")
    each = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    for paths in (str(tmp_path), each):
        read = read_raw(spark, paths, fmt="csv", declared=SMALL)
        assert {(r.id, r.amount) for r in read.collect()} == {(1, 2.5), (2, 3.5)}


def test_files_of_one_extract_may_differ(spark, tmp_path):
    path = str(tmp_path / "one extract")
    parts = [
        small(spark),
        small(spark, (2, MOMENT, 4.0, "n")).drop("amount"),
        small(spark, (3, MOMENT, 4.0, "n")).withColumn("amount", F.lit("5.5")),
    ]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    parts[0].write.parquet(f"{path}/_temporary/0")
    read = read_raw(spark, path, declared=SMALL)
    assert {(r.id, r.amount) for r in read.collect()} == {(1, 2.5), (2, None), (3, 5.5)}
    compared = with_drift(stored_layouts(spark, path), SMALL)
    rows = drift_rows(compared).orderBy("kind").collect()
    assert [(r.kind, r.column, r.files) for r in rows] == [("mismatched", "amount", 1), ("missing", "amount", 1)]
    (summary,) = drift_summary(compared).collect()
    assert (summary.blocking_count, summary.stored_columns) == (2, 4)


def test_an_extract_without_files_lacks_every_column(spark, tmp_path):
    (tmp_path / "none").mkdir()
    rows = drift_rows(with_drift(stored_layouts(spark, str(tmp_path / "none")), SMALL))
    assert {r.kind for r in rows.collect()} == {"missing"}


@pytest.mark.parametrize("kind, end", [("timestamp_ntz", ""), ("timestamp", "Z")])
def test_a_window_reaches_the_scan_for_both_time_types(spark, conf, tmp_path, kind, end):
    conf("spark.sql.maxMetadataStringLength", "1000")
    path = str(tmp_path / "t")
    days = spark.range(1, 8).selectExpr(
        f"CAST(concat('2026-06-0', id, ' 12:00:00{end}') AS {kind}) AS tpep_pickup_datetime", "id AS extra"
    )
    days.write.parquet(path)
    since, until = datetime(2026, 6, 3).date(), datetime(2026, 6, 4).date()
    raw = normalize(read_raw(spark, path, days=("tpep_pickup_datetime", since, until)))
    found = picked_up_between(raw, since, until)
    assert sorted(r.extra for r in found.select("extra").collect()) == [3.0, 4.0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan and "LessThan(tpep_pickup_datetime" in plan


def test_extracts_with_different_types_are_read_together(spark, tmp_path):
    paths = [str(tmp_path / name) for name in "abc"]
    small(spark).write.parquet(paths[0])
    small(spark, (2, MOMENT, 4.0, "n")).withColumn("amount", F.col("amount").cast("int")).write.parquet(paths[1])
    small(spark, (3, MOMENT, 4.0, "n")).drop("amount").write.parquet(paths[2])
    read = read_raw(spark, paths, declared=SMALL)
    assert {(r.id, r.amount) for r in read.collect()} == {(1, 2.5), (2, 4.0), (3, None)}


def test_only_wanted_columns_are_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    small(spark).write.parquet(path)
    plan = read_raw(spark, path, declared=SMALL).select("id")._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<id:int>" in plan.toString()


@pytest.mark.parametrize("written_as", ["INT96", "TIMESTAMP_MICROS"])
def test_layouts_read_by_executors_agree_with_spark(spark, conf, tmp_path, written_as):
    conf("spark.sql.parquet.outputTimestampType", written_as)
    path = str(tmp_path / "t")
    df = small(spark).withColumn("local", F.col("at").cast("timestamp_ntz"))
    df.write.partitionBy("flag").parquet(path)
    (layout,) = stored_layouts(spark, [path]).collect()
    stored = {f.name: f.dataType.simpleString() for f in stored_schema(spark, path)}
    del stored["flag"]
    assert {c["name"]: c["type"] for c in layout["columns"]} == stored


def test_layouts_of_files_from_other_writers(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import parquet

    table = pa.table(
        {
            "utc": pa.array([MOMENT], pa.timestamp("us", "UTC")),
            "local": pa.array([datetime(2026, 6, 1)], pa.timestamp("us")),
            "n": pa.array([1], pa.int16()),
            "price": pa.array([1.0], pa.float32()),
        }
    )
    path = str(tmp_path / "other.parquet")
    parquet.write_table(table, path)
    (layout,) = stored_layouts(spark, [path]).collect()
    stored = [(f.name, f.dataType.simpleString()) for f in stored_schema(spark, path)]
    assert [tuple(c) for c in layout["columns"]] == stored


def test_an_unknown_format_is_refused(spark):
    for call in (lambda: read_raw(spark, "p", fmt="orc"), lambda: export(small(spark), "p", fmt="orc")):
        with pytest.raises(ValueError, match="format"):
            call()


# -- drift


def compared(spark, ddl, declared=SMALL, **options):
    return with_drift(layout_of(spark, spark.createDataFrame([], ddl).schema, "x"), declared, **options)


@pytest.mark.parametrize(
    "ddl, expected",
    [
        ("flag string, amount double, at timestamp, id int", []),
        ("id int, at timestamp, amount double", [("missing", "flag")]),
        ("id int, at timestamp, amount double, flag string, more int", [("unexpected", "more")]),
        ("id smallint, at date, amount bigint, flag string", [("widened", "id"), ("widened", "at"), ("widened", "amount")]),
        ("id bigint, at timestamp_ntz, amount double, flag string", [("mismatched", "id"), ("mismatched", "at")]),
        ("ID smallint, at timestamp, amount double, flag string", [("recased", "id"), ("widened", "id")]),
    ],
)
def test_kinds_of_drift(spark, ddl, expected):
    assert kinds(drift_rows(compared(spark, ddl))) == expected


def test_case_can_matter(spark):
    ddl = "ID int, at timestamp, amount double, flag string"
    rows = drift_rows(compared(spark, ddl, case_sensitive=True))
    assert kinds(rows) == [("missing", "id"), ("unexpected", "ID")]


def test_names_only(spark):
    ddl = "id string, at string, flag string"
    assert kinds(drift_rows(compared(spark, ddl, check_types=False))) == [("missing", "amount")]


def test_every_declared_type_matches_itself(spark):
    assert kinds(drift_rows(with_drift(layout_of(spark, RAW_LAYOUT)))) == []


def test_the_drift_gate(spark):
    advisory = drift_rows(compared(spark, "id tinyint, at timestamp, amount double, flag string"))
    assert enforce_schema(advisory)
    blocked = drift_rows(compared(spark, "at timestamp, amount double, flag string, more int"))
    assert not enforce_schema(blocked, strict=False)
    with pytest.raises(SchemaDriftError, match=r"missing\[id\] \(1 blocking, 1 advisory\)") as error:
        enforce_schema(blocked)
    assert error.value.drift.count() == 2


def test_the_summary_covers_conforming_extracts(spark):
    both = layout_of(spark, SMALL, "good").unionByName(layout_of(spark, SMALL[:2], "bad"))
    rows = {r.extract: r for r in drift_summary(with_drift(both, SMALL)).collect()}
    assert (rows["good"].conforms, rows["good"].blocking_count) == (True, 0)
    assert (rows["bad"].conforms, rows["bad"].blocking_count, rows["bad"].stored_columns) == (False, 2, 2)
    assert '"blocking_count":2' in rows["bad"].document


# -- storage


def test_staged_tables_live_in_the_shared_folder(spark):
    table, path = stage_table(small(spark), "t")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir", scratch_path(spark, "t")[:5]))
    assert table.schema.simpleString() == SMALL.simpleString() and table.count() == 1
    assert scratch_path(spark, "t") != scratch_path(spark, "t")


class _Session:
    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_a_cluster_has_to_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(_Session("spark://host:7077"), "t")
    assert scratch_path(_Session("yarn", "hdfs://nn/scratch"), "t").startswith("hdfs://nn/scratch/")
