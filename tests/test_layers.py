from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lockgate.sources import storage
from lockgate.sources.layers import merge_layer, settle, write_layer

DDL = "id int, pickup_date date, kind string"
DAYS = [date(2026, 6, d) for d in range(1, 8)]
LAYOUT = T.StructType().add("id", "integer").add("kind", "string").add("pickup_date", "date")


def frame(spark, days, ident=1):
    return spark.createDataFrame([(ident, day, "a") for day in days], DDL)


def on_disk(path):
    return sorted(p.name.split("=", 1)[1] for p in path.iterdir() if p.name.startswith("pickup_date="))


def contents(spark, path):
    rows = spark.read.schema(DDL).parquet(str(path)).collect()
    return {(row.pickup_date and row.pickup_date.day, row.id) for row in rows}


def test_a_run_replaces_the_days_it_produced(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(frame(spark, DAYS), str(path))
    assert on_disk(path) == [str(day) for day in DAYS]
    write_layer(frame(spark, [DAYS[2]], 2), str(path), since=DAYS[2], until=DAYS[2])
    assert contents(spark, path) == {(d.day, 2 if d == DAYS[2] else 1) for d in DAYS}


def test_days_of_the_window_without_rows_do_not_keep_old_ones(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(frame(spark, [*DAYS, None]), str(path))
    write_layer(frame(spark, [DAYS[1]], 2), str(path), since=DAYS[0], until=DAYS[2])
    assert contents(spark, path) == {(2, 2), *((d.day, 1) for d in DAYS[3:]), (None, 1)}


def test_a_run_without_a_window_leaves_other_days_alone(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(frame(spark, DAYS), str(path))
    write_layer(frame(spark, DAYS[:2], 2), str(path))
    assert contents(spark, path) == {(1, 2), (2, 2), *((d.day, 1) for d in DAYS[2:])}


def test_replacing_all_removes_every_other_day(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(frame(spark, [*DAYS, None]), str(path))
    write_layer(frame(spark, DAYS[:2], 2), str(path), replace_all=True)
    assert contents(spark, path) == {(1, 2), (2, 2)}


def test_nothing_rejected_clears_the_window_without_a_write(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(frame(spark, DAYS), str(path))
    nothing = frame(spark, DAYS).filter(F.lit(False))
    write_layer(nothing, str(path), since=DAYS[5], empty=True)
    assert contents(spark, path) == {(d.day, 1) for d in DAYS[:5]}


def test_writing_twice_changes_nothing(spark, tmp_path):
    path = tmp_path / "t"
    for _ in range(2):
        write_layer(frame(spark, DAYS), str(path))
    assert spark.read.parquet(str(path)).count() == len(DAYS)


def test_several_partition_columns(spark, tmp_path):
    path, by = tmp_path / "t", ("pickup_date", "kind")
    write_layer(frame(spark, DAYS), str(path), partition_by=by)
    again = frame(spark, [DAYS[0]], 2).withColumn("kind", F.lit("b"))
    write_layer(again, str(path), partition_by=by, since=DAYS[0], until=DAYS[0])
    assert contents(spark, path) == {(1, 2), *((d.day, 1) for d in DAYS[1:])}


def test_flat_layers_are_replaced_whole(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(frame(spark, DAYS), str(path), partition_by=())
    write_layer(frame(spark, DAYS[:1], 2), str(path), partition_by=())
    assert on_disk(path) == [] and contents(spark, path) == {(1, 2)}


def test_appending_removes_nothing(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(frame(spark, DAYS), str(path))
    write_layer(frame(spark, DAYS[:1], 2), str(path), mode="append")
    assert contents(spark, path) == {(1, 2), *((d.day, 1) for d in DAYS)}


@pytest.mark.parametrize("adaptive, most_files", [("true", 1), ("false", 4)])
def test_a_day_is_written_to_few_files(spark, conf, tmp_path, adaptive, most_files):
    conf("spark.sql.adaptive.enabled", adaptive)
    path = tmp_path / "t"
    rows = spark.range(4000).select(
        F.col("id").cast("int"),
        F.date_add(F.lit(DAYS[0]), (F.col("id") % 3).cast("int")).alias("pickup_date"),
        F.lit("a").alias("kind"),
    )
    write_layer(rows.repartition(16), str(path))
    for day in path.glob("pickup_date=*"):
        assert 1 <= len(list(day.glob("*.parquet"))) <= most_files
    assert spark.read.parquet(str(path)).count() == 4000


def test_a_day_that_holds_most_rows_is_written_by_several_tasks(spark, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100000")
    path = tmp_path / "t"
    rows = spark.range(0, 300_000, 1, 8).select(
        F.col("id").cast("int"),
        F.when(F.col("id") % 10 == 0, F.lit(DAYS[1])).otherwise(F.lit(DAYS[0])).alias("pickup_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("kind"),
    )
    write_layer(rows, str(path))
    files = {p.name: len(list(p.glob("*.parquet"))) for p in path.glob("pickup_date=*")}
    assert files[f"pickup_date={DAYS[0]}"] > 4
    assert spark.read.parquet(str(path)).count() == 300_000


def files_of(path, days):
    return {p: p.stat().st_mtime_ns for day in days for p in path.glob(f"pickup_date={day}/*.parquet")}


def test_a_late_row_joins_its_day_and_leaves_the_others_alone(spark, tmp_path):
    path = tmp_path / "t"
    first = frame(spark, DAYS).unionByName(frame(spark, DAYS, 2))
    write_layer(first, str(path))
    others = files_of(path, [*DAYS[:4], *DAYS[5:]])
    touched = merge_layer(frame(spark, [DAYS[4]], 3), str(path), LAYOUT)
    assert touched == [(DAYS[4],)]
    assert contents(spark, path) == {(d.day, i) for d in DAYS for i in (1, 2)} | {(5, 3)}
    assert files_of(path, [*DAYS[:4], *DAYS[5:]]) == others


def test_loads_may_come_in_any_order_and_twice(spark, tmp_path):
    rows = [[(1, DAYS[0], "b"), (2, DAYS[0], None), (3, DAYS[1], "a")], [(1, DAYS[0], "a"), (2, DAYS[0], "z"), (4, None, "n")]]
    loads = [spark.createDataFrame(r, DDL) for r in rows]
    found = []
    for number, order in enumerate([(0, 1), (1, 0), (0, 1, 0, 1)]):
        path = str(tmp_path / str(number))
        for load in order:
            merge_layer(loads[load], path, LAYOUT, key="id")
        found.append(sorted(map(str, spark.read.schema(DDL).parquet(path).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 4
    assert any("id=1" in row and "kind='a'" in row for row in found[0])


def test_without_a_key_only_equal_rows_are_one(spark, tmp_path):
    path = str(tmp_path / "t")
    for kind in ("a", "b", "a"):
        merge_layer(frame(spark, DAYS[:2]).withColumn("kind", F.lit(kind)), path, LAYOUT)
    assert spark.read.parquet(path).count() == 4


def test_merging_by_several_partition_columns_and_with_nothing(spark, tmp_path):
    path, by = tmp_path / "t", ("pickup_date", "kind")
    for ident, kind in ((1, "a"), (2, "a"), (3, None)):
        rows = frame(spark, DAYS[:2], ident).withColumn("kind", F.lit(kind))
        assert len(merge_layer(rows, str(path), LAYOUT, partition_by=by)) == 2
    assert merge_layer(frame(spark, DAYS).limit(0), str(path), LAYOUT, partition_by=by) == []
    assert contents(spark, path) == {(d.day, i) for d in DAYS[:2] for i in (1, 2, 3)}
    with pytest.raises(ValueError, match="flat"):
        merge_layer(frame(spark, DAYS), str(path), LAYOUT, partition_by=())


def test_a_run_over_listed_days_clears_those_it_has_no_rows_for(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(frame(spark, [*DAYS, None]), str(path))
    write_layer(frame(spark, [DAYS[0]], 2), str(path), days=(DAYS[0], DAYS[3], None))
    assert contents(spark, path) == {(1, 2), *((d.day, 1) for d in DAYS if d.day not in (1, 4))}


class Died(Exception):
    pass


def dies(monkeypatch, name, calls):
    """The run ends in call number ``calls`` of a step of the file system."""
    whole, left = getattr(storage, name), [calls]

    def step(*args):
        left[0] -= 1
        if not left[0]:
            raise Died
        return whole(*args)

    monkeypatch.setattr(storage, name, step)


def leftovers(path):
    return [p for p in path.iterdir() if p.name.startswith("_")]


@pytest.mark.parametrize("calls", range(1, 5))
def test_a_run_that_dies_is_finished_by_the_next_or_never_was(spark, monkeypatch, tmp_path, calls):
    path = tmp_path / "t"
    write_layer(frame(spark, DAYS), str(path))
    with monkeypatch.context() as m:
        dies(m, "move", calls)  # the first call records the steps, the others take them
        with pytest.raises(Died):
            write_layer(frame(spark, DAYS[1:4], 2), str(path), since=DAYS[0], until=DAYS[4])
    after = {(2, 2), (3, 2), (4, 2), (6, 1), (7, 1)}
    assert settle(spark, str(path)) == (calls > 1)
    assert contents(spark, path) == (after if calls > 1 else {(d.day, 1) for d in DAYS})
    assert not settle(spark, str(path)) and not leftovers(path)


@pytest.mark.parametrize("calls", (1, 2, 3))
def test_dying_again_while_finishing(spark, monkeypatch, tmp_path, calls):
    path = tmp_path / "t"
    write_layer(frame(spark, DAYS), str(path))
    with monkeypatch.context() as m:
        dies(m, "move", 2)
        with pytest.raises(Died):
            write_layer(frame(spark, DAYS[1:4], 2), str(path), replace_all=True)
    with monkeypatch.context() as m:
        dies(m, "delete", calls)
        with pytest.raises(Died):
            settle(spark, str(path))
    # the next write finishes it before it does its own
    write_layer(frame(spark, [DAYS[1]], 3), str(path))
    assert contents(spark, path) == {(2, 3), (3, 2), (4, 2)} and not leftovers(path)


def test_a_merge_and_a_flat_write_that_die_lose_nothing(spark, monkeypatch, tmp_path):
    days, flat = tmp_path / "days", tmp_path / "flat"
    write_layer(frame(spark, DAYS), str(days))
    write_layer(frame(spark, DAYS), str(flat), partition_by=())
    with monkeypatch.context() as m:
        dies(m, "move", 2)
        with pytest.raises(Died):
            merge_layer(frame(spark, DAYS[:2], 2), str(days), LAYOUT)
    with monkeypatch.context() as m:
        dies(m, "delete", 2)
        with pytest.raises(Died):
            write_layer(frame(spark, DAYS[:1], 2), str(flat), partition_by=())
    assert settle(spark, str(days)) and settle(spark, str(flat))
    assert contents(spark, days) == {(d.day, 1) for d in DAYS} | {(1, 2), (2, 2)}
    assert contents(spark, flat) == {(1, 2)}


def test_a_layer_can_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = tmp_path / "t"
    write_layer(frame(spark, DAYS), str(path))
    rows = spark.read.schema(DDL).parquet(str(path)).filter(F.dayofmonth("pickup_date") < 4)
    write_layer(rows, str(path), replace_all=True)
    assert contents(spark, path) == {(1, 1), (2, 1), (3, 1)}


def test_trip_ids_of_any_text_are_written_as_they_came(spark, tmp_path):
    ids = ["0aff", "0AFF", "aff", "", "g1", None, "ab" * 32]
    rows = spark.createDataFrame([(i, day) for i in ids for day in DAYS[:2]], "trip_id string, pickup_date date")
    write_layer(rows, str(tmp_path / "t"))
    stored = spark.read.schema(rows.schema).parquet(str(tmp_path / "t"))
    assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))
    assert all(".zstd." in p.name for p in (tmp_path / "t").glob("pickup_date=*/*.parquet"))


def test_a_large_merge_shuffles_once_and_keeps_days_together(spark, monkeypatch, tmp_path):
    from lockgate.operators import trips

    days = 3
    rows = spark.range(0, 6000, 1, 6).select(
        F.sha2((F.col("id") % 2000).cast("string"), 256).alias("id"),
        F.date_add(F.lit(DAYS[0]), (F.col("id") % 2000 % days).cast("int")).alias("pickup_date"),
        F.col("id").cast("string").alias("kind"),
    )
    found = []
    for bound in (10**9, 0):
        monkeypatch.setattr(trips, "SORTED_ROWS", bound)
        path = tmp_path / str(bound)
        for part in (rows.filter("kind < '3'"), rows):
            merge_layer(part, str(path), rows.schema, key="id")
        assert len(list(path.glob("pickup_date=*/*.parquet"))) < days + 6
        found.append(sorted(map(str, spark.read.schema(rows.schema).parquet(str(path)).collect())))
    assert found[0] == found[1] and len(found[0]) == 2000
    merged = trips.first_copies(trips.gathered(rows, "id", ["pickup_date"]), "id", ["pickup_date"])
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
