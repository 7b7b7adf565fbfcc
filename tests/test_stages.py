"""Runs over the smallest tables: what is published, diverted, recorded, refused."""

from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from checks.trips import DIRTY_FEED, trips
from lockgate import layouts as L
from lockgate.operators.drift import SchemaDriftError
from lockgate.operators.evaluate import FAILURES, as_measures, evaluate, measured_apart, results_of, route
from lockgate.operators.gate import QualityGateFailed
from lockgate.operators.mart import INPUT, daily_zone_metrics
from lockgate.operators.history import History
from lockgate.operators.rules import RuleSet, row_count_at_least, unique
from lockgate.operators.rulesets import bronze_ruleset, silver_ruleset
from lockgate.operators.trend import compare_runs
from lockgate.operators.trips import deduplicate, enrich
from lockgate.plans import stages
from lockgate.plans.config import RunConfig
from lockgate.operators import trips as trip_steps
from lockgate.sources import layers
from lockgate.sources.layers import NothingToPublish, read_layer, write_layer

SF = "/root/testdata/sf0.001"
DAY = date(2026, 6, 3)
ABSENT = date(2030, 1, 1)


def feed(spark, folder, period=200, drop=()):
    path = str(folder / f"raw-{period}-{len(drop)}")
    q.instants(trips(spark, SF, period=period)).drop(*drop).write.mode("overwrite").parquet(path)
    return path


def gold(spark, config):
    rows = spark.read.schema(L.GOLD_LAYOUT).parquet(config.layer_path("gold")).collect()
    return {(row.pickup_date, row.pu_location_id): tuple(row) for row in rows}


@pytest.fixture(scope="module")
def completed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    config = RunConfig(str(folder / "warehouse"), feed(spark, folder), run_id="first")
    return folder, config, stages.run_all(config, spark)


def test_counts(spark, completed):
    _, config, result = completed
    counts = {r.stage: (r.rows_in, r.rows_out, r.rows_quarantined) for r in stages.stage_counts(spark, result).collect()}
    assert counts == {"bronze": (6134, 5923, 211), "silver": (5923, 5822, 0), "gold": (5822, 1381, 0)}
    assert result.passed and result["gold"].rows_out == len(gold(spark, config)) == 1381
    assert list(result) == ["bronze", "silver", "gold"]
    with pytest.raises(KeyError, match="platinum"):
        result["platinum"]


def test_rejected_rows_are_kept_with_reasons_by_day(spark, completed):
    _, config, _ = completed
    path = Path(config.quarantine_path("bronze"))
    assert spark.read.parquet(str(path)).filter(F.size(FAILURES) > 0).count() == 211
    assert len(list(path.glob("pickup_date=*"))) == 7


def test_reports_layouts_and_history_are_recorded(spark, completed):
    _, config, _ = completed
    assert spark.read.json(config.schema_diff_path).first().conforms is True
    assert '"passed":true' in spark.read.json(config.report_path("silver")).first().document
    entries = History(spark, config.history_path).entries().collect()
    assert {(e.stage, e.run_id) for e in entries} == {(s, "first") for s in ("bronze", "silver", "gold")}


def test_every_layer_is_partitioned_by_day(completed):
    _, config, _ = completed
    for path in (config.layer_path("bronze"), config.layer_path("silver"), config.layer_path("gold")):
        assert len(list(Path(path).glob("pickup_date=*"))) == 7


def test_a_backfill_replaces_its_day_and_a_rerun_changes_nothing(spark, completed):
    folder, config, _ = completed
    before = gold(spark, config)
    dirty = replace(
        config, input_path=feed(spark, folder, DIRTY_FEED), since=DAY, until=DAY, run_id="second", enforce_gates=False
    )
    result = stages.run_all(dirty, spark)
    assert result["bronze"].rows_without_date == 0
    after = gold(spark, config)
    assert {k: v for k, v in before.items() if k[0] != DAY} == {k: v for k, v in after.items() if k[0] != DAY}
    assert {k for k in before if before[k] != after.get(k)} and {k[0] for k in after} == {k[0] for k in before}
    trend = compare_runs(History(spark, config.history_path).results())
    assert trend.filter("broke AND stage = 'bronze'").count() == 7
    stages.run_all(replace(config, since=DAY, until=DAY, history_limit=1, run_id="third"), spark)
    assert gold(spark, config) == before
    assert {e.run_id for e in History(spark, config.history_path).entries().collect()} == {"third"}


def test_a_blocked_run_leaves_its_report_and_publishes_nothing(spark, tmp_path):
    config = RunConfig(str(tmp_path / "w"), feed(spark, tmp_path, DIRTY_FEED), run_id="x")
    with pytest.raises(QualityGateFailed) as failed:
        stages.run_all(config, spark)
    assert failed.value.stage == "bronze" and len(failed.value.errors) == 7
    assert '"passed":false' in spark.read.json(config.report_path("bronze")).first().document
    assert History(spark, config.history_path).entries().first().passed is False
    assert not Path(config.layer_path("bronze")).exists() and not Path(config.quarantine_path("bronze")).exists()


def test_a_missing_column_stops_the_run_before_it_reads(spark, tmp_path):
    config = RunConfig(str(tmp_path / "w"), feed(spark, tmp_path, drop=("fare_amount",)))
    with pytest.raises(SchemaDriftError, match=r"missing\[fare_amount\]"):
        stages.run_all(config, spark)
    assert spark.read.json(config.schema_diff_path).first().blocking_count == 1
    assert not Path(config.report_path("bronze")).exists()
    # With gates off every row breaks a fare rule, so nothing is left.
    with pytest.raises(NothingToPublish):
        stages.run_all(replace(config, enforce_gates=False), spark)
    unchecked = replace(config, check_input_schema=False, warehouse=str(tmp_path / "u"))
    with pytest.raises(QualityGateFailed):
        stages.run_all(unchecked, spark)
    assert not Path(unchecked.schema_diff_path).exists()


def test_a_window_without_rows(spark, tmp_path):
    config = RunConfig(str(tmp_path / "w"), feed(spark, tmp_path), since=ABSENT, until=ABSENT)
    with pytest.raises(QualityGateFailed) as failed:
        stages.run_bronze(config, spark)
    assert failed.value.errors == ["row_count_at_least"]
    with pytest.raises(NothingToPublish) as nothing:
        stages.run_bronze(replace(config, enforce_gates=False), spark)
    assert (nothing.value.stage, nothing.value.rows_in) == ("bronze", 0)


def test_quarantine_and_history_can_be_off(spark, tmp_path):
    config = RunConfig(
        str(tmp_path / "w"), feed(spark, tmp_path), quarantine_enabled=False, keep_history=False, partition_by=()
    )
    bronze = stages.run_bronze(config, spark)
    assert (bronze.rows_out, bronze.rows_quarantined) == (bronze.rows_in, 0)
    assert not Path(config.history_path).exists() and not list(Path(config.layer_path("bronze")).glob("pickup_date=*"))


def test_trouble_with_the_history_does_not_break_a_run(spark, tmp_path):
    config = RunConfig(str(tmp_path / "w"), feed(spark, tmp_path), run_id="x")
    Path(config.history_path).parent.mkdir(parents=True)
    Path(config.history_path).write_text("in the way")
    assert stages.run_bronze(config, spark).passed


def test_switches_are_checked():
    with pytest.raises(ValueError, match="history_limit"):
        RunConfig("w", history_limit=0)
    with pytest.raises(ValueError, match="since must not be after until"):
        RunConfig("w", since=ABSENT, until=DAY)
    with pytest.raises(ValueError, match="write_mode"):
        RunConfig("w", write_mode="upsert")
    with pytest.raises(ValueError, match="merging"):
        RunConfig("w", write_mode="merge", replace_all=True)
    with pytest.raises(ValueError, match="merging"):
        RunConfig("w", write_mode="merge", partition_by=())


def test_bronze_reads_the_raw_extract_in_one_write(spark, tmp_path, monkeypatch):
    raw = feed(spark, tmp_path)
    since = [r.tpep_pickup_datetime.date() >= DAY for r in trips(spark, SF).collect()].count(True)
    record = stages._record

    def recorded(*args):
        # all rows are in the staging table by now; nothing may go back to the extract
        for file in Path(raw).glob("*.parquet"):
            file.unlink()
        record(*args)

    monkeypatch.setattr(stages, "_record", recorded)
    result = stages.run_bronze(RunConfig(str(tmp_path / "w"), raw, since=DAY), spark)
    assert (result.rows_in, result.rows_without_date) == (since, 0)
    assert result.rows_out + result.rows_quarantined == since


def test_silver_shuffles_by_trip_once(spark, capsys):
    kept, _ = q.bronze_halves(spark, SF)
    routed, _ = route(enrich(deduplicate(kept)), silver_ruleset(), keyed_by="trip_id")
    routed.explain()
    assert capsys.readouterr().out.count("Exchange ") == 1


@pytest.mark.parametrize(
    "rules", [bronze_ruleset, lambda: RuleSet("u", (), (unique("trip_id"), row_count_at_least(9)))]
)
def test_observed_counts_are_the_measured_ones(spark, rules):
    ruleset = rules()
    rows = q.shaped(spark, SF, DIRTY_FEED)
    routed, seen = route(rows, ruleset)
    routed.write.format("noop").mode("overwrite").save()
    counts = dict(seen.get)
    counts |= measured_apart(rows, ruleset, counts)
    report = results_of(as_measures(spark, counts, ruleset), ruleset)
    assert sorted(map(str, report.collect())) == sorted(map(str, evaluate(rows, ruleset).collect()))


def test_surplus_copies_are_counted_where_they_are(spark):
    rows = spark.createDataFrame([(i // 3 if i < 30 else None,) for i in range(40)], "k int").repartition("k")
    routed, seen = route(rows, RuleSet("u", (), (unique("k"),)), keyed_by="k")
    assert routed.count() == 40 and seen.get["metric_0"] == 20.0


def test_the_mart_needs_no_sort_fallback_and_its_median_is_exact(spark, conf, capsys):
    conf("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "1")
    zones = 10_000
    rows = spark.range(0, 60_000, 1, 1).select(
        F.lit(DAY).alias("pickup_date"),
        F.when(F.col("id") % zones != 5, (F.col("id") % zones).cast("int")).alias("pu_location_id"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 37 % 101) / 4.0).alias("trip_duration_min"),
        *(F.lit(1.0).alias(c) for c in ("total_amount", "trip_distance", "tip_pct")),
        F.lit(True).alias("is_airport_trip"),
    )
    mart = daily_zone_metrics(rows, sort=False)
    mart.explain()
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    values = {}
    for row in rows.collect():
        values.setdefault(row.pu_location_id, []).append(row.trip_duration_min)
    found = {row.pu_location_id: row for row in mart.collect()}
    assert set(found) == set(values) and len(found) == zones
    for zone, minutes in values.items():
        known = sorted(m for m in minutes if m is not None)
        median = known[(len(known) - 1) // 2] if known else None
        assert found[zone].trips == len(minutes)
        assert found[zone].median_duration_min == (None if median is None else pytest.approx(median, abs=0.006))


def test_late_rows_change_their_days_only(spark, tmp_path):
    first, second = (replace(c, warehouse=str(tmp_path / "w")) for c in q.late_loads(spark, SF))
    assert stages.run_all(first, spark)["gold"].days is not None

    def written():
        return {
            p: p.stat().st_mtime_ns
            for layer in ("bronze", "silver", "gold")
            for p in Path(second.layer_path(layer)).glob("pickup_date=*/*.parquet")
        }

    before = written()
    result = stages.run_all(second, spark)
    days = {f"pickup_date=2026-06-0{d}" for d in q.LATE_DAYS}
    assert {str(day) for day in result["silver"].days} == {d.partition("=")[2] for d in days}
    kept = {p for p in before if p.parent.name not in days}
    assert {p: written()[p] for p in kept} == {p: before[p] for p in kept}
    assert not {p for p in before if p.parent.name in days} & set(written())
    assert result["silver"].rows_in > second_load_rows(spark, second)


def second_load_rows(spark, config):
    return spark.read.parquet(config.input_path).count()


def test_rows_are_staged_without_being_sorted_by_verdict(spark, tmp_path, monkeypatch):
    places, scratch, record = [], stages.storage.scratch_path, stages._record

    def placed(*args):
        places.append(scratch(*args))
        return places[-1]

    def recorded(*args):
        staged = Path(places[-1].removeprefix("file:"))
        assert list(staged.glob("*.parquet")) and not list(staged.glob("_dq_kept=*"))
        assert "trip_id" not in spark.read.parquet(str(staged)).columns
        record(*args)

    monkeypatch.setattr(stages.storage, "scratch_path", placed)
    monkeypatch.setattr(stages, "_record", recorded)
    result = stages.run_bronze(RunConfig(str(tmp_path / "w"), feed(spark, tmp_path)), spark)
    assert (result.rows_out, result.rows_quarantined) == (5923, 211)


def test_a_query_stages_no_more_columns_than_it_reads(spark, monkeypatch):
    staged = []

    def stage_table(df, label):
        staged.append(df.columns)
        return df, label

    monkeypatch.setattr(q, "stage_table", stage_table)
    q.gold(spark, SF)
    q.report_summary_lines(spark, SF)
    assert sorted(staged[0]) == sorted(INPUT) and "total_amount" not in staged[1]
    assert "trip_id" not in staged[0] and "trip_id" in staged[1]


def test_ids_that_follow_from_their_row_are_not_staged(spark, monkeypatch, tmp_path):
    config = RunConfig(str(tmp_path / "w"), feed(spark, tmp_path), run_id="r")
    stages.run_bronze(config, spark)
    places, scratch, delete = {}, stages.storage.scratch_path, stages.storage.delete

    def placed(session, label):
        places[label] = scratch(session, label)
        return places[label]

    with monkeypatch.context() as patch:
        patch.setattr(stages.storage, "scratch_path", placed)
        patch.setattr(stages.storage, "delete", lambda session, path: path in places.values() or delete(session, path))
        stages.run_silver(config, spark)
    staged = spark.read.parquet(places["silver"])
    ids = staged.agg(F.count("trip_id"), F.count("_trip_id_bytes"), F.count(F.lit(1))).first()
    delete(spark, places["silver"])
    silver = spark.read.schema(L.SILVER_LAYOUT).parquet(config.layer_path("silver"))
    bronze = spark.read.schema(L.BRONZE_LAYOUT).parquet(config.layer_path("bronze"))
    assert tuple(ids)[:2] == (0, 0) and ids[2] >= silver.count() > 0
    assert not silver.select("trip_id").exceptAll(bronze.select("trip_id")).count()


@pytest.mark.parametrize("by_hand", [False, True])
def test_silver_shuffles_rows_once_for_copies_and_days(spark, monkeypatch, tmp_path, by_hand):
    """Many rows: as few rows give it, in files of few days, without a second shuffle; ids that
    do not follow from their row may have copies on several days."""
    config = RunConfig(str(tmp_path / "w"), feed(spark, tmp_path), run_id="r", enforce_gates=False)
    stages.run_bronze(config, spark)
    if by_hand:
        bronze = spark.read.schema(L.BRONZE_LAYOUT).parquet(config.layer_path("bronze"))
        given = bronze.withColumn("trip_id", F.when(F.hour("pickup_at") > 2, F.col("trip_id")).otherwise("twin"))
        write_layer(given, config.layer_path("bronze"))
    arranged, arrange, found = [], layers._arranged, []
    monkeypatch.setattr(layers, "_arranged", lambda df, by: arranged.append(by) or arrange(df, by))
    for bound in (10**9, 0):
        monkeypatch.setattr(trip_steps, "SORTED_ROWS", bound)
        result = stages.run_silver(config, spark)
        rows = read_layer(spark, config.layer_path("silver"), L.SILVER_LAYOUT)
        report = result.report.drop("stage").collect()
        found.append((result.rows_in, result.rows_out, result.rows_quarantined, sorted(map(str, report + rows.collect()))))
    assert found[0] == found[1] and found[0][1] > 0
    assert len(arranged) == (2 if by_hand else 1)
    assert len(list(Path(config.layer_path("silver")).glob("pickup_date=*/*.parquet"))) <= 7 + 8


@pytest.mark.parametrize("by_hand", [False, True])
def test_merges_deal_rows_by_their_fields_where_ids_follow(spark, monkeypatch, tmp_path, by_hand):
    """Many rows: as few rows give it; ids given by hand do not follow from their row, and may be shared."""
    loads = q.late_loads(spark, SF)
    found = []
    for bound in (10**9, 0):
        monkeypatch.setattr(trip_steps, "SORTED_ROWS", bound)
        first, second = (replace(c, warehouse=str(tmp_path / f"w{bound}")) for c in loads)
        assert stages.run_bronze(first, spark).digests
        bronze = spark.read.schema(L.BRONZE_LAYOUT).parquet(first.layer_path("bronze"))
        if by_hand:
            own = F.concat(F.lit("twin of "), F.col("pickup_date").cast("string"))
            given = bronze.withColumn("trip_id", F.when(F.hour("pickup_at") > 2, F.col("trip_id")).otherwise(own))
            write_layer(given, first.layer_path("bronze"))
        merged = stages.run_bronze(second, spark)
        assert merged.digests != by_hand
        result = stages.run_silver(second, spark, merged.days, digests=merged.digests)
        rows = [read_layer(spark, second.layer_path(s), kind).collect() for s, kind in (("bronze", L.BRONZE_LAYOUT), ("silver", L.SILVER_LAYOUT))]
        report = result.report.drop("stage").collect()
        found.append((result.rows_in, result.rows_out, *(sorted(map(str, part)) for part in (*rows, report))))
    assert found[0] == found[1] and found[0][1] > 0
