from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lockgate.operators import trend as tr
from lockgate.operators.evaluate import RESULT_FIELDS
from lockgate.operators.history import History, new_run_id

EPOCH = datetime(2026, 8, 5, 6, 0, tzinfo=timezone.utc)


def report(spark, *rules, stage="bronze", rows=1000):
    """``rules`` are (name, pass rate) or, for dataset rules, (name, verdict)."""
    records = []
    for i, (name, value) in enumerate(rules):
        is_row = not isinstance(value, bool)
        passed = value >= 0.98 if is_row else value
        rate, threshold = (float(value), 0.98) if is_row else (None, None)
        kind = "row" if is_row else "dataset"
        records.append((stage, stage, i, name, name, "error", kind, passed, ["c"], threshold, rate, None, rows, None))
    return spark.createDataFrame(records, f"stage string, ruleset string, {RESULT_FIELDS}")


def at(days):
    return (EPOCH + timedelta(days=days)).strftime("%Y-%m-%dT%H:%M:%SZ")


@pytest.fixture
def past(spark, tmp_path):
    return History(spark, str(tmp_path / "history"))


def ids(frame):
    return [row.run_id for row in frame.collect()]


def test_a_history_without_runs(past):
    assert past.entries().count() == past.stages().count() == past.latest().count() == 0
    assert past.prune(1) == []


def test_entries_come_oldest_first_by_recording_time(spark, past):
    for run_id, day in (("2026-08-01", 1), ("2026-07-01", 2), ("z", 0), ("a", 0)):
        past.record(report(spark, ("r", 0.99)), run_id=run_id, recorded_at=at(day))
    assert ids(past.entries("bronze")) == ["a", "z", "2026-08-01", "2026-07-01"]


def test_recording_a_run_again_replaces_it(spark, past):
    for rate in (0.5, 0.99):
        past.record(report(spark, ("r", rate)), run_id="manual__2026-08-05T06:00:00+00:00")
    (row,) = past.results().collect()
    assert (row.pass_rate, row.run_id) == (0.99, "manual__2026-08-05T06:00:00+00:00")


def test_stages_are_kept_apart(spark, past):
    for stage in ("silver", "bronze"):
        past.record(report(spark, ("r", 0.99), stage=stage), run_id="1")
    assert [row.stage for row in past.stages().collect()] == ["bronze", "silver"]
    assert past.entries("bronze").count() == 1


def test_unreadable_files_are_passed_over(spark, past):
    for run_id in ("1", "2"):
        past.record(report(spark, ("r", 0.99)), run_id=run_id, recorded_at=at(int(run_id)))
    for file in Path(past.path).glob("stage=bronze/run_id=2/*.parquet"):
        file.write_bytes(b"PAR1 truncated")
    for checksum in Path(past.path).glob("stage=bronze/run_id=2/.*.crc"):
        checksum.unlink()
    assert ids(past.entries()) == ["1"]


def test_latest(spark, past):
    for i in (1, 2, 3):
        past.record(report(spark, ("r", 0.99)), run_id=f"run-{i}", recorded_at=at(i))
    assert ids(past.latest()) == ["run-3"]
    assert ids(past.latest(before="run-3")) == ["run-2"]
    assert ids(past.latest(before="run-1")) == []
    assert ids(past.latest(before="in-flight")) == ["run-3"]


def test_pruning_keeps_the_newest(spark, past):
    for i in range(5):
        past.record(report(spark, ("r", 0.99)), run_id=f"run:{i}", recorded_at=at(-i))
    past.record(report(spark, ("r", 0.99), stage="gold"), run_id="g", recorded_at=at(0))
    assert past.prune(30) == []
    assert past.prune(2) == [("bronze", f"run:{i}") for i in (4, 3, 2)]
    assert ids(past.entries("bronze")) == ["run:1", "run:0"]
    assert ids(past.entries("gold")) == ["g"]
    with pytest.raises(ValueError, match="non-negative"):
        past.prune(-1)


def test_run_ids_are_utc_and_sort_by_time():
    tokyo = EPOCH.astimezone(timezone(timedelta(hours=9)))
    assert new_run_id(tokyo) == "20260805T060000Z" < new_run_id(EPOCH + timedelta(seconds=1))


# -- trends


def compare(spark, before, after, **options):
    rows = tr.compare_reports(report(spark, *before), report(spark, *after), **options)
    return {row["name"]: row for row in rows.collect()}


@pytest.mark.parametrize(
    "before, after, kind",
    [
        (0.999, 0.985, "regressed"),
        (0.985, 0.999, "improved"),
        (0.999, 0.997, "steady"),
        (0.9801, 0.9799, "regressed"),
        (0.9799, 0.9801, "improved"),
        (0.90, 0.80, "regressed"),
        (True, True, "steady"),
        (True, False, "regressed"),
        (False, True, "improved"),
        (False, False, "steady"),
    ],
)
def test_grades(spark, before, after, kind):
    row = compare(spark, [("r", before)], [("r", after)])["r"]
    assert row.kind == kind
    assert (row.delta is None) == isinstance(before, bool)


def test_broken_rules_new_rules_and_dropped_rules(spark):
    got = compare(spark, [("a", 0.99), ("gone", 0.99)], [("a", 0.90), ("new", 0.99)])
    assert {name: row.kind for name, row in got.items()} == {"a": "regressed", "gone": "dropped", "new": "new"}
    assert {name for name, row in got.items() if row.broke} == {"a"}
    assert {(row.previous_rows, row.current_rows) for row in got.values()} == {(1000, 1000)}


def test_the_tolerance_is_a_choice(spark):
    assert compare(spark, [("r", 0.999)], [("r", 0.997)], tolerance=0.001)["r"].kind == "regressed"
    with pytest.raises(ValueError, match="non-negative"):
        compare(spark, [("r", 1.0)], [("r", 1.0)], tolerance=-0.1)


def test_different_stages_are_not_compared(spark):
    mixed = tr.compare_reports(report(spark, ("r", 0.99)), report(spark, ("r", 0.99), stage="silver"))
    with pytest.raises(Exception, match="no report to compare with"):
        mixed.collect()


def test_summary_and_lines(spark):
    before = report(spark, ("a", 0.99), ("b", 0.99), ("d", True), ("gone", 0.99), rows=8080)
    after = report(spark, ("a", 0.90), ("b", 0.993), ("d", False), ("new", 0.99), rows=8200)
    trend = tr.compare_reports(before, after)
    summary = tr.trend_summary(trend).first()
    assert (summary.regression_count, summary.broken_count, summary.stable) == (2, 2, False)
    assert (summary.row_delta, round(summary.row_change, 4)) == (120, 0.0149)
    assert '"regression_count":2' in summary.document
    lines = {r["name"]: r.line for r in trend.select("name", tr.trend_line().alias("line")).collect()}
    assert lines == {
        "a": "[DOWN] a: 99.0000% -> 90.0000% (-9.0000%), now below its threshold",
        "b": "[  = ] b: 99.0000% -> 99.3000% (+0.3000%)",
        "d": "[DOWN] d: pass -> fail, now below its threshold",
        "gone": "[GONE] gone: was 99.0000%, no longer checked",
        "new": "[NEW ] new: not checked last run, now 99.0000%",
    }
    with pytest.raises(tr.QualityRegressed, match="bronze: 2 rules"):
        tr.block_on_regression(tr.trend_summary(trend))


def test_lines_of_rules_without_rates(spark):
    trend = tr.compare_reports(report(spark, ("a", 1.0), ("gone", True)), report(spark, ("a", 1.0), ("new", True)))
    lines = {r["name"]: r.line for r in trend.select("name", tr.trend_line().alias("line")).collect()}
    assert lines["new"] == "[NEW ] new: not checked last run, now -"
    assert lines["gone"] == "[GONE] gone: was -, no longer checked"


def test_no_previous_rows_no_ratio(spark):
    trend = tr.compare_reports(report(spark, ("a", 1.0), rows=0), report(spark, ("a", 1.0)))
    summary = tr.trend_summary(trend).first()
    assert (summary.row_delta, summary.row_change, summary.stable) == (1000, None, True)
    tr.block_on_regression(tr.trend_summary(trend))


def test_the_two_newest_runs_of_every_stage(spark, past):
    rates = {("bronze", 0): 0.5, ("bronze", 1): 0.99, ("bronze", 2): 0.90, ("silver", 0): 0.9}
    for (stage, day), rate in rates.items():
        past.record(report(spark, ("r", rate), stage=stage), run_id=f"run-{day}", recorded_at=at(day))
    (row,) = tr.compare_runs(past.results()).collect()
    assert (row.stage, row.previous_run_id, row.current_run_id) == ("bronze", "run-1", "run-2")
    assert row.broke
