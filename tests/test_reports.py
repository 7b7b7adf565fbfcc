import pytest
from pyspark.sql import functions as F

from lockgate.functions.text import six_digits
from lockgate.operators import rules as r
from lockgate.operators.evaluate import evaluate
from lockgate.operators.gate import QualityGateFailed, enforce, failures, verdicts
from lockgate.operators.report import from_documents, rule_line, to_documents


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(i, i if i < 970 else None) for i in range(1000)], "id int, v int")
    rules = (
        r.not_null("id"),
        r.not_null("v", threshold=0.98),
        r.not_null("v", name="watch", severity=r.Severity.WARN),
    )
    return evaluate(df, r.RuleSet("s", rules, (r.row_count_at_least(2000),)), stage="bronze")


def test_the_verdict_counts_errors_and_warnings(results):
    row = verdicts(results).first()
    assert (row.stage, row.passed, row.error_count, row.warning_count) == ("bronze", False, 2, 1)
    assert (row.errors, row.warnings) == (["not_null[v]", "row_count_at_least"], ["watch"])
    assert failures(results).count() == 3


def test_the_gate_raises_with_the_whole_report(results):
    with pytest.raises(QualityGateFailed, match=r"2 blocking, 1 warning") as failed:
        enforce(results)
    assert failed.value.errors == ["not_null[v]", "row_count_at_least"]
    assert failed.value.report.count() == 4


def test_the_gate_can_report_only(results):
    assert enforce(results, strict=False) is False


def test_warnings_never_block(results):
    assert enforce(results.filter("severity = 'warn' OR passed")) is True


def test_lines(results):
    lines = [row.line for row in results.select("position", rule_line().alias("line")).orderBy("position").collect()]
    assert lines == [
        "[PASS] not_null[id]: 100.0000% pass (need 100.00%)",
        "[FAIL] not_null[v]: 97.0000% pass (need 98.00%), 30 bad rows",
        "[FAIL] watch: 97.0000% pass (need 100.00%), 30 bad rows",
        "[FAIL] row_count_at_least: metric=1000",
    ]


def test_large_counts_and_missing_metrics(spark, results):
    many = results.filter("position = 1").withColumn("failing_rows", F.lit(1234567))
    assert many.select(rule_line()).first()[0].endswith("1,234,567 bad rows")
    bare = results.filter("position = 1").withColumn("threshold", F.lit(None).cast("double"))
    assert bare.select(rule_line()).first()[0] == "[FAIL] not_null[v]: 97.0000% pass, 30 bad rows"
    none = results.filter("position = 3").withColumn("metric", F.lit(None).cast("double"))
    assert none.select(rule_line()).first()[0] == "[FAIL] row_count_at_least: no metric"


@pytest.mark.parametrize("value", [0.0, 1.0, 2.5, 61185.0, 123456.0, 999999.5, 1234567.0, 1e20, 0.0001, 1.5e-5, 1 / 3, -42.125, 100000.0])
def test_six_digits_like_g(spark, value):
    assert spark.range(1).select(six_digits(F.lit(value))).first()[0] == f"{value:g}"


def test_documents_round_trip(results):
    restored = from_documents(to_documents(results))
    order = results.columns
    assert restored.select(order).orderBy("position").collect() == results.orderBy("position").collect()


def test_a_documents_own_verdict_is_not_believed(results):
    forged = to_documents(results).withColumn(
        "document", F.regexp_replace("document", '"passed":false,"error_count":2', '"passed":true,"error_count":0')
    )
    assert verdicts(from_documents(forged)).first().error_count == 2


def test_corrupt_documents_are_skipped_and_absent_keys_tolerated(spark):
    texts = [
        "{ truncated",
        "[]",
        '{"stage": "bronze"}',
        '{"stage": "bronze", "ruleset": "s", "total_rows": 3, "results":'
        ' [{"name": "b", "severity": "error", "kind": "row", "passed": false},'
        ' {"name": "a", "severity": "error", "kind": "row", "passed": true}]}',
    ]
    read = from_documents(spark.createDataFrame([(t,) for t in texts], "document string"))
    rows = read.orderBy("position").collect()
    assert [(row["name"], row.position, row.metric) for row in rows] == [("b", 0, None), ("a", 1, None)]
