import pytest
from pyspark.sql import functions as F

from lockgate.functions.expressions import packed_text
from lockgate.operators import rules as r
from lockgate.operators.evaluate import FAILURES, evaluate, measure, split
from lockgate.operators.rulesets import bronze_ruleset, gold_ruleset, silver_ruleset

DDL = "id int, value int, code int"


def by_name(results):
    return {row["name"]: row for row in results.collect()}


def test_rates_and_verdicts(spark):
    df = spark.createDataFrame([(i, i if i < 97 else -1, 1) for i in range(100)], DDL)
    rules = (
        r.non_negative("value", threshold=0.98),
        r.non_negative("value", threshold=0.97, name="lenient"),
        r.not_null("code", severity=r.Severity.WARN),
    )
    got = by_name(evaluate(df, r.RuleSet("s", rules), stage="bronze"))
    strict = got["non_negative[value]"]
    assert (strict.pass_rate, strict.failing_rows, strict.passed) == (0.97, 3, False)
    assert (strict.stage, strict.ruleset, strict.kind) == ("bronze", "s", "row")
    assert got["lenient"].passed and got["not_null[code]"].passed
    assert got["not_null[code]"].severity == "warn"


def test_an_empty_dataset_passes_row_rules_and_fails_the_row_count(spark):
    df = spark.createDataFrame([], DDL)
    ruleset = r.RuleSet("s", (r.not_null("id"),), (r.row_count_at_least(1), r.unique("id")))
    got = by_name(evaluate(df, ruleset))
    assert (got["not_null[id]"].pass_rate, got["not_null[id]"].passed) == (1.0, True)
    assert (got["row_count_at_least"].metric, got["row_count_at_least"].passed) == (0.0, False)
    assert got["unique[id]"].passed


def test_duplicates_count_surplus_copies_and_skip_nulls(spark):
    df = spark.createDataFrame([(1, 0, 0), (1, 0, 0), (1, 0, 0), (2, 0, 0), (None, 0, 0), (None, 0, 0)], DDL)
    got = by_name(evaluate(df, r.RuleSet("s", (), (r.unique("id"),))))
    assert (got["unique[id]"].metric, got["unique[id]"].passed) == (2.0, False)


def test_several_distinct_metrics_share_one_report(spark):
    df = spark.createDataFrame([(1, 5, 7), (2, 5, 7), (3, 6, 7)], DDL)
    ruleset = r.RuleSet("s", (r.not_null("id"),), (r.unique("id"), r.unique("value"), r.unique("code")))
    got = by_name(evaluate(df, ruleset))
    assert [got[f"unique[{c}]"].metric for c in ("id", "value", "code")] == [0.0, 1.0, 2.0]
    assert {row.total_rows for row in got.values()} == {3}


def test_a_null_predicate_is_a_violation(spark):
    df = spark.createDataFrame([(1, None, 0), (2, 1, 0)], DDL)
    rule = r.satisfies("positive", F.col("value") > 0, "text")
    assert by_name(evaluate(df, r.RuleSet("s", (rule,))))["positive"].failing_rows == 1
    clean, rejected = split(df, [rule])
    assert [row.id for row in clean.collect()] == [2]
    assert [row.id for row in rejected.collect()] == [1]


def test_rejected_rows_name_every_broken_rule_in_order(spark):
    df = spark.createDataFrame([(1, -1, None), (2, 5, 9), (3, 5, 1)], DDL)
    rules = [r.not_null("code"), r.non_negative("value"), r.accepted_values("code", [1])]
    clean, rejected = split(df, rules)
    assert [row.id for row in clean.collect()] == [3]
    reasons = {row.id: row[FAILURES] for row in rejected.collect()}
    assert reasons == {
        1: ["not_null[code]", "non_negative[value]", "accepted_values[code]"],
        2: ["accepted_values[code]"],
    }


def test_no_rules_reject_nothing_and_keep_the_type(spark):
    df = spark.createDataFrame([(1, 1, 1)], DDL)
    clean, rejected = split(df, [])
    assert clean.count() == 1 and rejected.count() == 0
    assert dict(rejected.dtypes)[FAILURES] == "array<string>"


def test_clean_rows_agrees_with_the_split(spark):
    df = spark.createDataFrame([(i, i % 7 - 1, i % 3 or None) for i in range(60)], DDL)
    ruleset = r.RuleSet("s", (r.non_negative("value"), r.not_null("code", quarantine=False)))
    clean, rejected = split(df, ruleset.quarantine_rules())
    measured = measure(df, ruleset).first()
    assert measured.clean_rows == clean.count()
    assert measured.total_rows - measured.clean_rows == rejected.count()


def test_one_report_per_group(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, -1, 1), (2, 1, 1), (2, 1, 1)], DDL)
    ruleset = r.RuleSet("s", (r.non_negative("value"),), (r.unique("value"),))
    got = {(row.id, row["name"]): row for row in evaluate(df, ruleset, by=["id"]).collect()}
    assert got[1, "non_negative[value]"].pass_rate == 0.5
    assert got[2, "unique[value]"].metric == 1.0


@pytest.mark.parametrize("n", [1, 12, 40])
def test_the_data_is_read_once_however_many_rules(spark, n):
    df = spark.range(50).withColumn("value", F.col("id"))
    rules = tuple(r.in_range("value", 0, i + 1, name=f"rule_{i}") for i in range(n))
    plan = evaluate(df, r.RuleSet("s", rules, (r.row_count_at_least(1),)))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Range (") == 1


def test_clean_rows_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1, 1)], DDL).write.parquet(path)
    clean, _ = split(spark.read.parquet(path), [r.non_negative("value")])
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(value,0)" in plan


def test_the_shipped_rule_sets(spark):
    bronze, silver, gold = bronze_ruleset(), silver_ruleset(), gold_ruleset()
    assert [len(s) for s in (bronze, silver, gold)] == [14, 9, 7]
    policies = {rule.name: rule for rule in bronze.row_rules}
    assert not policies["not_null[passenger_count]"].quarantine
    # A warning may still divert rows.
    assert policies["accepted_values[rate_code_id]"].severity == "warn"
    assert policies["accepted_values[rate_code_id]"].quarantine


def test_texts_are_counted_as_different_bytes(spark):
    texts = ["ab" * 32, "AB" * 32, "", "a", "ab", "\x01ab", "zz", "ü", None, None, "ab"]
    df = spark.createDataFrame([(x,) for x in texts], "id string")
    codes = [row[0] for row in df.select(packed_text("id")).collect()]
    assert len(codes[0]) == 33 and codes.count(None) == 2
    assert len(set(codes)) == len(set(texts))
    rules = r.RuleSet("r", (), (r.unique("id"), r.unique("n")))
    report = evaluate(df.withColumn("n", F.lit(1)), rules).orderBy("position").collect()
    assert [row.metric for row in report] == [1.0, 10.0]
    plan = evaluate(df, r.RuleSet("r", (), (r.unique("id"),)))._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan
