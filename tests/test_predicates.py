"""Null, NaN, regex and empty-input semantics on hand-made frames."""

import pytest
from pyspark.sql import functions as F

from tablecheck import TableRules, Validator, expression, in_range, matches, not_null
from tablecheck.operators.validate import FusedCheck, RuleError


def _count(df, rule):
    return FusedCheck(df, TableRules("t", (rule,))).rule_results().first()["violations"]


def test_null_never_violates_range_regex_expression(spark):
    df = spark.createDataFrame([(5,), (50,), (500,), (None,)], "x int")
    assert _count(df, in_range("x", 0, 100)) == 1
    assert _count(df, matches("x", "^[0-9]$")) == 2
    assert _count(df, expression("e", "x < 100")) == 1
    assert _count(df, not_null("x")) == 1


def test_nan_exceeds_any_max(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    res = FusedCheck(df, TableRules("t", (in_range("x", 0, 100),))).rule_results().first()
    assert res["violations"] == 1


def test_regex_find_semantics(spark):
    vals = ["TXN0000000001", "TXN0000000001\n", "xTXN0000000001", None, ""]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    res = FusedCheck(df, TableRules("t", (matches("x", r"^TXN[0-9]{10}$"),))).rule_results().first()
    # Java '$' matches before a final newline; '' is tested; NULL passes
    assert res["violations"] == 2


def test_empty_input_passes(spark):
    df = spark.createDataFrame([], "x int")
    v = Validator().validate_range(df, {"x": {"min": 0, "max": 1}}, "t").first()
    assert v["total_rows"] == 0 and v["violation_percentage"] == 0.0 and v["passed"] is True


def test_missing_column_skipped_but_in_denominator(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    tr = TableRules("t", (not_null("x"), not_null("nope")))
    chk = FusedCheck(df, tr)
    rows = {r["rule_name"]: r for r in chk.rule_results().collect()}
    assert rows["nope"]["status"] == "column_missing" and rows["nope"]["violations"] == 0
    v = chk.validation_results().first()
    assert v["rules_configured"] == 2 and v["violation_percentage"] == pytest.approx(1 / 4)


def test_threshold_inclusive(spark):
    one = spark.createDataFrame([(None,)] + [(1,)] * 9, "x int")
    two = spark.createDataFrame([(None,)] * 2 + [(1,)] * 8, "x int")
    assert Validator(0.10).validate_not_null(one, ["x"], "t").first()["passed"] is True
    assert Validator(0.10).validate_not_null(two, ["x"], "t").first()["passed"] is False


def test_bad_rules_isolated_or_raised(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    tr = TableRules("t", (expression("ok", "x < 2"), expression("bad", "no_such_column > 0"),
                          expression("nb", "x + 1")))
    rows = {r["rule_name"]: r for r in FusedCheck(df, tr, "ignore").rule_results().collect()}
    assert rows["ok"]["violations"] == 1
    assert rows["bad"]["status"] == "error" and rows["bad"]["error"].startswith("UNRESOLVED_COLUMN")
    assert rows["nb"]["error"] == "NOT_BOOLEAN:int"
    with pytest.raises(RuleError):
        FusedCheck(df, tr, "fail")


def test_string_range_column_does_not_raise_under_ansi(spark):
    df = spark.createDataFrame([("abc",), ("5",), ("-1",)], "x string")
    res = FusedCheck(df, TableRules("t", (in_range("x", 0.01, 10),))).rule_results().first()
    assert res["violations"] == 1


def test_one_sided_and_no_bounds(spark):
    df = spark.createDataFrame([(-1,), (5,), (50,)], "x int")
    r = FusedCheck(df, TableRules("t", (in_range("x", min=0),))).rule_results().first()
    assert r["violations"] == 1
    r = FusedCheck(df, TableRules("t", (in_range("x", max=10),))).rule_results().first()
    assert r["violations"] == 1
    r = FusedCheck(df, TableRules("t", (in_range("x"),))).rule_results().first()
    assert r["status"] == "no_predicate" and r["violations"] == 0


def test_interval_is_half_open(spark):
    from tablecheck.sources.tables import incremental_slice
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-01 11:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("ts"))
    assert incremental_slice(df, "ts", "2024-01-01 10:00:00", "2024-01-01 11:00:00").count() == 1
    df2 = df.select(F.col("ts").cast("timestamp").alias("ts"))
    assert incremental_slice(df2, "ts", "2024-01-01 10:00:00", "2024-01-01 11:00:00").count() == 1


def test_runtime_error_isolated_with_ignore(spark):
    from pyspark.errors import PySparkException
    df = spark.createDataFrame([(0, 5.0), (1, 500.0)], "id int, v double")
    tr = TableRules("t", (expression("boom", "CASE WHEN id = 0 THEN raise_error('x') ELSE true END"),
                          in_range("v", 0, 100)))
    rows = {r["rule_name"]: r for r in FusedCheck(df, tr, "ignore").materialize().rule_results().collect()}
    assert rows["boom"]["status"] == "error" and rows["boom"]["error"] == "USER_RAISED_EXCEPTION"
    assert rows["v"]["violations"] == 1 and rows["v"]["total_rows"] == 2
    with pytest.raises(PySparkException):
        FusedCheck(df, tr, "fail").materialize()


def test_validator_family_methods(spark):
    df = spark.createDataFrame([("TXN0000000001", 5.0), (None, -1.0)], "id string, amount double")
    v = Validator(0.10)
    assert v.validate_not_null(df, ["id", "missing"], "t").first()["total_violations"] == 1
    r = v.validate_range(df, {"amount": {"min": 0.01}}, "t").first()
    assert r["total_violations"] == 1 and r["violation_percentage"] == 0.5 and r["passed"] is False
    assert v.validate_regex(df, {"id": r"^TXN[0-9]{10}$"}, "t").first()["total_violations"] == 0
    c = v.validate_cross_column(df, [{"name": "pos", "expression": "amount > 0"}, {"name": "empty"}], "t").first()
    assert c["rules_configured"] == 2 and c["total_violations"] == 1


def test_default_interval():
    import datetime as dt
    from tablecheck.sources.tables import default_interval
    assert default_interval({"DATA_INTERVAL_START": "a", "DATA_INTERVAL_END": "b"}) == ("a", "b")
    s, e = default_interval({"DATA_INTERVAL_START": "a"}, now=dt.datetime(2024, 1, 1, 12, 0, 0))
    assert (s, e) == ("2024-01-01 11:00:00", "2024-01-01 12:00:00")


def test_range_on_non_numeric_column_is_a_rule_error(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 5.0)], "t string, v double") \
        .selectExpr("cast(t as timestamp_ntz) AS ts", "v")
    tr = TableRules("t", (in_range("ts", 0, 1), in_range("v", 0, 1)))
    rows = {r["rule_name"]: r for r in FusedCheck(df, tr, "ignore").rule_results().collect()}
    assert rows["ts"]["status"] == "error" and rows["ts"]["error"] == "NOT_NUMERIC:timestamp_ntz"
    assert rows["v"]["violations"] == 1
    with pytest.raises(RuleError):
        FusedCheck(df, tr, "fail")


def test_invalid_regex_is_a_rule_error(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    tr = TableRules("t", (matches("s", "["), matches("s", "^a$")))
    rows = {r["rule_name"] + str(i): r for i, r in enumerate(FusedCheck(df, tr, "ignore").rule_results().collect())}
    statuses = sorted((r["status"], r["error"]) for r in rows.values())
    assert statuses == [("error", "INVALID_PARAMETER_VALUE.PATTERN"), ("violated", None)]
    with pytest.raises(RuleError):
        FusedCheck(df, tr, "fail")


def test_aggregate_and_window_expressions_are_rule_errors(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    tr = TableRules("t", (expression("agg", "sum(x) > 0"), expression("ok", "x < 2"), in_range("x", 0, 1)))
    rows = {r["rule_name"]: r for r in FusedCheck(df, tr, "ignore").rule_results().collect()}
    assert rows["agg"]["status"] == "error" and rows["agg"]["error"] == "NESTED_AGGREGATE_FUNCTION"
    assert rows["ok"]["violations"] == 1 and rows["x"]["violations"] == 1
    with pytest.raises(RuleError):
        FusedCheck(df, tr, "fail")


def test_validate_all_families_in_one_scan(spark):
    df = spark.createDataFrame([("TXN0000000001", 5.0, "PENDING"), (None, -1.0, "UNKNOWN")],
                               "id string, amount double, status string")
    block = {"not_null": ["id"], "range": {"amount": {"min": 0.01}},
             "regex": {"status": "^(COMPLETED|PENDING)$"},
             "cross_column": [{"name": "pos", "expression": "amount > 0"}]}
    out = Validator(0.10).validate_all(df, block, "t")
    got = {r["validation_type"]: r["total_violations"] for r in out.collect()}
    assert got == {"not_null": 1, "range": 1, "regex": 1, "cross_column": 1}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan ExistingRDD") == 1  # one scan for all four families
