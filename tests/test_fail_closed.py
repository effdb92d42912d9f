"""Errors fail verdicts; the number of rules changes nothing."""

import os

import pytest
from pyspark.sql import functions as F

from tablecheck.operators.gate import TableSpec, stop_decision
from tablecheck.operators.validate import FusedCheck, rollup_rule_results
from tablecheck.plans.run import run_suite
from tablecheck.rules import TableRules, expression, in_range, not_null
from tablecheck.streaming import hourly as ST


def damaged(path):
    """Overwrite the data pages, keep the footer: the schema reads, the rows do not."""
    import glob

    name = glob.glob(f"{path}/*.parquet")[0]
    os.remove(os.path.join(path, f".{os.path.basename(name)}.crc"))  # else the footer fails its checksum and the gate closes
    with open(name, "r+b") as f:
        end = f.seek(-8, 2)
        footer = int.from_bytes(f.read(4), "little")
        f.seek(4)
        f.write(b"\xff" * (end - footer - 4))


def test_damaged_file_fails_and_stops(spark, tmp_path):
    bad, good = str(tmp_path / "bad"), str(tmp_path / "good")
    for p in (bad, good):
        spark.range(5000).select("id", (F.col("id") * 2).alias("v")).coalesce(1).write.parquet(p)
    damaged(bad)
    rules = (not_null("v"), in_range("v", 0, 10**6), expression("positive", "v >= 0"))
    for on_error in ("fail", "ignore"):
        run = run_suite(spark, [(TableSpec("bad", bad), TableRules("bad", rules)), (TableSpec("good", good), TableRules("good", rules))],
                        on_error=on_error, isolate_tables=True)
        got = {(r["table_name"], r["validation_type"]): (r["passed"], r["violation_percentage"]) for r in run.validation_results.collect()}
        assert all(got[("bad", f)] == (False, None) for f in ("not_null", "range", "cross_column"))
        assert all(got[("good", f)][0] for f in ("not_null", "range", "cross_column"))
        policies = spark.createDataFrame([("bad", True, True), ("good", True, True)],
                                         "table_name string, metadata_stop_on_failure boolean, data_stop_on_threshold boolean")
        decided = {r["table_name"]: r["decision"] for r in stop_decision(run.validation_results, run.gate, policies).collect()}
        assert decided == {"bad": "stop", "good": "continue"}


def test_on_error_is_honoured_under_isolation(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("name", F.lit("x")).write.parquet(path)
    rules = (expression("missing", "no_such_column > 1"), not_null("id"))

    def verdicts(on_error):
        run = run_suite(spark, [(TableSpec("t", path), TableRules("t", rules))], on_error=on_error, isolate_tables=True)
        return ({r["validation_type"]: r["passed"] for r in run.validation_results.collect()},
                {r["validation_type"]: r["passed"] for r in rollup_rule_results(run.rule_results, 0.1, on_error).collect()})

    assert verdicts("fail") == ({"cross_column": False, "not_null": True},) * 2
    assert verdicts("ignore") == ({"cross_column": True, "not_null": True},) * 2


def test_only_cross_column_errors_are_tolerated(spark):
    df = spark.createDataFrame([(1, True)], "a int, b boolean")
    check = FusedCheck(df, TableRules("t", (in_range("b", 0, 1), expression("e", "nope > 0"))), "ignore")
    assert {r["validation_type"]: r["passed"] for r in check.validation_results().collect()} == {"range": False, "cross_column": True}


def wide(n):
    return TableRules("t", tuple(in_range("v", max=float(k)) for k in range(n)))


@pytest.mark.parametrize("n", [48, 49, 500])
def test_counts_and_verdicts_for_any_number_of_rules(spark, n):
    df = spark.range(100).withColumn("v", F.col("id").cast("double"))
    check = FusedCheck(df, wide(n))
    row = check.counts.first()
    assert row["total_rows"] == 100 and [row[f"_v{k}"] for k in range(n)] == [max(0, 99 - k) for k in range(n)]
    r = check.validation_results().first()
    assert (r["rules_configured"], r["total_violations"]) == (n, sum(max(0, 99 - k) for k in range(n)))
    grouped = FusedCheck(df, wide(n), group_by=[F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g")]).counts.collect()
    assert {x["g"]: x["total_rows"] for x in grouped} == {None: 34, 1: 33, 2: 33}
    assert sum(x[f"_v{n - 1}"] for x in grouped) == max(0, 100 - n)


@pytest.mark.parametrize("mode", ["complete", "update", "append"])
@pytest.mark.parametrize("n", [48, 49])
def test_stream_modes_for_any_number_of_rules(spark, tmp_path, mode, n):
    path = str(tmp_path / "s")
    df = spark.range(300).select((F.col("id") % 100).cast("double").alias("v"),
                                 (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("ts"))
    for k in range(3):  # one file after the other, in time order
        df.filter(F.floor((F.unix_timestamp("ts") - F.unix_timestamp(F.lit("2024-01-01 00:00:00"))) / 6000) == k) \
            .coalesce(1).write.mode("append").parquet(path)
    out = ST.stream_windowed_validation(spark, path, df.schema, wide(n), "ts", output_mode=mode, watermark="0 seconds",
                                        max_files_per_trigger=1)
    if mode == "append":
        out = ST.with_open_windows(out, spark.read.parquet(path), wide(n), "ts")
    rows = out.collect()
    assert sorted(r["total_rows"] for r in rows) == [60] * 5
    assert sum(r["total_violations"] for r in rows) == 3 * sum(99 - k for k in range(n))
