"""Reports, the generator's fault model, the registry and streaming = batch."""

import pytest
from pyspark.sql import functions as F

from tablecheck.operators import report as R
from tablecheck.operators.validate import FusedCheck
from tablecheck.plans.registry import EXAMPLE_REGISTRY, Registry
from tablecheck.sources import synth as SY

from conftest import SF_SMALL

VAL_DDL = ("table_name string, validation_type string, total_rows bigint, rules_configured int, "
           "total_violations bigint, violation_percentage double, threshold double, passed boolean")


def _results(spark):
    return spark.createDataFrame([
        ("a", "range", 10, 1, 0, 0.0, 0.1, True),
        ("a", "regex", 10, 2, 5, 0.25, 0.1, False),
        ("b", None, 0, 1, 0, 0.0, 0.1, None),
    ], VAL_DDL)


def test_rollups(spark):
    r = R.results_rollup(_results(spark)).first()
    assert (r["total_validations"], r["passed"], r["failed"], r["overall_passed"]) == (3, 1, 2, False)
    s = R.summary_overall(_results(spark)).first()
    assert s["tables_validated"] == "a,b" and s["total_violations"] == 5
    t = {x["validation_type"]: x for x in R.summary_by_type(_results(spark)).collect()}
    assert t["unknown"]["failed"] == 1
    v = {x["validation_type"]: x for x in R.validation_summary(_results(spark)).collect()}
    assert v["regex"]["violations_per_row_pct"] == pytest.approx(50.0) and v["regex"]["severity"] == "critical"
    msgs = R.alert_messages(_results(spark)).collect()
    assert any("10.00% are allowed" in m["message"] for m in msgs)


def test_trend(spark):
    h = spark.createDataFrame([
        ("2024-01-01 00:00:00", "a", "range", 10, 1, 0.1, True),
        ("2024-01-02 00:00:00", "a", "range", 10, 3, 0.3, False),
        ("2023-01-01 00:00:00", "a", "range", 10, 0, 0.0, True),
    ], "run_ts string, table_name string, validation_type string, total_rows bigint, total_violations bigint, "
       "violation_percentage double, passed boolean").withColumn("run_ts", F.col("run_ts").cast("timestamp"))
    rows = R.results_trend(h, retention_days=30).orderBy("run_ts").collect()
    assert len(rows) == 2 and rows[1]["change"] == pytest.approx(0.2) and rows[0]["previous_percentage"] is None


def test_generator_faults_match_violations(spark):
    reg = Registry(EXAMPLE_REGISTRY)
    # relative to the current time, as the registry rule compares with current_timestamp()
    txn = SY.generate_transactions(spark, 20000, with_fault_kind=True)
    kinds = {r["fault_kind"]: r["count"] for r in txn.groupBy("fault_kind").count().collect()}
    rules = {(r["validation_type"], r["rule_name"]): r["violations"]
             for r in FusedCheck(txn.drop("fault_kind"), reg.table_rules("transactions")).rule_results().collect()}
    assert rules[("not_null", "user_id")] == kinds["null"]
    assert rules[("range", "amount")] == kinds["range"]
    assert rules[("regex", "transaction_id")] == kinds["regex_id"]
    assert rules[("regex", "status")] == kinds["regex_status"]
    assert rules[("cross_column", "timestamp_validity")] == kinds["future"]
    faulty = sum(v for k, v in kinds.items() if k is not None)
    assert 0.04 < faulty / 20000 < 0.06


def test_generator_is_partitioning_invariant(spark):
    a = SY.generate_users(spark, ids=spark.range(5000).repartition(2), as_of="2024-02-01 00:00:00")
    b = SY.generate_users(spark, ids=spark.range(5000).repartition(9), as_of="2024-02-01 00:00:00")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_seed_initial_then_append(spark, tmp_path):
    from tablecheck.sources.files import scan_json_files
    root = str(tmp_path / "wh")
    p = SY.seed_tables(spark, root, "initial", as_of="2024-02-01 00:00:00")
    SY.seed_tables(spark, root, "append", batch=1, as_of="2024-02-01 01:00:00")
    assert spark.read.parquet(p["transactions"]).count() == 1100
    assert spark.read.parquet(p["user_profiles"]).count() == 550
    assert scan_json_files(spark, p["event_logs"]).count() == 110


def test_registry_views(spark):
    reg = Registry(EXAMPLE_REGISTRY)
    assert set(reg.get_structured_tables()) == {"transactions", "user_profiles"}
    with pytest.raises(ValueError):
        reg.get_table_config("nope")
    rules = reg.rules_df(spark)
    assert rules.filter("table_name = 'transactions'").count() == 8
    assert reg.tables_by_type(spark, "unstructured").count() == 2
    tr = reg.table_rules("event_logs")
    assert tr.data_stop_on_threshold is False


def test_stream_equals_batch(spark):
    from tablecheck.plans.testdata_checks import EVENTS
    from tablecheck.plans.windows import windowed_validation
    from tablecheck.streaming.hourly import stream_windowed_validation
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    batch = windowed_validation(ev, EVENTS.table_rules(), "ts")
    stream = stream_windowed_validation(spark, SF_SMALL, ev.schema, EVENTS.table_rules(), "ts",
                                        glob="events.parquet")
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_stream_batches_sum_to_batch_and_replay_is_idempotent(spark, tmp_path):
    from tablecheck.plans.testdata_checks import EVENTS
    from tablecheck.streaming.hourly import stream_batch_suite
    src = str(tmp_path / "events_src")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.repartition(4).write.parquet(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    res = stream_batch_suite(spark, src, ev.schema, EVENTS.table_rules(), results_path=out, checkpoint=ckpt,
                             max_files_per_trigger=1)
    batches = {r["batch_id"] for r in res.collect()}
    assert len(batches) == 4
    per_family = {r["validation_type"]: r["n"] for r in
                  res.groupBy("validation_type").agg(F.sum("total_rows").alias("n")).collect()}
    assert set(per_family.values()) == {ev.count()}
    again = stream_batch_suite(spark, src, ev.schema, EVENTS.table_rules(), results_path=out, checkpoint=ckpt,
                               max_files_per_trigger=1)
    assert again.count() == res.count()


def test_append_windows_are_a_subset_of_complete(spark):
    from tablecheck.plans.testdata_checks import EVENTS
    from tablecheck.streaming.hourly import stream_windowed_validation
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    complete = stream_windowed_validation(spark, SF_SMALL, ev.schema, EVENTS.table_rules(), "ts",
                                          glob="events.parquet", output_mode="complete")
    append = stream_windowed_validation(spark, SF_SMALL, ev.schema, EVENTS.table_rules(), "ts",
                                        glob="events.parquet", output_mode="append")
    assert append.exceptAll(complete).count() == 0 and 0 < append.count() <= complete.count()


def test_validation_details_map(spark):
    rr = spark.createDataFrame([("t", "regex", "a", 10, 0), ("t", "regex", "b", 10, 3), ("t", "regex", "b", 10, 1)],
                               "table_name string, validation_type string, rule_name string, total_rows bigint, "
                               "violations bigint")
    d = R.validation_details(rr).first()
    assert d["rules_validated"] == ["a", "b"] and d["violations"] == {"b": 4}


def test_results_sink_partitions_and_trend_pruning(spark, tmp_path):
    from tablecheck.sources.sinks import read_results, write_results
    path = str(tmp_path / "results")
    res = _results(spark)
    for run_id, ts in (("h1", "2024-01-01 10:00:00"), ("h2", "2024-03-01 10:00:00"), ("h3", "2024-03-02 10:00:00")):
        write_results(res, path, run_id, run_ts=ts)
    write_results(res, path, "h3", run_ts="2024-03-02 10:00:00")  # a retry replaces its partition
    hist = read_results(spark, path)
    assert hist.count() == 9
    trend = R.results_trend(hist, "run_ts", retention_days=10)
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan
    assert {r["run_ts"].strftime("%m-%d") for r in trend.collect()} == {"03-01", "03-02"}


def test_update_mode_keeps_the_latest_window_versions(spark, tmp_path):
    from tablecheck.plans.testdata_checks import EVENTS
    from tablecheck.plans.windows import windowed_validation
    from tablecheck.streaming.hourly import stream_windowed_validation
    src = str(tmp_path / "ev")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.repartition(3).write.parquet(src)
    upd = stream_windowed_validation(spark, src, ev.schema, EVENTS.table_rules(), "ts", output_mode="update",
                                     output_path=str(tmp_path / "o"), checkpoint=str(tmp_path / "c"))
    batch = windowed_validation(ev, EVENTS.table_rules(), "ts")
    assert upd.exceptAll(batch).count() == 0 and batch.exceptAll(upd).count() == 0
