"""Schema comparison (loose/exact), existence, row counts and the gate."""

import pytest
from pyspark.sql import types as T

from tablecheck import TableRules, in_range
from tablecheck.operators import schema as S
from tablecheck.operators.gate import TableSpec
from tablecheck.plans.run import run_suite

from conftest import SF_SMALL


@pytest.mark.parametrize("expected,actual,ok", [
    ("date", T.TimestampType(), True),
    ("timestamp", T.DateType(), True),
    ("timestamp", T.TimestampNTZType(), True),
    ("decimal(10,2)", T.DecimalType(12, 4), True),
    ("string", T.ArrayType(T.StringType()), True),
    ("integer", T.LongType(), False),
    ("bigint", T.LongType(), False),
    ("decimal(10,2)", T.DoubleType(), False),
    ("long", T.LongType(), True),
])
def test_loose_type_pairs(spark, expected, actual, ok):
    schema = T.StructType([T.StructField("c", actual)])
    actual_df = S.schema_frame(spark, "t", schema)
    d = S.schema_differences(actual_df, S.expected_frame(spark, "t", {"c": expected}))
    assert (d.count() == 0) == ok


def test_exact_mode(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DecimalType(12, 4))])
    a = S.schema_frame(spark, "t", schema)
    d = S.schema_differences(a, S.expected_frame(spark, "t", {"a": "bigint", "b": "decimal(10,2)"}), mode="exact")
    assert [r["column_name"] for r in d.collect()] == ["b"]


def test_missing_extra_strict(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("x", T.LongType())])
    a = S.schema_frame(spark, "t", schema)
    e = S.expected_frame(spark, "t", ["a", "b"])
    kinds = sorted((r["kind"], r["column_name"]) for r in S.schema_differences(a, e).collect())
    assert kinds == [("extra", "x"), ("missing", "b")]
    assert [r["kind"] for r in S.schema_differences(a, e, strict=False).collect()] == ["missing"]


def test_exists_and_counts(spark):
    from tablecheck.sources.tables import table_exists
    assert table_exists(spark, f"{SF_SMALL}/lineitem.parquet")
    assert not table_exists(spark, f"{SF_SMALL}/nope.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    r = S.row_count(li, "lineitem", "no_such > 1").first()
    assert r["row_count"] is None and r["error"].startswith("UNRESOLVED_COLUMN")
    assert S.not_empty(li.limit(0), "e").first()["not_empty"] is False


def test_gate_skips_closed_tables_without_scanning(spark):
    good = TableSpec("lineitem", f"{SF_SMALL}/lineitem.parquet")
    bad = TableSpec("orders", f"{SF_SMALL}/orders.parquet", ["o_orderkey", "o_comment"], strict=False)
    gone = TableSpec("gone", f"{SF_SMALL}/gone.parquet")
    rules = TableRules("x", (in_range("l_quantity", 1, 45),))
    run = run_suite(spark, [(good, TableRules("lineitem", rules.rules)),
                            (bad, TableRules("orders", (in_range("o_totalprice", 0, 1),))),
                            (gone, TableRules("gone", (in_range("x", 0, 1),)))])
    gate = {r["table_name"]: r for r in run.gate.collect()}
    assert gate["lineitem"]["is_open"] and not gate["orders"]["is_open"] and not gate["gone"]["is_open"]
    assert gate["orders"]["reason"] == "schema: missing o_comment"
    skipped = {r["table_name"] for r in run.skipped.collect()}
    assert skipped == {"orders", "gone"}
    plan = run.validation_results._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "lineitem.parquet" in plan


def test_gate_from_check_rows_and_stop_policy(spark):
    from tablecheck.operators.gate import gate_from_checks, stop_decision
    checks = spark.createDataFrame([("a", "exists", True), ("a", "schema", True), ("b", "exists", True),
                                    ("b", "schema", False), ("c", "exists", None)],
                                   "table_name string, check_name string, passed boolean")
    g = {r["table_name"]: r for r in gate_from_checks(checks).collect()}
    assert g["a"]["is_open"] and not g["b"]["is_open"] and g["b"]["failed_checks"] == ["schema"]
    assert not g["c"]["is_open"]
    val = spark.createDataFrame([("a", False)], "table_name string, passed boolean")
    pol = spark.createDataFrame([("a", True, False), ("b", True, True), ("d", False, True)],
                                "table_name string, metadata_stop_on_failure boolean, data_stop_on_threshold boolean")
    d = {r["table_name"]: r["decision"] for r in stop_decision(val, gate_from_checks(checks), pol).collect()}
    assert d == {"a": "warn", "b": "stop", "d": "warn"}


def test_incremental_read_by_path(spark):
    from tablecheck.sources.tables import get_incremental_data
    df = get_incremental_data(spark, f"{SF_SMALL}/events.parquet", "ts", "2024-01-01 00:00:00",
                              "2024-01-02 00:00:00", ["event_id"])
    assert df.columns == ["event_id"] and df.count() > 0


def test_require_rows_closes_gate_on_empty_table(spark, tmp_path):
    from tablecheck.operators.gate import evaluate_gates
    empty = str(tmp_path / "empty")
    spark.read.parquet(f"{SF_SMALL}/region.parquet").limit(0).write.parquet(empty)
    states, frames = evaluate_gates(spark, [TableSpec("e", empty, require_rows=True),
                                            TableSpec("r", f"{SF_SMALL}/region.parquet", require_rows=True)])
    by = {s.table_name: s for s in states}
    assert by["e"].reason == "table is empty" and not by["e"].is_open
    assert by["r"].is_open and set(frames) == {"r"}


def test_isolated_tables_survive_a_failing_table(spark):
    from tablecheck import expression
    li = TableSpec("lineitem", f"{SF_SMALL}/lineitem.parquet")
    ev = TableSpec("events", f"{SF_SMALL}/events.parquet")
    boom = TableRules("events", (expression("boom", "CASE WHEN event_id = 0 THEN raise_error('x') ELSE true END"),
                                 in_range("value", 1, 200)))
    run = run_suite(spark, [(li, TableRules("lineitem", (in_range("l_quantity", 1, 45),))), (ev, boom)],
                    isolate_tables=True)
    rows = {(r["table_name"], r["rule_name"]): r for r in run.rule_results.collect()}
    assert rows[("events", "boom")]["status"] == "error"
    assert rows[("events", "value")]["status"] in ("ok", "violated")
    assert rows[("lineitem", "l_quantity")]["total_rows"] > 0


def test_schema_check_on_missing_source_reports_error(spark):
    d = S.schema_check(spark, f"{SF_SMALL}/nope.parquet", "nope", ["a"]).collect()
    assert len(d) == 1 and d[0]["kind"] == "error" and d[0]["actual_type"].startswith("PATH_NOT_FOUND")


def test_catalog_names_and_temp_views(spark, tmp_path):
    from tablecheck.sources.tables import append_table, create_table, read_table, table_exists
    spark.read.parquet(f"{SF_SMALL}/region.parquet").createOrReplaceTempView("tc_region")
    assert table_exists(spark, "tc_region") and not table_exists(spark, "tc_no_such_view")
    assert read_table(spark, "tc_region", ["r_name"]).columns == ["r_name"]
    name = "tc_ns.regions"
    create_table(spark, name, spark.table("tc_region"), namespace_location=str(tmp_path / "ns"),
                 location=str(tmp_path / "t"))
    append_table(spark, name, spark.table("tc_region"))
    assert spark.table(name).count() == 2 * spark.table("tc_region").count()
    with pytest.raises(ValueError):
        append_table(spark, "tc_ns.missing", spark.table("tc_region"))
