"""Strict JSON, files, replays, time bounds, sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tablecheck.functions.predicates import json_document_ok
from tablecheck.operators import files as FC
from tablecheck.operators.validate import FusedCheck
from tablecheck.plans.registry import Registry, UnknownTableError
from tablecheck.plans.registry_run import run_registry
from tablecheck.plans.windows import windowed_validation
from tablecheck.operators.report import cumulative_results
from tablecheck.rules import TableRules, in_range, not_null
from tablecheck.sources import files as FS
from tablecheck.sources.sinks import read_results, write_results
from tablecheck.sources.tables import create_table, incremental_slice
from tablecheck.streaming.documents import check_new_documents, stream_required_keys

SHAPES = ['{"k":1}', ' {"k": 1}\n', '{"k":1}]', '{"k":1}]]', '{"k":1}],[{"k":2}', '{"k":1}{"k":2}', '{"k":1} x', '{"k":1},"x":2', '{"k":1}}',
          '{"k":1},"_end":1}', '{"k":1},"x":{"y":1', "[1,2]", "3", '"s"', "null", "", " ", "{'k':1}", '{"k":}', '{"d":1,"_end":1}', '{"k":1', '{"a":{"b":[1,{"c":null}]}}']


def test_json_shapes_agree_with_python(spark):
    def valid(s):
        try:
            json.loads(s)
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(i, s) for i, s in enumerate(SHAPES)], "i int, s string")
    got = {r["i"]: r["ok"] for r in df.select("i", json_document_ok(F.col("s")).alias("ok")).collect()}
    assert got == {i: valid(s) for i, s in enumerate(SHAPES)}


def test_duplicate_keys_follow_the_session(spark):
    df = spark.createDataFrame([('{"k":1,"k":2}',)], "s string")
    assert not df.select(json_document_ok(F.col("s"))).first()[0]


def test_keys_are_read_from_the_document(spark):
    df = spark.createDataFrame([('{"k":null,"a b":1}',), ('{"d":{"k":1}}',), ("[]",)], "s string")
    rows = FC.document_status(df, "s", ["k"]).collect()
    assert [(r["valid_json"], r["missing_keys"], r["is_valid"]) for r in rows] == [
        (True, [], True), (True, ["k"], False), (True, ["k"], False)]
    assert FC.required_keys_check(df, "s", ["a b"], "t").first()["violations"] == 2


def write(folder, name, body):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(body)


def test_manifest_counts_empty_and_odd_names(spark, tmp_path):
    d = str(tmp_path / "m")
    for name, body in (("a b.json", "{}"), ("c+d.json", ""), ("e%20f.json", "x"), ("é.json", ""), ("_h.json", "{}"), (".i.json", "{}")):
        write(d, name, body)
    got = {r["file_name"]: r["file_size"] for r in FS.file_manifest(spark, d).collect()}
    assert got == {"a b.json": 2, "c+d.json": 0, "e%20f.json": 1, "é.json": 0}
    assert FS.hidden_file_count(spark, d) >= 2


def registry(**conf):
    base = {"type": "unstructured", "format": "json", "layout": "document", "incremental": True, "quality_threshold": 0.1,
            "validations": {"file_existence": {"enabled": True}, "metadata_keys": {"required": ["k"]}, "file_size": {"min_bytes": 1}}}
    return Registry({"tables": {"logs": {**base, **conf}}})


@pytest.mark.parametrize("layout", ["document", "lines"])
def test_batch_and_state_run_agree(spark, tmp_path, layout):
    d = str(tmp_path / "logs")
    write(d, "a.json", '{"k":1}')
    write(d, "b.json", "")
    rows = [sorted(tuple(r) for r in run_registry(spark, registry(layout=layout), {"logs": d}, state_dir=s).validation_results.collect())
            for s in (None, str(tmp_path / "state"))]
    assert rows[0] == rows[1] and len(rows[0]) == 3
    assert {r[1]: r[-1] for r in rows[0]} == {"file_existence": True, "file_size": False, "required_keys": layout == "lines"}


def test_empty_folder_fails_existence(spark, tmp_path):
    d = str(tmp_path / "none")
    os.makedirs(d)
    for state in (None, str(tmp_path / "state")):
        got = {r["validation_type"]: r["passed"] for r in run_registry(spark, registry(), {"logs": d}, state_dir=state).validation_results.collect()}
        assert got["file_existence"] is False


def test_replayed_batch_is_reported(spark, tmp_path):
    """A run that died after writing its result and before the commit: the next run reports the batch."""
    d, state = str(tmp_path / "logs"), str(tmp_path / "state")
    write(d, "a.json", '{"k":1}')
    assert check_new_documents(spark, d, {"keys": ["k"]}, "logs", state).first()["total_files"] == 1
    write(d, "b.json", '{"x":1}')
    write(d, "empty.json", "")
    stream_required_keys(spark, d, {"keys": ["k"]}, "logs", results_path=f"{state}/results", checkpoint=f"{state}/checkpoint")
    for name in os.listdir(f"{state}/checkpoint/commits"):
        if name.strip(".").startswith("1"):
            os.remove(f"{state}/checkpoint/commits/{name}")
    r = check_new_documents(spark, d, {"keys": ["k"]}, "logs", state).first()
    assert (r["total_files"], r["violations"]) == (2, 2)
    assert check_new_documents(spark, d, {"keys": ["k"]}, "logs", state).first()["total_files"] == 0


def test_registry_locations_formats_and_switches(spark, tmp_path):
    orc, junk = str(tmp_path / "orc"), str(tmp_path / "junk")
    spark.range(5).write.orc(orc)
    write(junk, "x.parquet", "not a parquet file")

    def table(fmt="parquet", **checks):
        return {"type": "structured", "format": fmt, "schema": {"id": "long", "gone": "string"} if checks else None,
                "validations": {"not_null": {"columns": ["id"]}, **checks}}

    reg = Registry({"tables": {"o": table("orc"), "j": table(), "off": table("orc", schema_check={"enabled": False}), "lost": table()}})
    run = run_registry(spark, reg, {"o": orc, "j": junk, "off": orc})
    gate = {r["table_name"]: (r["is_open"], r["reason"]) for r in run.suite.gate.collect()}
    assert gate["o"] == (True, None) and gate["off"] == (True, None) and gate["lost"] == (False, "no location given")
    assert not gate["j"][0] and gate["j"][1]
    assert {r["table_name"] for r in run.suite.skipped.collect()} == {"j", "lost"}
    assert {r["table_name"]: r["decision"] for r in run.decisions.collect()} == {"o": "continue", "off": "continue", "j": "stop", "lost": "stop"}
    with pytest.raises(UnknownTableError):
        run_registry(spark, reg, {"oo": orc})
    with pytest.raises(UnknownTableError, match="registered: j, lost"):
        reg.get_table_config("nope")


def test_offset_bounds_and_partition_zone(spark, tmp_path):
    p = str(tmp_path / "p")
    df = spark.sql("SELECT timestamp'2024-01-14T16:30:00Z' AS ts, 1 AS v UNION ALL SELECT timestamp'2024-01-14T17:30:00Z', 2")
    df.withColumn("dt", F.to_date("ts")).write.partitionBy("dt").parquet(p)
    t = spark.read.parquet(p)
    bounds = ("2024-01-15T01:00:00+09:00", "2024-01-15T02:00:00+09:00")
    assert [r["v"] for r in incremental_slice(t, "ts", *bounds).collect()] == [1]
    assert [r["v"] for r in incremental_slice(t, "ts", *bounds, partition_column="dt").collect()] == [1]
    z = str(tmp_path / "z")  # dates written in another zone than the session's
    df.withColumn("dt", F.to_date(F.from_utc_timestamp("ts", "Asia/Tokyo"))).write.partitionBy("dt").parquet(z)
    t = spark.read.parquet(z)
    assert [r["v"] for r in incremental_slice(t, "ts", *bounds, partition_column="dt", partition_zone="Asia/Tokyo").collect()] == [1]
    ntz = t.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert [r["v"] for r in incremental_slice(ntz, "ts", *bounds).collect()] == [1]


def test_midnight_end_reads_one_day(spark, tmp_path):
    p = str(tmp_path / "d")
    spark.sql("SELECT timestamp_ntz'2024-01-15 10:00:00' AS ts UNION ALL SELECT timestamp_ntz'2024-01-16 00:00:00'") \
        .withColumn("dt", F.to_date("ts")).write.partitionBy("dt").parquet(p)
    out = incremental_slice(spark.read.parquet(p), "ts", "2024-01-15 00:00:00", "2024-01-16 00:00:00", partition_column="dt")
    assert out.count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-15" in plan.split("PartitionFilters")[1] and out.filter("dt = '2024-01-16'").count() == 0


def test_windows_with_null_timestamps_add_up(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:10:00' AS ts UNION ALL SELECT CAST(NULL AS timestamp)")
    rules = TableRules("t", (not_null("ts"),))
    w = windowed_validation(df, rules, "ts")
    assert {r["window_start"] is None: (r["total_rows"], r["total_violations"]) for r in w.collect()} == {True: (1, 1), False: (1, 0)}
    whole, rolled = FusedCheck(df, rules).validation_results().first(), cumulative_results(w).first()
    assert (whole["total_rows"], whole["total_violations"], whole["passed"]) == (rolled["total_rows"], rolled["total_violations"], rolled["passed"])


def test_typed_bounds(spark):
    df = spark.sql("SELECT '2023-12-31' AS s, date'2024-02-01' AS d, timestamp'2024-01-01 00:00:00' AS t, '7' AS n")
    rules = (in_range("s", min="2024-01-01"), in_range("d", max="2024-01-31"), in_range("t", min="2024-01-01 00:00:01"), in_range("n", max=6))
    assert [r["violations"] for r in FusedCheck(df, TableRules("t", rules)).rule_results().collect()] == [1, 1, 1, 1]


def test_replacing_a_table_by_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "self")
    spark.range(10).write.parquet(path)
    create_table(spark, path, spark.read.parquet(path).filter("id < 4"))
    assert spark.read.parquet(path).count() == 4
    create_table(spark, "self_replaced", spark.range(10), location=str(tmp_path / "cat"))
    create_table(spark, "self_replaced", spark.table("self_replaced").filter("id < 3"), location=str(tmp_path / "cat"))
    assert spark.table("self_replaced").count() == 3
    spark.sql("DROP TABLE self_replaced")


def test_retry_after_midnight_keeps_one_copy(spark, tmp_path, monkeypatch):
    import datetime

    import tablecheck.sources.sinks as S

    class Clock(datetime.datetime):
        now_ = datetime.datetime(2024, 1, 1, 23, 59)

        @classmethod
        def now(cls, tz=None):
            return cls.now_

    monkeypatch.setattr(S._dt, "datetime", Clock)
    target = str(tmp_path / "res")
    res = FusedCheck(spark.range(3), TableRules("t", (not_null("id"),))).validation_results()
    write_results(res, target, "r1")
    Clock.now_ = datetime.datetime(2024, 1, 2, 0, 1)
    write_results(res, target, "r1")
    write_results(res, target, "r2")
    assert read_results(spark, target, "r1").count() == 1 and read_results(spark, target, "r2").count() == 1
    assert {str(r[0]) for r in spark.read.parquet(target).select("run_date").collect()} == {"2024-01-01", "2024-01-02"}
