"""The example registry end to end on seeded data (initial + append)."""

from pyspark.sql import functions as F

from tablecheck.operators import report as R
from tablecheck.plans.registry import EXAMPLE_REGISTRY, Registry
from tablecheck.plans.registry_run import annotate_results, run_registry
from tablecheck.sources import synth as SY


def test_example_registry_on_seeded_data(spark, tmp_path):
    root = str(tmp_path / "wh")
    paths = SY.seed_tables(spark, root, "initial")
    SY.seed_tables(spark, root, "append", batch=1)
    images = spark.createDataFrame(
        [("a.pdf", 2048), ("b.gif", 10)], "file_path string, file_size bigint")
    (tmp_path / "a.pdf").write_text("x")
    locations = {**paths, "receipt_scans": str(tmp_path)}
    reg = Registry(EXAMPLE_REGISTRY)
    run = run_registry(spark, reg, locations, metadata_frames={"receipt_scans": images})
    res = {(r["table_name"], r["validation_type"]): r for r in run.validation_results.collect()}
    # the seeded tables are inferred as double/bigint, which loose matching rejects for
    # decimal(10,2)/integer: the gate closes and their rules are skipped
    gate = {r["table_name"]: r for r in run.suite.gate.collect()}
    assert not gate["transactions"]["is_open"] and "type_mismatch amount" in gate["transactions"]["reason"]
    assert run.suite.skipped.filter("table_name = 'transactions'").count() == 8
    logs = res[("event_logs", "required_keys")]
    assert logs["total_rows"] == 110 and 0 < logs["total_violations"] < 20 and logs["passed"]
    assert res[("event_logs", "file_size")]["total_violations"] == 0
    assert res[("receipt_scans", "file_extension")]["total_violations"] == 1
    assert res[("receipt_scans", "file_size")]["total_violations"] == 1
    assert res[("receipt_scans", "metadata_keys")]["total_violations"] == 0
    ann = annotate_results(run.validation_results, reg.tables_df(spark), {"env": "ci"}).first()
    assert ann["tags"] == {"env": "ci"} and ann["namespace"].startswith("shop.")
    assert R.results_rollup(run.validation_results).first()["total_validations"] == 7


def test_example_registry_with_name_only_schema(spark, tmp_path):
    root = str(tmp_path / "wh2")
    paths = SY.seed_tables(spark, root, "initial")
    doc = {"tables": {k: dict(v) for k, v in EXAMPLE_REGISTRY["tables"].items()},
           "global_settings": EXAMPLE_REGISTRY["global_settings"]}
    for t in ("transactions", "user_profiles"):
        doc["tables"][t] = {**doc["tables"][t], "schema": list(doc["tables"][t]["schema"])}
    run = run_registry(spark, Registry(doc), {k: paths[k] for k in ("transactions", "user_profiles")})
    res = {(r["table_name"], r["validation_type"]): r for r in run.validation_results.collect()}
    assert len(res) == 8 and all(r["passed"] for r in res.values())
    # expected pooled rates at 5 % faults are small: not-null ~0.3 %, range ~1.25 %
    assert res[("transactions", "range")]["violation_percentage"] < 0.05
    assert run.validation_results.filter(F.col("total_rows") != 1000).filter("table_name='transactions'").count() == 0


def test_configure_builder_applies_settings():
    from pyspark.sql import SparkSession
    from tablecheck.session import configure
    b = configure(SparkSession.Builder(), Registry(EXAMPLE_REGISTRY).spark_config(),
                  spark__sql__shuffle__partitions="400")
    opts = b._options
    assert opts["spark.sql.shuffle.partitions"] == "400"
    assert opts["spark.sql.parquet.columnarReaderBatchSize"] == "4096"
    assert opts["spark.sql.adaptive.enabled"] == "true"
