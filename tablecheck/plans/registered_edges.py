"""Registered queries for the edges of the contract: errors, wide suites, empty
files, offsets, missing timestamps, typed bounds and several-file streams.

Each derives its awkward input from the provided tables; oracles state the
expected rows independently of the code under test.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import files as FC
from ..operators.gate import TableSpec, stop_decision
from ..operators.validate import FusedCheck
from ..rules import TableRules, expression, in_range, not_null
from ..session import scratch_path
from ..sources import files as FS
from ..sources import synth as SY
from ..sources.tables import append_table, create_table, default_interval, incremental_slice
from ..streaming import hourly as ST
from . import oracle_sql as O
from .classes import validate_paths
from .registered import LINEITEM_PLAIN, _windowed_sql, register
from .registry import EXAMPLE_REGISTRY, Registry
from .publish import publish_table
from .registry_run import run_registry
from .run import run_suite
from .testdata_checks import CUSTOMER, EVENTS, Check, Suite, table, union_all
from .windows import windowed_validation

# -- fail closed ------------------------------------------------------------------


def _unreadable(df: DataFrame) -> DataFrame:
    """A table whose rows cannot be produced (what a damaged file does at run time)."""
    return df.filter(F.coalesce(F.raise_error(F.lit("damaged")).cast("boolean"), F.lit(True)))


@register("unreadable_verdict",
          "WITH r AS (" + O.validation_results_sql([LINEITEM_PLAIN, EVENTS]) + "), d AS (SELECT table_name, "
          "CASE WHEN bool_and(passed) THEN 'continue' ELSE 'stop' END AS decision FROM r GROUP BY table_name) "
          "SELECT r.table_name, r.validation_type, r.violation_percentage, r.passed, d.decision FROM r JOIN d USING (table_name) "
          "UNION ALL SELECT table_name, validation_type, CAST(NULL AS DOUBLE), false, 'stop' FROM ("
          + O.validation_results_sql([CUSTOMER]) + ")")
def unreadable_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of three tables fails while it is read: its families fail and stop, the others are validated."""
    suites = (CUSTOMER, LINEITEM_PLAIN, EVENTS)
    run = run_suite(spark, [(TableSpec(s.table_name, f"{sf_dir}/{s.table_name}.parquet"), s.table_rules()) for s in suites],
                    {"customer": _unreadable}, isolate_tables=True)
    policies = spark.createDataFrame([(s.table_name, True, True) for s in suites],
                                     "table_name string, metadata_stop_on_failure boolean, data_stop_on_threshold boolean")
    decisions = stop_decision(run.validation_results, run.gate, policies).select("table_name", "decision")
    return run.validation_results.join(decisions, "table_name").select(
        "table_name", "validation_type", "violation_percentage", "passed", "decision")


# -- any number of rules ------------------------------------------------------------

def _wide(table_name: str, columns: tuple[tuple[str, float], ...], n: int) -> Suite:
    """``n`` range rules with bounds spread over the columns' ranges."""
    checks = []
    for k in range(n):
        column, top = columns[k % len(columns)]
        bound = round(top * (k + 1) / (n + 1), 4)
        checks.append(Check(in_range(column, max=bound), f"{column} > {bound!r}"))
    return Suite(table_name, tuple(checks))


WIDE_500 = _wide("lineitem", (("l_quantity", 50.0), ("l_extendedprice", 100000.0), ("l_discount", 0.1), ("l_tax", 0.08)), 500)
WIDE_60 = _wide("events", (("value", 250.0), ("user_id", 1000.0)), 60)


@register("wide_suite_500", O.validation_results_sql([WIDE_500]))
def wide_suite_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FusedCheck(table(spark, sf_dir, "lineitem"), WIDE_500.table_rules()).validation_results()


#: 500 expressions, of which two fail while running.
HALVED_500 = Suite("lineitem", tuple(
    Check(expression(f"r{k}", "CASE WHEN l_linenumber > 0 THEN raise_error('no') ELSE true END" if k in (130, 407)
                     else f"l_orderkey % 500 <> {k}"),
          "false" if k in (130, 407) else f"l_orderkey % 500 = {k}") for k in range(500)))


@register("runtime_errors_among_500", "WITH r AS (" + O.rule_results_sql([HALVED_500]) + ") SELECT * REPLACE ("
          "CASE WHEN rule_name IN ('r130', 'r407') THEN 'error' ELSE status END AS status, "
          "CASE WHEN rule_name IN ('r130', 'r407') THEN 'USER_RAISED_EXCEPTION' END AS error) FROM r")
def runtime_errors_among_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that fail while running are found by halving the rules of the failed aggregate."""
    check = FusedCheck(table(spark, sf_dir, "lineitem"), HALVED_500.table_rules(), on_error="ignore")
    return check.materialize().rule_results()


def _event_files(spark: SparkSession, sf_dir: str, n: int = 4) -> str:
    """The events table as ``n`` files in time order."""
    path = scratch_path(spark, "event_files")
    table(spark, sf_dir, "events").repartitionByRange(n, "ts").sortWithinPartitions("ts").write.parquet(path)
    return path


@register("stream_wide_suite", _windowed_sql(WIDE_60, "ts", "hour", 0.10))
def stream_wide_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty rules in complete mode over several files, one per micro-batch."""
    return ST.stream_windowed_validation(spark, _event_files(spark, sf_dir), table(spark, sf_dir, "events").schema,
                                         WIDE_60.table_rules(), "ts", output_mode="complete", max_files_per_trigger=1)


@register("stream_several_files_update", _windowed_sql(EVENTS, "ts", "hour", 0.10))
def stream_several_files_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode over several micro-batches: the newest version of each window (files overlap no window's watermark)."""
    return ST.stream_windowed_validation(spark, _event_files(spark, sf_dir), table(spark, sf_dir, "events").schema,
                                         EVENTS.table_rules(), "ts", output_mode="update", max_files_per_trigger=1,
                                         watermark="60 days")


# -- many tables in one plan -----------------------------------------------------------

@register("tables_by_class", """
WITH o AS (SELECT 'orders_' || CAST(o_custkey % 40 AS VARCHAR) AS table_name, count(*) AS n, count_if(o_orderdate IS NULL) AS holes,
  count_if(o_totalprice < 1000 OR o_totalprice > 200000) AS far, count_if(o_orderkey % 7 = 0) AS sevens FROM orders GROUP BY 1),
r AS (SELECT table_name, n, unnest([{'t': 'not_null', 'v': holes}, {'t': 'range', 'v': far}, {'t': 'cross_column', 'v': sevens}], recursive := true) FROM o)
SELECT table_name, t AS validation_type, CAST(n AS BIGINT) AS total_rows, 1 AS rules_configured, CAST(v AS BIGINT) AS total_violations,
  v / CAST(n AS DOUBLE) AS violation_percentage, CAST(0.1 AS DOUBLE) AS threshold, v / CAST(n AS DOUBLE) <= 0.1 AS passed FROM r""")
def tables_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty tables of one schema and one set of rules, in one scan."""
    root = scratch_path(spark, "table_class")
    orders = table(spark, sf_dir, "orders")
    orders.withColumn("k", F.col("o_custkey") % 40).repartition("k").write.partitionBy("k").parquet(root)
    held = [r["k"] for r in orders.select((F.col("o_custkey") % 40).alias("k")).distinct().collect()]  # forty at most
    rules = (not_null("o_orderdate"), in_range("o_totalprice", min=1000.0, max=200000.0), expression("sevens", "o_orderkey % 7 <> 0"))
    return validate_paths(spark, [(f"{root}/k={k}", TableRules(f"orders_{k}", rules)) for k in held],
                          schemas={f"{root}/k={k}": orders.schema for k in held})[1]


# -- write, audit, publish ------------------------------------------------------------

@register("publish_audited", """
WITH o AS (SELECT count(*) AS n, count_if(o_orderstatus = 'F') AS f, count_if(o_orderstatus = 'F' AND o_orderkey % 3 = 0) AS bad FROM orders),
s AS (SELECT 1 AS step, n AS total_rows, 0 AS total_violations, true AS passed, n AS rows_shown FROM o
  UNION ALL SELECT 2, f, bad, false, n FROM o UNION ALL SELECT 3, f, 0, true, f FROM o)
SELECT step, CAST(total_rows AS BIGINT) AS total_rows, CAST(total_violations AS BIGINT) AS total_violations, passed,
  passed AS published, CAST(rows_shown AS BIGINT) AS rows_shown FROM s""")
def publish_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of a table, of which the second fails its rule; what a reader sees after each."""
    name, versions = f"publish_{uuid.uuid4().hex[:10]}", scratch_path(spark, "publish")
    orders = table(spark, sf_dir, "orders")
    filled = orders.filter("o_orderstatus = 'F'")
    holed = filled.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")))
    rules = TableRules("orders", (not_null("o_custkey"),))
    steps = []
    for k, version in enumerate((orders, holed, filled), 1):
        verdict = publish_table(spark, name, version, rules, versions).verdicts()
        shown = spark.read.parquet(spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"])
        steps.append(verdict.crossJoin(shown.agg(F.count("*").alias("rows_shown"))).select(  # one row each
            F.lit(k).alias("step"), "total_rows", "total_violations", "passed", "published", "rows_shown"))
    spark.sql(f"DROP TABLE {name}")
    return union_all(steps)


# -- strict JSON --------------------------------------------------------------------

@register("strict_json_documents",
          "SELECT CAST(event_id % 8 AS INTEGER) AS shape, count(*) AS documents, "
          "CAST(count_if(event_id % 8 IN (0, 7)) AS BIGINT) AS valid FROM events GROUP BY 1")
def strict_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows or spoils a valid document makes it invalid; white space around it does not."""
    from ..functions.predicates import json_document_ok

    p, shape = F.col("props"), (F.col("event_id") % 8).cast("int")
    spoiled = [p, F.concat(p, F.lit("]")), F.concat(p, F.lit("],["), p), F.concat(p, p), F.concat(p, F.lit(" trailing")), F.lit(""),
               F.concat(p, F.lit('},"x":{"y":1')), F.concat(F.lit(" \n"), p, F.lit("\t "))]
    doc = F.element_at(F.array(*spoiled), shape + 1)
    return table(spark, sf_dir, "events").select(shape.alias("shape"), doc.alias("doc")).groupBy("shape").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(json_document_ok(F.col("doc"))).alias("valid"))


# -- files, empty files, empty folders ------------------------------------------------

def _touch(spark: SparkSession, path: str) -> None:
    handle = FS._fs(spark, path)
    fs, p = handle
    fs.create(p).close()


def _mkdirs(spark: SparkSession, path: str) -> str:
    fs, p = FS._fs(spark, path)
    fs.mkdirs(p)
    return path


def _supplier_files(spark: SparkSession, sf_dir: str) -> str:
    """One JSON file per supplier with its key and name's length, and an empty file."""
    path = scratch_path(spark, "supplier_docs")
    docs = table(spark, sf_dir, "supplier").select("s_suppkey", F.octet_length("s_name").alias("n_bytes"))
    FS.write_json_documents(docs, path, one_per_file=True)
    _touch(spark, f"{path}/empty.json")
    return path


FILE_REGISTRY = {"tables": {name: {
    "type": "unstructured", "format": "json", "layout": "document", "incremental": True,
    "validations": {"file_existence": {"enabled": True}, "metadata_keys": {"required": ["s_suppkey", "n_bytes"]},
                    "file_size": {"min_bytes": 1}},
    "quality_threshold": 0.10} for name in ("supplier_docs", "empty_folder")}}


def _file_rows(run: str) -> str:
    def row(t, check, total, bad, limit, rate=None):
        rate = rate or f"CASE WHEN {total} = 0 THEN 0.0 ELSE CAST({bad} AS DOUBLE) / {total} END"
        return (f"SELECT '{run}' AS run, '{t}' AS table_name, '{check}' AS validation_type, CAST({total} AS BIGINT) AS total_rows, "
                f"CAST({bad} AS BIGINT) AS total_violations, ({rate}) <= {limit} AS passed FROM n")
    return " UNION ALL ".join([
        row("supplier_docs", "file_existence", "n", 0, 0.0), row("supplier_docs", "required_keys", "n", 1, 0.1),
        row("supplier_docs", "file_size", "n", 1, 0.0), row("empty_folder", "file_existence", 0, 1, 0.0, "1.0"),
        row("empty_folder", "required_keys", 0, 0, 0.1), row("empty_folder", "file_size", 0, 0, 0.0)])


@register("registry_files", "WITH n AS (SELECT count(*) + 1 AS n FROM supplier) " + _file_rows("batch") + " UNION ALL " + _file_rows("state"))
def registry_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch run and a file-stream run of the same folders give the same rows, empty files and folders included."""
    locations = {"supplier_docs": _supplier_files(spark, sf_dir), "empty_folder": _mkdirs(spark, scratch_path(spark, "empty_folder"))}
    parts = []
    for run, state in (("batch", None), ("state", scratch_path(spark, "file_state"))):
        results = run_registry(spark, Registry(FILE_REGISTRY), locations, state_dir=state).validation_results
        parts.append(results.select(F.lit(run).alias("run"), "table_name", "validation_type", "total_rows", "total_violations", "passed"))
    return union_all(parts)


@register("file_listing",
          "SELECT count(*) + 1 AS files, CAST(1 AS BIGINT) AS empty_files, CAST(sum(strlen('{\"s_suppkey\":' || s_suppkey || "
          "',\"n_bytes\":' || strlen(s_name) || '}') + 1) AS BIGINT) AS total_bytes, true AS folder_exists, true AS file_exists, "
          "false AS file_is_folder, false AS other_exists FROM supplier")
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, sizes and existence over a folder whose content follows from a table."""
    path = _supplier_files(spark, sf_dir)
    m = FS.file_manifest(spark, path, "*.json").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("file_size") == 0).alias("empty_files"), F.sum("file_size").alias("total_bytes"))
    folder, file, other = (FS.directory_status(spark, p).first() for p in (path, f"{path}/empty.json", f"{path}/none"))
    return m.withColumns({"folder_exists": F.lit(folder["exists"] and folder["is_directory"]), "file_exists": F.lit(file["exists"]),
                          "file_is_folder": F.lit(file["is_directory"]), "other_exists": F.lit(other["exists"])})


@register("json_dir_exists",
          "SELECT * FROM (VALUES ('input', true, true), ('none', false, false)) AS t(place, \"exists\", is_directory)")
def json_dir_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory status of the input folder, and of one that is not there."""
    places = {"input": sf_dir, "none": f"{sf_dir}/no_such_folder"}
    return union_all([FS.directory_status(spark, p).select(F.lit(n).alias("place"), "exists", "is_directory") for n, p in places.items()])


@register("json_file_count", "SELECT count(*) + 1 AS json_files FROM supplier")
def json_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FS.file_manifest(spark, _supplier_files(spark, sf_dir), "*.json").agg(F.count(F.lit(1)).alias("json_files"))


@register("file_manifest",
          "SELECT file_size, count(*) AS files FROM (SELECT CAST(strlen('{\"s_suppkey\":' || s_suppkey || ',\"n_bytes\":' || strlen(s_name) "
          "|| '}') + 1 AS BIGINT) AS file_size FROM supplier UNION ALL SELECT 0) GROUP BY 1")
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by size, the empty one included."""
    return FS.file_manifest(spark, _supplier_files(spark, sf_dir), "*.json").groupBy("file_size").agg(F.count(F.lit(1)).alias("files"))


# -- generated data: faults found against faults injected --------------------------------

AS_OF = "2024-03-01 00:00:00"
TXN_FOUND = {"null": "user_id IS NULL", "range": "amount < 0.01", "regex_id": "NOT transaction_id RLIKE '^TXN[0-9]{10}$'",
             "regex_status": "status = 'UNKNOWN'", "future": f"transaction_timestamp > timestamp'{AS_OF}'"}
USER_FOUND = {"null": "email IS NULL", "range_age": "age > 120", "range_balance": "account_balance < 0",
              "regex_id": "NOT user_id RLIKE '^USR[0-9]{8}$'", "regex_email": "email = 'not-email'"}


def _fault_rows(df: DataFrame, found: dict[str, str]) -> DataFrame:
    """Per fault kind: rows, whether the rule finds what was injected, whether faults are 5 % give or take."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count("fault_kind").alias("faulty"),
                    *[F.count_if(F.col("fault_kind") == k).alias(f"i_{k}") for k in found],
                    *[F.count_if(F.expr(e)).alias(f"f_{k}") for k, e in found.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("fault_kind"), (F.col(f"i_{k}") == F.col(f"f_{k}")).alias("equal")) for k in found])
    rate = F.col("faulty") / F.col("total")
    return counts.select("total", rate.between(0.02, 0.08).alias("rate_ok"), F.inline(rows)).select("fault_kind", "total", "equal", "rate_ok")


def _fault_sql(found: dict[str, str], source: str) -> str:
    kinds = ", ".join(f"('{k}')" for k in found)
    return f"SELECT fault_kind, (SELECT count(*) FROM {source}) AS total, true AS equal, true AS rate_ok FROM (VALUES {kinds}) AS k(fault_kind)"


@register("synth_transactions", _fault_sql(TXN_FOUND, "orders"))
def synth_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return _fault_rows(SY.generate_transactions(spark, ids=ids, as_of=AS_OF, with_fault_kind=True), TXN_FOUND)


@register("synth_user_profiles", _fault_sql(USER_FOUND, "customer"))
def synth_user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return _fault_rows(SY.generate_users(spark, ids=ids, as_of=AS_OF, with_fault_kind=True), USER_FOUND)


@register("synth_event_logs", "SELECT 'event_logs' AS table_name, count(*) AS total_files, true AS rate_ok, true AS passed FROM events")
def synth_event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log document per event id, written as JSON Lines, read back and checked."""
    ids = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    path = scratch_path(spark, "synth_event_logs")
    FS.write_json_documents(SY.generate_event_logs(spark, ids=ids, as_of=AS_OF), path)
    keys = EXAMPLE_REGISTRY["tables"]["event_logs"]["validations"]["metadata_keys"]["required"]
    r = FC.required_keys_check(FS.scan_json_files(spark, path, "*.json", mode="lines"), "value", keys, "event_logs")
    return r.select("table_name", "total_files", F.col("violation_percentage").between(0.02, 0.08).alias("rate_ok"), "passed")


#: Fault kinds that each rule family of the example registry finds.
FAMILY_FAULTS = {"transactions": {"not_null": ["null"], "range": ["range"], "regex": ["regex_id", "regex_status"], "cross_column": ["future"]},
                 "user_profiles": {"not_null": ["null"], "range": ["range_age", "range_balance"], "regex": ["regex_id", "regex_email"],
                                   "cross_column": []}}


@register("synth_suite",
          " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{f}' AS validation_type, count(*) AS total_rows, true AS found_as_injected, "
                             f"true AS passed FROM {src}" for t, src in (("transactions", "orders"), ("user_profiles", "customer"))
                             for f in FAMILY_FAULTS[t]))
def synth_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The example registry's rules on generated tables find exactly the injected faults."""
    reg = Registry(EXAMPLE_REGISTRY)
    # generated relative to now: the registry's rules compare with the current time
    tables = {"transactions": SY.generate_transactions(spark, ids=table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")),
                                                       with_fault_kind=True),
              "user_profiles": SY.generate_users(spark, ids=table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")),
                                                 with_fault_kind=True)}
    parts = []
    for name, df in tables.items():
        results = FusedCheck(df.drop("fault_kind"), reg.table_rules(name)).validation_results()
        families = FAMILY_FAULTS[name]
        injected = df.agg(*[F.count_if(F.col("fault_kind").isin(kinds)).alias(f) for f, kinds in families.items()])
        rows = injected.select(F.inline(F.array(*[F.struct(F.lit(f).alias("validation_type"), F.col(f).alias("injected")) for f in families])))
        parts.append(results.join(rows, "validation_type").select(
            "table_name", "validation_type", "total_rows", (F.col("total_violations") == F.col("injected")).alias("found_as_injected"), "passed"))
    return union_all(parts)


# -- time ----------------------------------------------------------------------------

OFFSET_SLICE = ("2024-01-15T09:00:00+09:00", "2024-01-16T09:00:00+09:00")


@register("incremental_slice_offset",
          "SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'")
def incremental_slice_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds with an offset over a day-partitioned copy: rows and partitions follow from the same instants."""
    path = scratch_path(spark, "events_by_utc_day")
    ev = table(spark, sf_dir, "events")
    ev.withColumn("dt", F.to_date("ts")).repartition("dt").write.partitionBy("dt").parquet(path)
    return incremental_slice(spark.read.parquet(path), "ts", *OFFSET_SLICE, columns=["event_id", "value"], partition_column="dt")


_NULL_TS_SQL = "(SELECT * REPLACE (CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS ts) FROM events)"
EVENTS_NULL_TS = Suite("events", EVENTS.checks, EVENTS.threshold, _NULL_TS_SQL)


@register("hourly_validation_null_ts", _windowed_sql(EVENTS_NULL_TS, "ts", "hour", 0.10))
def hourly_validation_null_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    return windowed_validation(ev, EVENTS.table_rules(), "ts", "1 hour")


@register("default_interval_slice",
          "SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' AND ts < TIMESTAMP '2024-01-15 13:00:00'")
def default_interval_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without an interval in the environment: the hour before now."""
    bounds = default_interval({}, _dt.datetime(2024, 1, 15, 13))
    return incremental_slice(table(spark, sf_dir, "events"), "ts", *bounds, columns=["event_id", "value"])


TYPED_BOUNDS = Suite("events", (
    Check(in_range("ts", min="2024-01-10 00:00:00", max="2024-02-20 12:30:00"),
          "ts < TIMESTAMP '2024-01-10 00:00:00' OR ts > TIMESTAMP '2024-02-20 12:30:00'"),
    Check(in_range("event_type", min="click", max="purchase"), "event_type < 'click' OR event_type > 'purchase'"),
    Check(in_range("day", max="2024-02-01"), "CAST(ts AS DATE) > DATE '2024-02-01'"),
    Check(in_range("value", 1, 200), "value < 1 OR value > 200"),
))


@register("range_by_type", O.rule_results_sql([TYPED_BOUNDS]))
def range_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds are compared in the column's type: timestamps, text, dates, numbers."""
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return FusedCheck(ev, TYPED_BOUNDS.table_rules()).rule_results()


# -- settings and seeding --------------------------------------------------------------

@register("global_settings",
          "SELECT 'reporting.history_retention_days' AS setting, '12' AS value, CAST(count_if(ts >= (SELECT max(ts) FROM events) "
          "- INTERVAL 12 DAY) AS BIGINT) AS rows_in_force FROM events")
def global_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry's global settings, and what its retention keeps of the events."""
    reg = Registry({"tables": {}, "global_settings": {"reporting": {"history_retention_days": 12}}})
    days = reg.get_global_settings()["reporting"]["history_retention_days"]
    ev = table(spark, sf_dir, "events")
    newest = ev.agg(F.max("ts").alias("newest"))
    kept = ev.crossJoin(F.broadcast(newest)).agg(
        F.count_if(F.col("ts") >= F.col("newest") - F.make_dt_interval(F.lit(days))).alias("rows_in_force"))
    return kept.select(F.lit("reporting.history_retention_days").alias("setting"), F.lit(str(days)).alias("value"), "rows_in_force")


@register("seed_modes",
          "SELECT 'initial' AS mode, count(*) AS expected_rows, count(*) AS seeded_rows FROM orders UNION ALL "
          "SELECT 'append', count(*), count(*) FROM customer")
def seed_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An initial load over the orders' ids, then an appended batch over the customers'."""
    path = scratch_path(spark, "seeded")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    create_table(spark, path, SY.generate_transactions(spark, ids=orders).withColumn("mode", F.lit("initial")))
    append_table(spark, path, SY.generate_transactions(spark, ids=customers, seed=1042).withColumn("mode", F.lit("append")))
    seeded = spark.read.parquet(path).groupBy("mode").agg(F.count(F.lit(1)).alias("seeded_rows"))
    expected = union_all([df.agg(F.count(F.lit(1)).alias("expected_rows")).withColumn("mode", F.lit(m))
                          for m, df in (("initial", orders), ("append", customers))])
    return expected.join(seeded, "mode").select("mode", "expected_rows", "seeded_rows")
