"""Registered queries over the provided test tables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Keys without an oracle are rows-only checks (streaming, generators, file
listings).
"""

from __future__ import annotations

import uuid as _uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import files as FC
from ..operators import report as R
from ..operators import schema as S
from ..operators import tags as TG
from ..operators.gate import TableSpec, _map_threads, stop_decision
from ..operators.validate import FusedCheck, rollup_rule_results
from ..rules import expression, in_range
from ..session import scratch_path
from ..sources import files as FS
from ..sources import sinks as SK
from ..sources import synth as SY
from ..sources.tables import append_table, create_table, incremental_slice, pruned_filtered_read, read_table
from ..streaming import hourly as ST
from . import oracle_sql as O
from .registry import EXAMPLE_REGISTRY, Registry
from .registry_run import annotate_results, run_registry
from .run import run_suite, validate_many
from .testdata_checks import (ALL_SUITES, CUSTOMER, DOCUMENTS, EVENTS, LINEITEM, PAGES, TABLE_THRESHOLDS,
                              Check, Suite, fused, lineitem_with_nulls, suite_frame, table, union_all)
from .windows import windowed_validation

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _family_validation(spark, sf_dir, suites, family):
    return union_all([fused(spark, sf_dir, s.of_type(family)).validation_results() for s in suites])


def _family_rules(spark, sf_dir, suites, family):
    return union_all([fused(spark, sf_dir, s.of_type(family)).rule_results() for s in suites])


# -- V1..V4: one family at a time ---------------------------------------------------

_NN = [LINEITEM.of_type("not_null"), CUSTOMER.of_type("not_null")]


@register("not_null_check", O.validation_results_sql(_NN))
def not_null_check(spark, sf_dir):
    return _family_validation(spark, sf_dir, [LINEITEM, CUSTOMER], "not_null")


@register("not_null_by_rule", O.rule_results_sql(_NN))
def not_null_by_rule(spark, sf_dir):
    return _family_rules(spark, sf_dir, [LINEITEM, CUSTOMER], "not_null")


_RG = [LINEITEM.of_type("range"), CUSTOMER.of_type("range")]


@register("range_check", O.validation_results_sql(_RG))
def range_check(spark, sf_dir):
    return _family_validation(spark, sf_dir, [LINEITEM, CUSTOMER], "range")


ONE_SIDED = Suite("lineitem", (
    Check(in_range("l_quantity", min=5), "l_quantity < 5"),
    Check(in_range("l_extendedprice", max=100000), "l_extendedprice > 100000"),
    Check(in_range("l_tax"), None, status="no_predicate"),
    Check(in_range("l_no_such_column", 0, 1), None, status="column_missing"),
))


@register("range_one_sided", O.rule_results_sql([ONE_SIDED]))
def range_one_sided(spark, sf_dir):
    return fused(spark, sf_dir, ONE_SIDED).rule_results()


_RX = [CUSTOMER.of_type("regex"), PAGES.of_type("regex")]


@register("regex_check", O.validation_results_sql(_RX))
def regex_check(spark, sf_dir):
    return _family_validation(spark, sf_dir, [CUSTOMER, PAGES], "regex")


@register("regex_by_rule", O.rule_results_sql(_RX))
def regex_by_rule(spark, sf_dir):
    return _family_rules(spark, sf_dir, [CUSTOMER, PAGES], "regex")


_CC = [EVENTS.of_type("cross_column"), DOCUMENTS.of_type("cross_column"), LINEITEM.of_type("cross_column")]


@register("cross_column_check", O.validation_results_sql(_CC))
def cross_column_check(spark, sf_dir):
    return _family_validation(spark, sf_dir, [EVENTS, DOCUMENTS, LINEITEM], "cross_column")


@register("cross_column_by_rule", O.rule_results_sql(_CC))
def cross_column_by_rule(spark, sf_dir):
    return _family_rules(spark, sf_dir, [EVENTS, DOCUMENTS, LINEITEM], "cross_column")


BAD_RULES = Suite("events", (
    Check(expression("errors_are_small", "event_type <> 'error' OR value < 100"),
          "NOT (event_type <> 'error' OR value < 100)"),
    Check(expression("unknown_column", "no_such_column > 0"), None, status="error",
          error="UNRESOLVED_COLUMN.WITH_SUGGESTION"),
    Check(expression("not_boolean", "value + 1"), None, status="error", error="NOT_BOOLEAN:double"),
    Check(expression("syntax", "value >>> <"), None, status="error", error="PARSE_SYNTAX_ERROR"),
    Check(expression(None, ""), None, status="no_expression"),
))


@register("cross_column_bad_rule", O.rule_results_sql([BAD_RULES]))
def cross_column_bad_rule(spark, sf_dir):
    return fused(spark, sf_dir, BAD_RULES, on_error="ignore").rule_results()


@register("cross_column_bad_rule_verdict", O.validation_results_sql([BAD_RULES]))
def cross_column_bad_rule_verdict(spark, sf_dir):
    return fused(spark, sf_dir, BAD_RULES, on_error="ignore").validation_results()


# -- V5..V8: verdicts and suites -------------------------------------------------------

@register("threshold_verdict", O.validation_results_sql([LINEITEM]))
def threshold_verdict(spark, sf_dir):
    return fused(spark, sf_dir, LINEITEM).validation_results()


EMPTY_WHERE = "l_quantity < 0"


@register("empty_table_verdict", O.validation_results_sql([LINEITEM], where=EMPTY_WHERE))
def empty_table_verdict(spark, sf_dir):
    df = lineitem_with_nulls(spark, sf_dir).filter(F.col("l_quantity") < 0)
    return FusedCheck(df, LINEITEM.table_rules()).validation_results()


@register("suite_results", O.rule_results_sql([LINEITEM]))
def suite_results(spark, sf_dir):
    return fused(spark, sf_dir, LINEITEM).rule_results()


def _all_suites(spark, sf_dir):
    """(rule results, validation results) of every suite; tables are resolved
    and checks planned on driver threads."""
    frames = _map_threads(lambda s: suite_frame(spark, sf_dir, s), ALL_SUITES, 8)
    return validate_many([(f, s.table_rules()) for f, s in zip(frames, ALL_SUITES)])


@register("multi_table_suite", O.validation_results_sql(list(ALL_SUITES)))
def multi_table_suite(spark, sf_dir):
    return _all_suites(spark, sf_dir)[1]


@register("per_table_threshold", O.validation_results_sql(list(ALL_SUITES), TABLE_THRESHOLDS))
def per_table_threshold(spark, sf_dir):
    return rollup_rule_results(_all_suites(spark, sf_dir)[0], TABLE_THRESHOLDS)


# -- S1..S3: scans ---------------------------------------------------------------------


@register("read_table_columns",
          "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def read_table_columns(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])


@register("pruned_filtered_read",
          "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_discount > 0.05")
def pruned_filtered_read_q(spark, sf_dir):
    return pruned_filtered_read(spark, f"{sf_dir}/lineitem.parquet",
                                ["l_orderkey", "l_linenumber", "l_extendedprice"], "l_discount > 0.05")


SLICE = ("2024-01-15 10:00:00", "2024-01-15 11:00:00")
SLICE_WHERE = f"ts >= TIMESTAMP '{SLICE[0]}' AND ts < TIMESTAMP '{SLICE[1]}'"


@register("incremental_slice", f"SELECT event_id, value FROM events WHERE {SLICE_WHERE}")
def incremental_slice_q(spark, sf_dir):
    return incremental_slice(table(spark, sf_dir, "events"), "ts", *SLICE, columns=["event_id", "value"])


@register("incremental_slice_partitioned", f"SELECT event_id, value FROM events WHERE {SLICE_WHERE}")
def incremental_slice_partitioned(spark, sf_dir):
    """The same slice over a copy of events partitioned by day: only one
    partition directory is listed and read."""
    d = scratch_path(spark, "events_by_day")
    ev = table(spark, sf_dir, "events")
    ev.withColumn("dt", F.to_date("ts")).write.mode("overwrite").partitionBy("dt").parquet(d)
    return incremental_slice(spark.read.parquet(d), "ts", *SLICE, columns=["event_id", "value"],
                             partition_column="dt")


SLICE_SUITE = Suite("events", (
    Check(in_range("value", 1, 200), "value < 1 OR value > 200"),
    Check(expression("errors_are_small", "event_type <> 'error' OR value < 100"),
          "NOT (event_type <> 'error' OR value < 100)"),
))


@register("incremental_validation", O.validation_results_sql([SLICE_SUITE], where=SLICE_WHERE))
def incremental_validation(spark, sf_dir):
    df = incremental_slice(table(spark, sf_dir, "events"), "ts", *SLICE)
    return FusedCheck(df, SLICE_SUITE.table_rules()).validation_results()


# -- M1..M8: metadata ------------------------------------------------------------------


TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()

# Spark class and simple-string spelling of each DuckDB type found in the test tables.
DUCK_TYPE_CLASS = ("CASE data_type WHEN 'BIGINT' THEN 'LongType()' WHEN 'INTEGER' THEN 'IntegerType()' "
                   "WHEN 'DOUBLE' THEN 'DoubleType()' WHEN 'VARCHAR' THEN 'StringType()' "
                   "WHEN 'TIMESTAMP' THEN 'TimestampNTZType()' WHEN 'TIMESTAMP_NS' THEN 'TimestampNTZType()' "
                   "WHEN 'TIMESTAMP_US' THEN 'TimestampNTZType()' WHEN 'BOOLEAN' THEN 'BooleanType()' "
                   "WHEN 'FLOAT[]' THEN 'ArrayType(FloatType(), True)' ELSE data_type END")
DUCK_TYPE_SIMPLE = ("CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
                    "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
                    "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP_NS' THEN 'timestamp_ntz' "
                    "WHEN 'TIMESTAMP_US' THEN 'timestamp_ntz' WHEN 'BOOLEAN' THEN 'boolean' "
                    "WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END")
DUCK_COLUMNS = (f"(SELECT table_name, CAST(ordinal_position AS INTEGER) AS ordinal, column_name, "
                f"{DUCK_TYPE_SIMPLE} AS data_type, {DUCK_TYPE_CLASS} AS type_class "
                f"FROM information_schema.columns)")


def _in_list(names):
    return ", ".join(O.q(n) for n in names)


EXISTS_PROBE = ("lineitem", "orders", "events", "no_such_table")


@register("table_exists",
          " UNION ALL ".join(
              f"SELECT {O.q(n)} AS table_name, (SELECT count(*) FROM information_schema.tables "
              f"WHERE table_name = {O.q(n)}) > 0 AS \"exists\"" for n in EXISTS_PROBE))
def table_exists_q(spark, sf_dir):
    return S.exists_frame(spark, {n: f"{sf_dir}/{n}.parquet" for n in EXISTS_PROBE})


@register("table_schema",
          f"SELECT * FROM {DUCK_COLUMNS} WHERE table_name IN ({_in_list(TEST_TABLES)})")
def table_schema_q(spark, sf_dir):
    return union_all([S.table_schema(spark, f"{sf_dir}/{n}.parquet", n) for n in TEST_TABLES])


# Expected schemas used by the schema keys: declared types in PySpark class
# spelling; a list means names only.
EXPECTED = {
    "lineitem": {"l_orderkey": "long", "l_partkey": "integer", "l_suppkey": "long",
                 "l_linenumber": "long", "l_quantity": "decimal(12,2)", "l_extendedprice": "double",
                 "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
                 "l_linestatus": "string", "l_shipdate": "timestamp", "l_comment": "string"},
    "orders": {"o_orderkey": "long", "o_custkey": "long", "o_orderstatus": "string",
               "o_totalprice": "decimal(15,2)", "o_orderdate": "date"},
    "embeddings": {"vec_id": "long", "embedding": "float", "label": "long"},
    "customer": {"c_custkey": "long", "c_name": "string", "c_nationkey": "integer",
                 "c_acctbal": "double", "c_mktsegment": "string"},
}


def _expected_values(expected):
    rows = []
    for t, cols in expected.items():
        for c, ty in cols.items():
            rows.append(f"({O.q(t)}, {O.q(c)}, {O.q(ty)})")
    return "(VALUES " + ", ".join(rows) + ") AS e(table_name, column_name, expected_type)"


def _norm(x):
    return f"replace(replace(lower({x}), 'type()', ''), '()', '')"


_E, _A = _norm("e.expected_type"), _norm("a.type_class")
LOOSE_OK = (f"(contains({_A}, {_E}) OR contains({_E}, {_A}) "
            f"OR (contains({_E}, 'decimal') AND contains({_A}, 'decimal')) "
            f"OR ({_E} IN ('timestamp', 'date') AND {_A} IN ('timestamptype', 'datetype', 'timestamp', 'date')) "
            f"OR {_E} = {_A})")
_TABLES_WITH_EXPECTED = _in_list(EXPECTED)
SCHEMA_DIFFS_SQL = (
    f"WITH e AS (SELECT * FROM {_expected_values(EXPECTED)}), "
    f"a AS (SELECT * FROM {DUCK_COLUMNS} WHERE table_name IN ({_TABLES_WITH_EXPECTED})) "
    "SELECT e.table_name, 'missing' AS kind, e.column_name, e.expected_type, CAST(NULL AS VARCHAR) AS actual_type "
    "FROM e LEFT JOIN a ON e.table_name = a.table_name AND e.column_name = a.column_name WHERE a.column_name IS NULL "
    "UNION ALL SELECT a.table_name, 'extra', a.column_name, NULL, a.data_type "
    "FROM a LEFT JOIN e ON e.table_name = a.table_name AND e.column_name = a.column_name WHERE e.column_name IS NULL "
    "UNION ALL SELECT e.table_name, 'type_mismatch', e.column_name, e.expected_type, a.data_type "
    f"FROM e JOIN a ON e.table_name = a.table_name AND e.column_name = a.column_name WHERE NOT {LOOSE_OK}")


def _diffs(spark, sf_dir, mode="loose"):
    return union_all([S.schema_check(spark, f"{sf_dir}/{t}.parquet", t, exp, True, mode)
                      for t, exp in EXPECTED.items()])


@register("schema_check", SCHEMA_DIFFS_SQL)
def schema_check_q(spark, sf_dir):
    return _diffs(spark, sf_dir)


@register("schema_missing_columns", f"SELECT * FROM ({SCHEMA_DIFFS_SQL}) WHERE kind = 'missing'")
def schema_missing_columns(spark, sf_dir):
    return _diffs(spark, sf_dir).filter("kind = 'missing'")


@register("schema_extra_columns", f"SELECT * FROM ({SCHEMA_DIFFS_SQL}) WHERE kind = 'extra'")
def schema_extra_columns(spark, sf_dir):
    return _diffs(spark, sf_dir).filter("kind = 'extra'")


@register("schema_type_mismatches", f"SELECT * FROM ({SCHEMA_DIFFS_SQL}) WHERE kind = 'type_mismatch'")
def schema_type_mismatches(spark, sf_dir):
    return _diffs(spark, sf_dir).filter("kind = 'type_mismatch'")


@register("schema_verdict",
          f"SELECT t.table_name, CAST(count(d.kind) AS BIGINT) AS errors, count(d.kind) = 0 AS is_valid "
          f"FROM (VALUES {', '.join('(' + O.q(t) + ')' for t in EXPECTED)}) AS t(table_name) "
          f"LEFT JOIN ({SCHEMA_DIFFS_SQL}) d ON d.table_name = t.table_name GROUP BY t.table_name")
def schema_verdict_q(spark, sf_dir):
    tables = spark.createDataFrame([(t,) for t in EXPECTED], "table_name string")
    return S.schema_verdict(_diffs(spark, sf_dir), tables)


@register("row_count", " UNION ALL ".join(
    f"SELECT {O.q(t)} AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM {t}"
    for t in TEST_TABLES))
def row_count_q(spark, sf_dir):
    return union_all([S.row_count(table(spark, sf_dir, t), t) for t in TEST_TABLES])


ROW_FILTERS = (("lineitem", "l_returnflag = 'R'"), ("orders", "o_orderstatus = 'F'"),
               ("events", "event_type = 'error' AND value > 100"))


@register("row_count_filtered", " UNION ALL ".join(
    [f"SELECT {O.q(t)} AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM {t} WHERE {w}"
     for t, w in ROW_FILTERS]
    + ["SELECT 'events' AS table_name, CAST(NULL AS BIGINT) AS row_count, "
       "'UNRESOLVED_COLUMN.WITH_SUGGESTION' AS error"]))
def row_count_filtered(spark, sf_dir):
    frames = [S.row_count(table(spark, sf_dir, t), t, w) for t, w in ROW_FILTERS]
    frames.append(S.row_count(table(spark, sf_dir, "events"), "events", "no_such_column > 1"))
    return union_all(frames)


@register("not_empty_check",
          "SELECT 'lineitem' AS table_name, count(*) AS row_count, count(*) > 0 AS not_empty FROM lineitem "
          "UNION ALL SELECT 'orders', count(*), count(*) > 0 FROM orders "
          "UNION ALL SELECT 'lineitem_future', count(*), count(*) > 0 FROM lineitem "
          "WHERE l_shipdate > TIMESTAMP '2100-01-01 00:00:00'")
def not_empty_check(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    future = li.filter(F.col("l_shipdate") > F.lit("2100-01-01 00:00:00").cast("timestamp_ntz"))
    return union_all([S.not_empty(li, "lineitem"), S.not_empty(table(spark, sf_dir, "orders"), "orders"),
                      S.not_empty(future, "lineitem_future")])


# -- G1..G5: gate ----------------------------------------------------------------------

GATE_COLUMNS = {
    # names only; lineitem and customer as they are, orders with one more column
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority", "o_comment"],
    "no_such_table": ["x"],
}

ORDERS_SUITE = Suite("orders", (
    Check(in_range("o_totalprice", 0, 500000), "o_totalprice < 0 OR o_totalprice > 500000"),
))
MISSING_SUITE = Suite("no_such_table", (Check(in_range("x", 0, 1), None),))
GATED = (LINEITEM, CUSTOMER, ORDERS_SUITE, MISSING_SUITE)


def _gated_run(spark, sf_dir):
    pairs = [(TableSpec(s.table_name, f"{sf_dir}/{s.table_name}.parquet", GATE_COLUMNS[s.table_name]),
              s.table_rules()) for s in GATED]
    prepare = {"lineitem": lambda df: df.withColumns({
        "l_returnflag": F.expr("nullif(l_returnflag, 'R')"),
        "l_linestatus": F.expr("nullif(l_linestatus, 'F')")})}
    return run_suite(spark, pairs, prepare)


def _gate_diff_sql():
    vals = ", ".join(f"({O.q(t)}, {O.q(c)})" for t, cols in GATE_COLUMNS.items() for c in cols)
    tables = _in_list(GATE_COLUMNS)
    return (f"WITH e AS (SELECT * FROM (VALUES {vals}) AS e(table_name, column_name)), "
            f"a AS (SELECT table_name, column_name FROM information_schema.columns WHERE table_name IN ({tables})), "
            "d AS (SELECT e.table_name, 'missing' AS kind, e.column_name FROM e LEFT JOIN a "
            "ON e.table_name = a.table_name AND e.column_name = a.column_name WHERE a.column_name IS NULL "
            "UNION ALL SELECT a.table_name, 'extra', a.column_name FROM a LEFT JOIN e "
            "ON e.table_name = a.table_name AND e.column_name = a.column_name WHERE e.column_name IS NULL), "
            f"t AS (SELECT * FROM (VALUES {', '.join('(' + O.q(x) + ')' for x in GATE_COLUMNS)}) AS t(table_name)), "
            "x AS (SELECT t.table_name, (SELECT count(*) FROM information_schema.tables i "
            "WHERE i.table_name = t.table_name) > 0 AS ex FROM t), "
            "g AS (SELECT x.table_name, x.ex, "
            "string_agg(d.kind || ' ' || d.column_name, '; ' ORDER BY d.kind, d.column_name) AS errs "
            "FROM x LEFT JOIN d ON d.table_name = x.table_name GROUP BY x.table_name, x.ex) "
            "SELECT table_name, ex AS \"exists\", CASE WHEN ex THEN errs IS NULL END AS schema_valid, "
            "CASE WHEN ex THEN errs END AS schema_errors, ex AND errs IS NULL AS is_open, "
            "CASE WHEN NOT ex THEN 'table not found' WHEN errs IS NOT NULL THEN 'schema: ' || errs END AS reason "
            "FROM g")


GATE_SQL = _gate_diff_sql()


@register("circuit_breaker_gate", GATE_SQL)
def circuit_breaker_gate(spark, sf_dir):
    return _gated_run(spark, sf_dir).gate


def _skipped_sql():
    parts = []
    for s in GATED:
        for c in s.checks:
            parts.append(f"SELECT {O.q(s.table_name)} AS table_name, {O.q(c.rule.validation_type)} AS validation_type, "
                         f"{O.q(c.rule.rule_name)} AS rule_name")
    rules = " UNION ALL ".join(parts)
    return (f"SELECT r.table_name, r.validation_type, r.rule_name, 'skipped' AS status, 'blocker' AS severity, "
            f"g.reason FROM ({rules}) r JOIN ({GATE_SQL}) g ON g.table_name = r.table_name WHERE NOT g.is_open")


@register("skipped_rules", _skipped_sql())
def skipped_rules(spark, sf_dir):
    return _gated_run(spark, sf_dir).skipped


@register("gated_suite_results",
          O.validation_results_sql([s for s in GATED if s.table_name in ("lineitem", "customer")]))
def gated_suite_results(spark, sf_dir):
    return _gated_run(spark, sf_dir).validation_results


POLICIES = {"lineitem": (True, True), "customer": (True, False), "orders": (True, True),
            "no_such_table": (False, True)}


def _stop_sql():
    vals = ", ".join(f"({O.q(t)}, {str(m).lower()}, {str(d).lower()})" for t, (m, d) in POLICIES.items())
    val = O.validation_results_sql([s for s in GATED if s.table_name in ("lineitem", "customer")])
    return (f"WITH p AS (SELECT * FROM (VALUES {vals}) AS p(table_name, ms, ds)), "
            f"g AS ({GATE_SQL}), v AS (SELECT table_name, bool_and(passed) AS data_passed FROM ({val}) GROUP BY 1) "
            "SELECT p.table_name, coalesce(g.is_open, false) AS metadata_passed, v.data_passed, "
            "CASE WHEN NOT coalesce(g.is_open, false) AND p.ms THEN 'stop' "
            "WHEN coalesce(g.is_open, false) AND NOT coalesce(v.data_passed, true) AND p.ds THEN 'stop' "
            "WHEN NOT coalesce(g.is_open, false) OR NOT coalesce(v.data_passed, true) THEN 'warn' "
            "ELSE 'continue' END AS decision "
            "FROM p LEFT JOIN g ON g.table_name = p.table_name LEFT JOIN v ON v.table_name = p.table_name")


@register("stop_decision", _stop_sql())
def stop_decision_q(spark, sf_dir):
    run = _gated_run(spark, sf_dir)
    pol = spark.createDataFrame([(t, m, d) for t, (m, d) in POLICIES.items()],
                                "table_name string, metadata_stop_on_failure boolean, data_stop_on_threshold boolean")
    return stop_decision(run.validation_results, run.gate, pol)


# -- R1..R10: reports ------------------------------------------------------------------


ALL_VALIDATION_SQL = O.validation_results_sql(list(ALL_SUITES))


def _all_results(spark, sf_dir):
    return multi_table_suite(spark, sf_dir)


@register("results_rollup",
          f"SELECT count(*) AS total_validations, CAST(count_if(coalesce(passed, false)) AS BIGINT) AS passed, "
          f"CAST(count(*) - count_if(coalesce(passed, false)) AS BIGINT) AS failed, "
          f"count(*) - count_if(coalesce(passed, false)) = 0 AS overall_passed FROM ({ALL_VALIDATION_SQL})")
def results_rollup(spark, sf_dir):
    return R.results_rollup(_all_results(spark, sf_dir))


@register("summary_overall",
          f"SELECT count(*) AS total_validations, CAST(count_if(coalesce(passed, false)) AS BIGINT) AS passed, "
          f"CAST(count_if(NOT coalesce(passed, false)) AS BIGINT) AS failed, "
          f"CAST(coalesce(sum(total_rows), 0) AS BIGINT) AS total_rows_validated, "
          f"CAST(coalesce(sum(total_violations), 0) AS BIGINT) AS total_violations, "
          f"array_to_string(list_sort(list(DISTINCT table_name)), ',') AS tables_validated, "
          f"CAST(count(DISTINCT table_name) AS INTEGER) AS tables_validated_count FROM ({ALL_VALIDATION_SQL})")
def summary_overall(spark, sf_dir):
    return R.summary_overall(_all_results(spark, sf_dir))


@register("summary_by_type",
          f"SELECT coalesce(validation_type, 'unknown') AS validation_type, count(*) AS count, "
          f"CAST(count_if(coalesce(passed, false)) AS BIGINT) AS passed, "
          f"CAST(count_if(NOT coalesce(passed, false)) AS BIGINT) AS failed "
          f"FROM ({ALL_VALIDATION_SQL}) GROUP BY 1")
def summary_by_type(spark, sf_dir):
    return R.summary_by_type(_all_results(spark, sf_dir))


@register("validation_summary",
          f"SELECT table_name, validation_type, passed, total_rows, total_violations, "
          f"coalesce(CAST(total_violations AS DOUBLE) / nullif(CAST(total_rows AS DOUBLE), 0) * 100.0, 0.0) "
          f"AS violations_per_row_pct, threshold * 100.0 AS threshold_pct, "
          f"CASE WHEN coalesce(passed, false) THEN 'normal' ELSE 'critical' END AS severity "
          f"FROM ({ALL_VALIDATION_SQL})")
def validation_summary(spark, sf_dir):
    return R.validation_summary(_all_results(spark, sf_dir))


@register("validation_details",
          "SELECT table_name, validation_type, string_agg(rule_name, ',' ORDER BY rule_name) AS rules_validated, "
          "coalesce(string_agg(CASE WHEN violations > 0 THEN rule_name || '=' || violations END, ',' "
          "ORDER BY rule_name), '') AS violations "
          f"FROM ({O.rule_results_sql(list(ALL_SUITES))}) GROUP BY table_name, validation_type")
def validation_details(spark, sf_dir):
    """The per-family detail of every suite, as text (names, and name=count
    for rules with violations)."""
    d = R.validation_details(_all_suites(spark, sf_dir)[0])
    pairs = F.transform(F.map_entries("violations"),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return d.select("table_name", "validation_type", F.array_join("rules_validated", ",").alias("rules_validated"),
                    F.array_join(pairs, ",").alias("violations"))


@register("alert_messages",
          "SELECT table_name, validation_type, 'alert' AS kind, printf('%s: %s check failed, "
          "%.2f%% of the tests violated where %.2f%% are allowed (%s violations); loads that depend on it should wait', "
          "table_name, validation_type, violation_percentage * 100.0, threshold * 100.0, "
          "format('{:,}', total_violations)) AS message "
          f"FROM ({ALL_VALIDATION_SQL}) WHERE NOT coalesce(passed, false) "
          "UNION ALL SELECT table_name, CAST(NULL AS VARCHAR), 'passed', printf('%s: nothing over its threshold, "
          "%s rows, %d checks', table_name, format('{:,}', max(total_rows)), count(*)) "
          f"FROM ({ALL_VALIDATION_SQL}) GROUP BY table_name HAVING bool_and(coalesce(passed, false))")
def alert_messages(spark, sf_dir):
    return R.alert_messages(_all_results(spark, sf_dir))


@register("results_as_json",
          "SELECT to_json({'table_name': table_name, 'validation_type': validation_type, 'total_rows': total_rows, "
          "'rules_configured': rules_configured, 'total_violations': total_violations, "
          "'violation_percentage': violation_percentage, 'threshold': threshold, 'passed': passed})::VARCHAR "
          f"AS json FROM ({ALL_VALIDATION_SQL})")
def results_as_json(spark, sf_dir):
    return R.results_as_json(_all_results(spark, sf_dir))


def _tag_sql(suite: Suite, keys: list[str]) -> str:
    whens = ", ".join(f"CASE WHEN {c.duck} THEN {O.q(c.rule.rule_name)} END" for c in suite.checks
                      if c.duck is not None and c.status == "evaluate")
    return (f"SELECT {', '.join(keys)}, concat_ws('|', {whens}) AS violated_rules "
            f"FROM {suite.source_sql} AS src WHERE concat_ws('|', {whens}) <> ''")


TAG_KEYS = ["l_orderkey", "l_linenumber"]


@register("row_violation_tags", _tag_sql(LINEITEM, TAG_KEYS))
def row_violation_tags(spark, sf_dir):
    df = lineitem_with_nulls(spark, sf_dir)
    return TG.failed_records(df, LINEITEM.table_rules(), sep="|").select(*TAG_KEYS, "violated_rules")


@register("failed_records_sample",
          f"SELECT * FROM ({_tag_sql(LINEITEM, TAG_KEYS)}) ORDER BY l_orderkey, l_linenumber LIMIT 100")
def failed_records_sample(spark, sf_dir):
    df = lineitem_with_nulls(spark, sf_dir)
    return (TG.failed_records_sample(df, LINEITEM.table_rules(), TAG_KEYS, 100, sep="|")
            .select(*TAG_KEYS, "violated_rules"))


def _per_rule_sql(suite: Suite, keys: list[str], n: int) -> str:
    arms = " UNION ALL ".join(
        f"SELECT {O.q(c.rule.validation_type)} AS validation_type, {O.q(c.rule.rule_name)} AS rule_name, "
        f"{', '.join(keys)} FROM {suite.source_sql} AS src WHERE {c.duck}"
        for c in suite.checks if c.duck is not None and c.status == "evaluate")
    return (f"SELECT * FROM (SELECT validation_type, rule_name, {', '.join(keys)}, CAST(row_number() OVER "
            f"(PARTITION BY validation_type, rule_name ORDER BY {', '.join(keys)}) AS INTEGER) AS rank "
            f"FROM ({arms})) WHERE rank <= {n}")


@register("failed_records_sample_per_rule", _per_rule_sql(LINEITEM, TAG_KEYS, 5))
def failed_records_sample_per_rule(spark, sf_dir):
    """The first five failing rows of every rule (a rule is its family and name)."""
    df = lineitem_with_nulls(spark, sf_dir)
    return TG.failed_records_sample_per_rule(df, LINEITEM.table_rules(), TAG_KEYS, 5)


@register("failed_records_count",
          f"SELECT (SELECT count(*) FROM lineitem) AS total_rows, "
          f"(SELECT count(*) FROM ({_tag_sql(LINEITEM, TAG_KEYS)})) AS failed_rows")
def failed_records_count(spark, sf_dir):
    return TG.failed_records_count(lineitem_with_nulls(spark, sf_dir), LINEITEM.table_rules())


def _windowed_sql(suite: Suite, ts: str, unit: str, threshold: float) -> str:
    """Validation rows per window, DuckDB side (date_trunc buckets)."""
    ev = [(i, c) for i, c in enumerate(suite.checks) if c.duck is not None and c.status == "evaluate"]
    counts = ", ".join(f"CAST(coalesce(count_if({c.duck}), 0) AS BIGINT) AS v{i}" for i, c in ev)
    fams: dict[str, list[int]] = {}
    for i, c in enumerate(suite.checks):
        fams.setdefault(c.rule.validation_type, []).append(i)
    parts = []
    for fam, idx in fams.items():
        tv = " + ".join(f"v{i}" if any(i == j for j, _ in ev) else "0" for i in idx)
        k = len(idx)
        rate = f"CASE WHEN ({tv}) > 0 THEN CAST(({tv}) AS DOUBLE) / CAST(total_rows * {k} AS DOUBLE) ELSE 0.0 END"
        parts.append(f"SELECT ws AS window_start, ws + INTERVAL 1 {unit} AS window_end, {O.q(suite.table_name)} "
                     f"AS table_name, {O.q(fam)} AS validation_type, total_rows, CAST({k} AS INTEGER) "
                     f"AS rules_configured, CAST(({tv}) AS BIGINT) AS total_violations, {rate} AS "
                     f"violation_percentage, CAST({threshold!r} AS DOUBLE) AS threshold, "
                     f"({rate}) <= {threshold!r} AS passed FROM c")
    return (f"WITH c AS (SELECT date_trunc('{unit}', {ts}) AS ws, count(*) AS total_rows, {counts} "
            f"FROM {suite.source_sql} AS src GROUP BY 1) " + " UNION ALL ".join(parts))


@register("hourly_validation", _windowed_sql(EVENTS, "ts", "hour", 0.10))
def hourly_validation(spark, sf_dir):
    return windowed_validation(table(spark, sf_dir, "events"), EVENTS.table_rules(), "ts", "1 hour")


@register("cumulative_validation", O.validation_results_sql([EVENTS]))
def cumulative_validation(spark, sf_dir):
    """Hourly results stored once, then rolled up into the table's verdict: equal
    to validating the whole table, without a second scan of it."""
    path = scratch_path(spark, "hourly_history")
    hourly = windowed_validation(table(spark, sf_dir, "events"), EVENTS.table_rules(), "ts", "1 hour")
    hourly.write.mode("overwrite").parquet(path)
    return R.cumulative_results(spark.read.parquet(path))


TREND_RETENTION_DAYS = 20


@register("results_trend",
          f"WITH h AS (SELECT window_start AS run_ts, * EXCLUDE (window_start, window_end) "
          f"FROM ({_windowed_sql(EVENTS, 'ts', 'day', 0.10)})), "
          f"k AS (SELECT * FROM h WHERE run_ts >= (SELECT max(run_ts) FROM h) - INTERVAL {TREND_RETENTION_DAYS} DAY) "
          f"SELECT run_ts, table_name, validation_type, total_rows, total_violations, violation_percentage, passed, "
          f"lag(violation_percentage) OVER w AS previous_percentage, "
          f"violation_percentage - lag(violation_percentage) OVER w AS change, "
          f"lag(passed) OVER w AS previous_passed FROM k "
          f"WINDOW w AS (PARTITION BY table_name, validation_type ORDER BY run_ts)")
def results_trend(spark, sf_dir):
    daily = windowed_validation(table(spark, sf_dir, "events"), EVENTS.table_rules(), "ts", "1 day")
    history = daily.withColumnRenamed("window_start", "run_ts").drop("window_end")
    return R.results_trend(history, "run_ts", TREND_RETENTION_DAYS)


# -- U1..U7, S5, S6, K3: documents and files ------------------------------------------


KEY_SETS = (("required_k", ["k"]), ("required_k_z", ["k", "z"]))


def _duck_doc_invalid(col, keys):
    lst = "[" + ", ".join(O.q(k) for k in keys) + "]"
    return (f"NOT coalesce(CASE WHEN json_valid({col}) AND json_type({col}) = 'OBJECT' "
            f"THEN list_has_all(json_keys({col}), {lst}) END, false)")


def _duck_rate(total, bad, t):
    return (f"coalesce(CAST({bad} AS DOUBLE) / nullif(CAST({total} AS DOUBLE), 0), 0.0) AS violation_percentage, "
            f"CAST({t!r} AS DOUBLE) AS threshold, "
            f"coalesce(CAST({bad} AS DOUBLE) / nullif(CAST({total} AS DOUBLE), 0), 0.0) <= {t!r} AS passed")


@register("json_required_keys", " UNION ALL ".join(
    f"SELECT 'events' AS table_name, {O.q(n)} AS check_name, total_files, violations, "
    f"{_duck_rate('total_files', 'violations', 0.10)} FROM (SELECT count(*) AS total_files, "
    f"CAST(count_if({_duck_doc_invalid('props', ks)}) AS BIGINT) AS violations FROM events)"
    for n, ks in KEY_SETS))
def json_required_keys(spark, sf_dir):
    return FC.required_keys_checks(table(spark, sf_dir, "events"), "props", dict(KEY_SETS), "events")


@register("json_invalid_details",
          f"SELECT event_id, 'z' AS missing_keys, 'missing keys' AS error FROM events "
          f"WHERE {_duck_doc_invalid('props', ['k', 'z'])} ORDER BY event_id LIMIT 10")
def json_invalid_details(spark, sf_dir):
    return FC.invalid_document_details(table(spark, sf_dir, "events"), "props", ["k", "z"], ["event_id"], 10)


PAGE_EXT = [".html", ".htm"]
PAGE_SIZE = (1024, 20000)
_DUCK_EXT = "lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '(\\.[^./]+)$', 1))"


@register("file_extension_check",
          f"SELECT 'pages' AS table_name, 'file_extension' AS check_name, total_files, violations, "
          f"{_duck_rate('total_files', 'violations', 0.0)} FROM (SELECT count(*) AS total_files, "
          f"CAST(count_if({_DUCK_EXT} NOT IN ({_in_list(PAGE_EXT)})) AS BIGINT) AS violations FROM pages)")
def file_extension_check(spark, sf_dir):
    return FC.extension_check(table(spark, sf_dir, "pages"), F.col("url"), PAGE_EXT, "pages")


@register("file_size_check",
          f"SELECT 'pages' AS table_name, 'file_size' AS check_name, total_files, violations, "
          f"{_duck_rate('total_files', 'violations', 0.0)} FROM (SELECT count(*) AS total_files, "
          f"CAST(count_if(strlen(html) < {PAGE_SIZE[0]} OR strlen(html) > {PAGE_SIZE[1]}) AS BIGINT) "
          f"AS violations FROM pages)")
def file_size_check(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return FC.bound_check(p, F.octet_length("html"), *PAGE_SIZE, "pages", "file_size")


PAGE_REQUIRED = ["page_id", "file_path", "file_size", "image_format"]


@register("file_metadata_check",
          "SELECT total_files, 'image_format' AS missing_keys, size_violations, extension_violations, errors, "
          "errors = '' AS passed FROM (SELECT *, concat_ws('; ', 'metadata lacks image_format', "
          "CASE WHEN size_violations > 0 THEN 'size out of bounds: ' || size_violations END, "
          "CASE WHEN extension_violations > 0 THEN 'extension not allowed: ' || extension_violations END"
          ") AS errors FROM (SELECT count(*) AS total_files, "
          f"CAST(count_if(strlen(html) < {PAGE_SIZE[0]} OR strlen(html) > {PAGE_SIZE[1]}) AS BIGINT) AS size_violations, "
          f"CAST(count_if({_DUCK_EXT} NOT IN ({_in_list(PAGE_EXT)})) AS BIGINT) AS extension_violations FROM pages))")
def file_metadata_check(spark, sf_dir):
    meta = table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("file_path"), F.octet_length("html").alias("file_size"))
    return FC.validate_file_metadata(meta, PAGE_REQUIRED, *PAGE_SIZE, PAGE_EXT)


# Event documents derived from the events table: error events carry only their
# id (the faulty documents); the others carry every required key.  The JSON
# writer drops NULL fields, which removes the keys of the faulty documents.
EVENT_DOC_KEYS = ["event_id", "event_type", "event_time", "user_id", "payload"]


def event_documents(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    ok = F.col("event_type") != "error"
    return ev.select(
        "event_id",
        F.when(ok, F.col("event_type")).alias("event_type"),
        F.when(ok, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("event_time"),
        F.when(ok, F.col("user_id")).alias("user_id"),
        F.when(ok, F.from_json("props", "k bigint")).alias("payload"))


_WRITTEN: dict[tuple[str, str], str] = {}


def _event_json_dir(spark, sf_dir):
    """The event documents as JSON Lines, written once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        d = scratch_path(spark, "event_logs")
        FS.write_json_documents(event_documents(spark, sf_dir), d)
        _WRITTEN[key] = d
    return _WRITTEN[key]


def _event_docs(spark, sf_dir):
    return FS.scan_json_files(spark, _event_json_dir(spark, sf_dir), "*.json", mode="lines")


@register("json_dir_scan",
          "SELECT event_id, true AS valid_json, CASE WHEN event_type = 'error' THEN "
          f"{O.q(','.join(EVENT_DOC_KEYS[1:]))} ELSE '' END AS missing_keys, "
          "event_type <> 'error' AS is_valid FROM events")
def json_dir_scan(spark, sf_dir):
    docs = FC.document_status(_event_docs(spark, sf_dir), "value", EVENT_DOC_KEYS)
    return docs.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
                       "valid_json", F.array_join("missing_keys", ",").alias("missing_keys"), "is_valid")


@register("json_dir_required_keys",
          "SELECT 'event_logs' AS table_name, 'required_keys' AS check_name, total_files, violations, "
          f"{_duck_rate('total_files', 'violations', 0.10)} FROM (SELECT count(*) AS total_files, "
          "CAST(count_if(event_type = 'error') AS BIGINT) AS violations FROM events)")
def json_dir_required_keys(spark, sf_dir):
    return FC.required_keys_check(_event_docs(spark, sf_dir), "value", EVENT_DOC_KEYS, "event_logs")


@register("stream_json_required_keys",
          "SELECT 'event_logs' AS table_name, 'required_keys' AS check_name, total_files, violations, "
          f"{_duck_rate('total_files', 'violations', 0.10)}, CAST(0 AS BIGINT) AS batch_id "
          "FROM (SELECT count(*) AS total_files, CAST(count_if(event_type = 'error') AS BIGINT) AS violations "
          "FROM events)")
def stream_json_required_keys(spark, sf_dir):
    """The event documents checked by a file stream: each file is seen once."""
    from ..streaming.documents import stream_required_keys
    return stream_required_keys(spark, _event_json_dir(spark, sf_dir), {"required_keys": EVENT_DOC_KEYS},
                                "event_logs", mode="lines")


PAGE_DOC_KEYS = ["page_id", "url", "n_bytes"]


def _page_docs_dir(spark, sf_dir):
    """One JSON file per page, over sub-folders; pages served over plain http lose their url key."""
    p = table(spark, sf_dir, "pages")
    docs = p.select("page_id", F.when(~F.col("url").startswith("http://"), F.col("url")).alias("url"),
                    F.octet_length("html").alias("n_bytes"))
    d = scratch_path(spark, "page_docs")
    FS.write_json_documents(docs, d, one_per_file=True, folders=True)
    return d


@register("json_file_documents",
          "SELECT 'page_docs' AS table_name, 'required_keys' AS check_name, total_files, violations, "
          f"{_duck_rate('total_files', 'violations', 0.10)} FROM (SELECT count(*) AS total_files, "
          "CAST(count_if(starts_with(url, 'http://')) AS BIGINT) AS violations FROM pages)")
def json_file_documents(spark, sf_dir):
    docs = FS.scan_json_files(spark, _page_docs_dir(spark, sf_dir), "*.json", mode="document", recursive=True)
    return FC.required_keys_check(docs, "value", PAGE_DOC_KEYS, "page_docs")


# -- K1, K2, K4, D1..D4: sinks and generated data ------------------------------------


ROUNDTRIP_SQL = ("SELECT o_orderstatus, count(*) AS orders, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key "
                 "FROM orders GROUP BY o_orderstatus")


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("min_key"),
                                           F.max("o_orderkey").alias("max_key"))


@register("create_table_roundtrip", ROUNDTRIP_SQL)
def create_table_roundtrip(spark, sf_dir):
    name = f"tablecheck_rt.orders_{_uuid.uuid4().hex[:10]}"
    create_table(spark, name, table(spark, sf_dir, "orders"), partition_cols=["o_orderstatus"],
                 location=scratch_path(spark, "create_roundtrip"),
                 namespace_location=scratch_path(spark, "tablecheck_rt.db", unique=False))
    return _by_status(spark.table(name))


@register("append_table_roundtrip", ROUNDTRIP_SQL)
def append_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "append_roundtrip")
    orders = table(spark, sf_dir, "orders")
    create_table(spark, path, orders.filter("o_orderstatus = 'F'"))
    append_table(spark, path, orders.filter("o_orderstatus <> 'F'"))
    return _by_status(spark.read.parquet(path))


@register("results_sink", ALL_VALIDATION_SQL)
def results_sink(spark, sf_dir):
    path = scratch_path(spark, "results")
    results = _all_results(spark, sf_dir)
    SK.write_results(results, path, "run-1")
    SK.write_results(results, path, "run-1")  # a retried run replaces its partition
    return SK.read_results(spark, path, "run-1").drop("run_id", "run_ts", "run_date")


SYNTH_AS_OF = "2024-02-01 00:00:00"


# -- T1..T4: streaming -----------------------------------------------------------------


@register("stream_hourly_validation", _windowed_sql(EVENTS, "ts", "hour", 0.10))
def stream_hourly_validation(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return ST.stream_windowed_validation(spark, sf_dir, schema, EVENTS.table_rules(), "ts",
                                         glob="events.parquet", output_mode="complete")


@register("stream_batch_suite",
          f"SELECT *, CAST(0 AS BIGINT) AS batch_id FROM ({O.validation_results_sql([EVENTS])})")
def stream_batch_suite(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return ST.stream_batch_suite(spark, sf_dir, schema, EVENTS.table_rules(), glob="events.parquet")


# -- whole-registry runs and annotations (G4, R9) ------------------------------------


def suite_block(suite: Suite) -> dict:
    """A registry ``validations`` block holding the suite's rules."""
    b: dict = {"not_null": {"columns": []}, "range": {}, "regex": {}, "cross_column": []}
    for c in suite.checks:
        r = c.rule
        if r.validation_type == "not_null":
            b["not_null"]["columns"].append(r.column)
        elif r.validation_type == "range":
            b["range"][r.column] = {k: v for k, v in (("min", r.min), ("max", r.max)) if v is not None}
        elif r.validation_type == "regex":
            b["regex"][r.column] = r.pattern
        else:
            b["cross_column"].append({"name": r.rule_name, "expression": r.expression,
                                      "description": r.description})
    return b


LINEITEM_PLAIN = Suite("lineitem", LINEITEM.checks)
ORDERS_REG = Suite("orders", ORDERS_SUITE.checks)


def _structured(suite: Suite, schema, ts=None, threshold=0.10):
    return {"type": "structured", "format": "parquet", "namespace": "tpch", "incremental": ts is not None,
            "timestamp_column": ts, "schema": schema,
            "validations": {"schema_check": {"enabled": True, "strict_mode": True}, **suite_block(suite)},
            "quality_threshold": threshold,
            "circuit_breaker": {"metadata_stop_on_failure": True, "data_stop_on_threshold": True}}


TESTDATA_REGISTRY = {"tables": {
    "lineitem": _structured(LINEITEM_PLAIN, {
        "l_orderkey": "long", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
        "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp", "l_partkey": "long",
        "l_suppkey": "long", "l_linenumber": "integer", "l_tax": "double"}, "l_shipdate", 0.05),
    "customer": _structured(CUSTOMER, EXPECTED["customer"], None, 0.15),
    "events": _structured(EVENTS, {"event_id": "long", "ts": "timestamp", "user_id": "long",
                                   "event_type": "string", "value": "double", "props": "string"}, "ts"),
    "orders": _structured(ORDERS_REG, {c: "string" for c in GATE_COLUMNS["orders"]}),
    "event_logs": {"type": "unstructured", "format": "json", "layout": "lines", "namespace": "raw",
                   "incremental": False,
                   "validations": {"metadata_keys": {"required": EVENT_DOC_KEYS}},
                   "quality_threshold": 0.10,
                   "circuit_breaker": {"metadata_stop_on_failure": True, "data_stop_on_threshold": False}},
}}
REG_THRESHOLDS = {"lineitem": 0.05, "customer": 0.15, "events": 0.10}


def _registry_locations(spark, sf_dir):
    loc = {t: f"{sf_dir}/{t}.parquet" for t in ("lineitem", "customer", "events", "orders")}
    loc["event_logs"] = _event_json_dir(spark, sf_dir)
    return loc


def _event_logs_sql(where=None):
    w = f" WHERE {where}" if where else ""
    return ("SELECT 'event_logs' AS table_name, 'required_keys' AS validation_type, total_rows, "
            "CAST(1 AS INTEGER) AS rules_configured, total_violations, "
            f"{_duck_rate('total_rows', 'total_violations', 0.10)} FROM (SELECT count(*) AS total_rows, "
            f"CAST(count_if(event_type = 'error') AS BIGINT) AS total_violations FROM events{w})")


@register("registry_suite",
          O.validation_results_sql([LINEITEM_PLAIN, CUSTOMER, EVENTS], REG_THRESHOLDS)
          + " UNION ALL " + _event_logs_sql())
def registry_suite(spark, sf_dir):
    run = run_registry(spark, Registry(TESTDATA_REGISTRY), _registry_locations(spark, sf_dir))
    return run.validation_results


REG_INTERVAL = ("2024-01-15 00:00:00", "2024-01-16 00:00:00")
_EV_WHERE = f"ts >= TIMESTAMP '{REG_INTERVAL[0]}' AND ts < TIMESTAMP '{REG_INTERVAL[1]}'"
_LI_WHERE = f"l_shipdate >= TIMESTAMP '{REG_INTERVAL[0]}' AND l_shipdate < TIMESTAMP '{REG_INTERVAL[1]}'"


@register("registry_incremental",
          O.validation_results_sql([LINEITEM_PLAIN], REG_THRESHOLDS, where=_LI_WHERE)
          + " UNION ALL " + O.validation_results_sql([CUSTOMER], REG_THRESHOLDS)
          + " UNION ALL " + O.validation_results_sql([EVENTS], REG_THRESHOLDS, where=_EV_WHERE)
          + " UNION ALL " + _event_logs_sql())
def registry_incremental(spark, sf_dir):
    run = run_registry(spark, Registry(TESTDATA_REGISTRY), _registry_locations(spark, sf_dir),
                       interval=REG_INTERVAL)
    return run.validation_results


ENV_TAGS = {"environment": "test", "runner": "spark"}
_TABLE_META = {"lineitem": ("structured", "tpch", True), "customer": ("structured", "tpch", False),
               "events": ("structured", "tpch", True), "orders": ("structured", "tpch", False),
               "event_logs": ("unstructured", "raw", False)}


@register("annotated_results",
          "SELECT r.*, m.table_type, m.namespace, m.incremental, "
          "'{\"environment\":\"test\",\"runner\":\"spark\"}' AS tags FROM ("
          + O.validation_results_sql([LINEITEM_PLAIN, CUSTOMER, EVENTS], REG_THRESHOLDS)
          + " UNION ALL " + _event_logs_sql() + ") r LEFT JOIN (VALUES "
          + ", ".join(f"({O.q(t)}, {O.q(a)}, {O.q(b)}, {str(c).lower()})" for t, (a, b, c) in _TABLE_META.items())
          + ") AS m(table_name, table_type, namespace, incremental) ON m.table_name = r.table_name")
def annotated_results(spark, sf_dir):
    reg = Registry(TESTDATA_REGISTRY)
    run = run_registry(spark, reg, _registry_locations(spark, sf_dir))
    out = annotate_results(run.validation_results, reg.tables_df(spark), ENV_TAGS)
    return out.withColumn("tags", F.to_json("tags"))


RUNTIME_BAD = Suite("events", (
    Check(expression("errors_are_small", "event_type <> 'error' OR value < 100"),
          "NOT (event_type <> 'error' OR value < 100)"),
    Check(expression("raises_on_first_event", "CASE WHEN event_id = 0 THEN raise_error('boom') ELSE true END"),
          None, status="error", error="USER_RAISED_EXCEPTION"),
    Check(in_range("value", 1, 200), "value < 1 OR value > 200"),
))


@register("cross_column_runtime_error", O.rule_results_sql([RUNTIME_BAD]))
def cross_column_runtime_error(spark, sf_dir):
    """A rule that fails while running is isolated; the others keep their counts."""
    return fused(spark, sf_dir, RUNTIME_BAD, on_error="ignore").materialize().rule_results()


@register("stream_hourly_validation_append",
          _windowed_sql(EVENTS, "ts", "hour", 0.10))
def stream_hourly_validation_append(spark, sf_dir):
    """Continuous form: append mode emits a window once the watermark passes it,
    so state stays bounded; the windows still open at the end are added as they stand."""
    ev = table(spark, sf_dir, "events")
    emitted = ST.stream_windowed_validation(spark, sf_dir, ev.schema, EVENTS.table_rules(), "ts",
                                            glob="events.parquet", output_mode="append")
    return ST.with_open_windows(emitted, ev, EVENTS.table_rules(), "ts")


def _typed_diffs_sql(expected: dict) -> str:
    """Schema differences (missing / extra / loose type mismatch) in DuckDB, for
    expected schemas given as {column: type} or as a list of names."""
    rows = []
    for t, cols in expected.items():
        items = cols.items() if isinstance(cols, dict) else [(c, None) for c in cols]
        for c, ty in items:
            rows.append(f"({O.q(t)}, {O.q(c)}, {O.q(ty)})")
    tables = _in_list(expected)
    return (f"WITH e AS (SELECT * FROM (VALUES {', '.join(rows)}) AS e(table_name, column_name, expected_type)), "
            f"a AS (SELECT * FROM {DUCK_COLUMNS} WHERE table_name IN ({tables})) "
            "SELECT e.table_name, 'missing' AS kind, e.column_name FROM e LEFT JOIN a "
            "ON e.table_name = a.table_name AND e.column_name = a.column_name WHERE a.column_name IS NULL "
            "UNION ALL SELECT a.table_name, 'extra', a.column_name FROM a LEFT JOIN e "
            "ON e.table_name = a.table_name AND e.column_name = a.column_name WHERE e.column_name IS NULL "
            "UNION ALL SELECT e.table_name, 'type_mismatch', e.column_name FROM e JOIN a "
            "ON e.table_name = a.table_name AND e.column_name = a.column_name "
            f"WHERE e.expected_type IS NOT NULL AND NOT {LOOSE_OK}")


def _registry_gate_sql() -> str:
    structured = {n: c["schema"] for n, c in TESTDATA_REGISTRY["tables"].items() if c["type"] == "structured"}
    names = ", ".join(f"({O.q(n)})" for n in structured)
    return (f"WITH d AS ({_typed_diffs_sql(structured)}), t AS (SELECT * FROM (VALUES {names}) AS t(table_name)), "
            "g AS (SELECT t.table_name, string_agg(d.kind || ' ' || d.column_name, '; ' "
            "ORDER BY d.kind, d.column_name) AS errs FROM t LEFT JOIN d ON d.table_name = t.table_name "
            "GROUP BY t.table_name) "
            "SELECT table_name, (SELECT count(*) FROM information_schema.tables i "
            "WHERE i.table_name = g.table_name) > 0 AS \"exists\", errs IS NULL AS is_open, "
            "CASE WHEN errs IS NOT NULL THEN 'schema: ' || errs END AS reason FROM g "
            "UNION ALL SELECT 'event_logs', true, true, CAST(NULL AS VARCHAR)")


@register("registry_gate", _registry_gate_sql())
def registry_gate(spark, sf_dir):
    """Gates of a whole registry run: tables (existence, schema) and file sets (directory)."""
    run = run_registry(spark, Registry(TESTDATA_REGISTRY), _registry_locations(spark, sf_dir))
    tables = run.suite.gate.select("table_name", "exists", "is_open", "reason")
    return tables.unionByName(run.file_gate)


# -- S7, C1-C3: the registry against the actual tables -------------------------------

def _reg_structured_sources(sf_dir):
    reg = Registry(TESTDATA_REGISTRY)
    return reg, {n: f"{sf_dir}/{n}.parquet" for n in reg.get_structured_tables()}


def _rule_rows_sql():
    """The registry document's rules as literals, read from the document itself."""
    def row(table_name, family, name, column=None, lo=None, hi=None, pattern=None, expr=None, description=""):
        number = lambda x: "CAST(NULL AS DOUBLE)" if x is None else f"CAST({x!r} AS DOUBLE)"
        return (f"({O.q(table_name)}, {O.q(family)}, {O.q(name)}, {O.q(column)}, {number(lo)}, {number(hi)}, {O.q(None)}, {O.q(None)}, "
                f"{O.q(pattern)}, {O.q(expr)}, {O.q(description)})")

    rows = []
    for name, conf in TESTDATA_REGISTRY["tables"].items():
        v = conf["validations"]
        rows += [row(name, "not_null", c, c) for c in v.get("not_null", {}).get("columns", [])]
        rows += [row(name, "range", c, c, b.get("min"), b.get("max")) for c, b in v.get("range", {}).items()]
        rows += [row(name, "regex", c, c, pattern=p) for c, p in v.get("regex", {}).items()]
        rows += [row(name, "cross_column", r["name"], expr=r["expression"], description=r["description"]) for r in v.get("cross_column", [])]
    return ("(VALUES " + ", ".join(rows) + ") AS r(table_name, validation_type, rule_name, \"column\", "
            "\"min\", \"max\", min_text, max_text, pattern, expression, description)")


@register("rules_table",
          f"SELECT r.*, c.data_type AS column_type FROM {_rule_rows_sql()} "
          f"LEFT JOIN {DUCK_COLUMNS} c ON c.table_name = r.table_name AND c.column_name = r.\"column\"")
def rules_table(spark, sf_dir):
    """Configured rules with the actual type of the column each names (NULL when absent)."""
    reg, sources = _reg_structured_sources(sf_dir)
    schemas = union_all([S.table_schema(spark, src, n) for n, src in sources.items()])
    cols = schemas.select("table_name", F.col("column_name").alias("column"), F.col("data_type").alias("column_type"))
    return reg.rules_df(spark).join(cols, ["table_name", "column"], "left")


def _tables_sql(where=""):
    rows = []
    for n, c in TESTDATA_REGISTRY["tables"].items():
        cb = c.get("circuit_breaker", {})
        ts = c.get("timestamp_column")
        rows.append(f"({O.q(n)}, {O.q(c.get('type'))}, {O.q(c.get('format'))}, {O.q(c.get('namespace'))}, "
                    f"{str(bool(c.get('incremental'))).lower()}, {O.q(ts)}, "
                    f"CAST({float(c.get('quality_threshold', 0.1))!r} AS DOUBLE), "
                    f"{str(bool(cb.get('metadata_stop_on_failure', True))).lower()}, "
                    f"{str(bool(cb.get('data_stop_on_threshold', True))).lower()})")
    counts = " UNION ALL ".join(f"SELECT {O.q(n)} AS table_name, count(*) AS row_count FROM {n}"
                                for n, c in TESTDATA_REGISTRY["tables"].items() if c.get("type") == "structured")
    return (f"SELECT t.*, k.row_count FROM (VALUES {', '.join(rows)}) AS t(table_name, table_type, format, "
            "namespace, incremental, timestamp_column, threshold, metadata_stop_on_failure, data_stop_on_threshold) "
            f"LEFT JOIN ({counts}) k ON k.table_name = t.table_name {where}")


def _tables_with_counts(spark, sf_dir):
    reg, sources = _reg_structured_sources(sf_dir)
    counts = union_all([S.row_count(table(spark, sf_dir, n), n).drop("error") for n in sources])
    return reg, reg.tables_df(spark).join(counts, "table_name", "left")


@register("tables_table", _tables_sql())
def tables_table(spark, sf_dir):
    """Registry tables with their actual row counts (structured ones)."""
    return _tables_with_counts(spark, sf_dir)[1]


@register("tables_by_type", _tables_sql("WHERE t.table_type = 'structured'"))
def tables_by_type(spark, sf_dir):
    return _tables_with_counts(spark, sf_dir)[1].filter("table_type = 'structured'")


from . import registered_edges  # noqa: E402,F401 - registers its queries here
from . import registered_history  # noqa: E402,F401 - registers its queries here
