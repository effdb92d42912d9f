"""Command line: seed example data, or run a registry and record the results.

    python -m tablecheck seed --root DIR [--mode initial|append] [--num-transactions N]
                              [--num-users N] [--num-logs N] [--start-time TS] [--end-time TS]
    python -m tablecheck run --registry FILE --location NAME=PATH [--location ...]
                             [--interval START END] [--threshold T] [--results DIR --run-id ID]
                             [--state DIR]
    python -m tablecheck report --results DIR [--registry FILE] [--retention-days N] [--cumulative]

``run`` prints one line per validation and table decision and exits with
status 1 when a table's stop policy applies (2 on usage errors); failures
whose policy is only to warn are printed as such.  The threshold defaults to
``DQ_THRESHOLD``.  The interval defaults to
``DATA_INTERVAL_START``/``DATA_INTERVAL_END`` when both are set; without them
``--last-hour`` takes the last hour, and else incremental tables are validated
whole.  Under
``spark-submit`` the session comes from the submit configuration.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    return SparkSession.builder.appName("tablecheck").getOrCreate()


def _seed(args) -> int:
    from .sources.synth import seed_tables

    spark = _session()
    paths = seed_tables(spark, args.root, args.mode, args.num_transactions, args.num_users, args.num_logs,
                        args.start_time, args.end_time, batch=args.batch)
    print(json.dumps(paths))
    return 0


def _run(args) -> int:
    from .operators.gate import stop_decision
    from .plans.registry import Registry, UnknownTableError
    from .plans.registry_run import run_registry
    from .sources.tables import default_interval
    from .sources.sinks import read_results, write_results

    registry = Registry.load(args.registry)
    threshold = args.threshold
    if threshold is None and os.environ.get("DQ_THRESHOLD"):
        threshold = float(os.environ["DQ_THRESHOLD"])
    if threshold is not None:
        for conf in registry.document.get("tables", {}).values():
            conf["quality_threshold"] = threshold
    locations = dict(kv.split("=", 1) for kv in args.location)
    interval = tuple(args.interval) if args.interval else None
    if interval is None and os.environ.get("DATA_INTERVAL_START") and os.environ.get("DATA_INTERVAL_END"):
        interval = (os.environ["DATA_INTERVAL_START"], os.environ["DATA_INTERVAL_END"])
    if interval is None and args.last_hour:
        interval = default_interval({})
    spark = _session()
    try:
        run = run_registry(spark, registry, locations, interval, state_dir=args.state)
    except UnknownTableError as e:
        print(e, file=sys.stderr)
        return 2
    results = run.validation_results
    if args.results:
        if not args.run_id:
            print("--results needs --run-id", file=sys.stderr)
            return 2
        # the interval start is the run's logical time: a retry lands in the same partition
        write_results(results, args.results, args.run_id, run_ts=interval[0] if interval else None)
        results = read_results(spark, args.results, args.run_id)
    rows = results.orderBy("table_name", "validation_type").collect()  # one row per table and family
    gates = run.suite.gate.collect() + run.file_gate.collect()
    for g in gates:
        if not g["is_open"]:
            print(f"SKIPPED {g['table_name']}: {g['reason']}")
    for r in rows:
        rate = "no rate" if r["violation_percentage"] is None else f"{r['violation_percentage']:.2%}"
        print(f"{'PASSED' if r['passed'] else 'FAILED'} {r['table_name']} {r['validation_type']}: "
              f"{r['total_violations']} violations in {r['total_rows']} rows ({rate} vs {r['threshold']:.2%})")
    # decided on the rows just read: a file-stream run must not be evaluated twice
    found = spark.createDataFrame([(r["table_name"], r["passed"]) for r in rows], "table_name string, passed boolean")
    opened = spark.createDataFrame([(g["table_name"], g["is_open"]) for g in gates], "table_name string, is_open boolean")
    policies = registry.tables_df(spark).select("table_name", "metadata_stop_on_failure", "data_stop_on_threshold")
    stop = 0
    for d in stop_decision(found, opened, policies).orderBy("table_name").collect():  # one row per table
        stop += d["decision"] == "stop"
        if d["decision"] != "continue":
            print(f"{d['decision'].upper()} {d['table_name']}")
    return 1 if stop else 0


def _report(args) -> int:
    from .operators import report as R
    from .plans.registry import Registry

    retention = args.retention_days
    if retention is None and args.registry:
        retention = Registry.load(args.registry).get_global_settings().get("reporting", {}) \
            .get("history_retention_days")
    spark = _session()
    history = spark.read.parquet(args.results)
    overall = R.summary_overall(history).first().asDict()
    print(json.dumps({"overall": overall}, default=str))
    for r in R.summary_by_type(history).orderBy("validation_type").collect():
        print(json.dumps({"by_type": r.asDict()}, default=str))
    from pyspark.sql import functions as F

    trend = R.results_trend(history, "run_ts", retention)
    latest = trend.filter(F.col("run_ts") == history.select(F.max("run_ts")).scalar())
    for r in latest.orderBy("table_name", "validation_type").collect():  # one row per table and family
        print(json.dumps({"trend": r.asDict()}, default=str))
    if args.cumulative:
        # runs over disjoint intervals add up to the verdict over all of them
        for r in R.cumulative_results(history).orderBy("table_name", "validation_type").collect():
            print(json.dumps({"cumulative": r.asDict()}, default=str))
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="tablecheck")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("seed", help="generate example data with injected faults")
    s.add_argument("--root", required=True)
    s.add_argument("--mode", choices=["initial", "append"], default="initial")
    s.add_argument("--num-transactions", type=int)
    s.add_argument("--num-users", type=int)
    s.add_argument("--num-logs", type=int)
    s.add_argument("--start-time")
    s.add_argument("--end-time")
    s.add_argument("--batch", type=int, default=0, help="salt for appended batches")
    r = sub.add_parser("run", help="run a registry against tables and file sets")
    r.add_argument("--registry", required=True)
    r.add_argument("--location", action="append", default=[], help="NAME=PATH or NAME=catalog.table")
    r.add_argument("--interval", nargs=2, metavar=("START", "END"))
    r.add_argument("--last-hour", action="store_true", help="without an interval, take the last hour")
    r.add_argument("--threshold", type=float)
    r.add_argument("--results")
    r.add_argument("--run-id")
    r.add_argument("--state", help="folder for file-stream state: incremental JSON sets check new files only")
    rp = sub.add_parser("report", help="summaries and run-over-run trend of stored results")
    rp.add_argument("--results", required=True)
    rp.add_argument("--registry")
    rp.add_argument("--retention-days", type=int)
    rp.add_argument("--cumulative", action="store_true",
                    help="verdicts over all stored runs (for runs over disjoint intervals)")
    args = p.parse_args(argv)
    return {"seed": _seed, "run": _run, "report": _report}[args.command](args)


if __name__ == "__main__":
    sys.exit(main())
