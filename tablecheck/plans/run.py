"""Suite runner: metadata -> gate -> fused data checks, for many tables at once.

All tables' data plans are unioned into one lazy DataFrame, so one action
runs every table's scan as concurrent branches of a single job (one fused
aggregation per table).  Closed tables contribute only literal ``skipped``
rows and are never scanned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gate import GateState, TableSpec, _map_threads, evaluate_gates, gate_frame
from ..operators.validate import (RULE_RESULT_SCHEMA, VALIDATION_RESULT_SCHEMA, FusedCheck)
from ..rules import TableRules

SKIPPED_DDL = ("table_name string, validation_type string, rule_name string, status string, "
               "severity string, reason string")


@dataclass
class SuiteRun:
    """A gated run; each result frame is planned when it is first asked for."""

    gate: DataFrame
    checks: list[FusedCheck]
    skipped: DataFrame
    states: list[GateState]
    max_workers: int = 8

    @cached_property
    def rule_results(self) -> DataFrame:
        spark = self.skipped.sparkSession
        rows = _map_threads(lambda c: c.rule_results(), self.checks, self.max_workers)
        skipped = self.skipped.select(
            "table_name", "validation_type", "rule_name",
            F.lit(None).cast("bigint").alias("total_rows"), F.lit(None).cast("bigint").alias("violations"),
            "status", F.col("reason").alias("error"))
        return _union(rows, spark.createDataFrame([], RULE_RESULT_SCHEMA)).unionByName(skipped)

    @cached_property
    def validation_results(self) -> DataFrame:
        spark = self.skipped.sparkSession
        rows = _map_threads(lambda c: c.validation_results(), self.checks, self.max_workers)
        return _union(rows, spark.createDataFrame([], VALIDATION_RESULT_SCHEMA))


def _union(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    """Balanced union tree (O(n log n) analysis for n tables)."""
    frames = list(frames) or [empty]
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]


def validate_many(checks: Sequence[tuple[DataFrame, TableRules]], on_error: str = "fail",
                  max_workers: int = 8) -> tuple[DataFrame, DataFrame]:
    """Fused checks of many (DataFrame, rules) pairs, planned on driver threads
    and unioned: ``(rule_results, validation_results)`` as two lazy frames."""
    def build(pair):
        check = FusedCheck(pair[0], pair[1], on_error)
        return check.rule_results(), check.validation_results()  # lazy frames over one aggregate

    built = _map_threads(build, checks, max_workers)
    spark = checks[0][0].sparkSession if checks else None
    if spark is None:
        raise ValueError("no tables to validate")
    return (_union([r for r, _ in built], spark.createDataFrame([], RULE_RESULT_SCHEMA)),
            _union([v for _, v in built], spark.createDataFrame([], VALIDATION_RESULT_SCHEMA)))


def run_suite(spark: SparkSession, tables: Sequence[tuple[TableSpec, TableRules]],
              prepare: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
              on_error: str = "fail", isolate_tables: bool = False, max_workers: int = 8) -> SuiteRun:
    """Run the gated suite.

    ``prepare[table_name]`` may transform a table before its checks (an
    incremental slice, derived columns).

    By default the open tables' aggregates form one lazy plan (one job when
    the caller acts).  With ``isolate_tables=True`` each table's fused job runs
    now, ``max_workers`` at a time, and a table whose rules cannot be analysed
    or whose job fails gets ``status='error'`` rows and failing verdicts
    instead of ending the run; ``on_error='ignore'`` tolerates cross-column
    errors as everywhere.  Acting on both ``rule_results`` and
    ``validation_results`` of a lazy run scans each table twice; an isolated
    run keeps the counts, so both are then read from memory.
    """
    prepare = prepare or {}
    skipped_rows = []
    states, frames = evaluate_gates(spark, [spec for spec, _ in tables], max_workers)
    by_name = {st.table_name: st for st in states}
    open_pairs = []
    for spec, rules in tables:
        st = by_name[spec.table_name]
        if not st.is_open:
            for r in rules.rules:
                skipped_rows.append((rules.table_name, r.validation_type, r.rule_name, "skipped",
                                     "blocker", st.reason))
            continue
        open_pairs.append((spec, rules))

    def build(pair):
        spec, rules = pair
        df = frames[spec.table_name]
        if spec.table_name in prepare:
            df = prepare[spec.table_name](df)
        check = FusedCheck(df, rules, on_error, isolate=isolate_tables)
        if isolate_tables:
            check.materialize()
        return check

    checks = _map_threads(build, open_pairs, max_workers)
    return SuiteRun(gate_frame(spark, states), checks, spark.createDataFrame(skipped_rows, SKIPPED_DDL), states, max_workers)
