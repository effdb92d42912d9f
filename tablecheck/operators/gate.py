"""The gate ("circuit breaker"): metadata checks decide which tables get data checks.

Order inside a run: metadata (existence, schema; optionally emptiness) ->
gate -> data checks for open tables only.  A closed table's rules become
``skipped`` rows with severity ``blocker`` and the reason; its data is never
scanned, and rules naming missing columns are never analysed.

Gate rules: existence opens the gate, a schema check keeps it open only if
the schema is valid, an unset table is closed.  Emptiness is reported but only
closes the gate with ``require_rows=True``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import try_read_table
from .joins import join_small
from .schema import EXPECTED_SCHEMA, SCHEMA_SCHEMA, _canonical, schema_differences

GATE_DDL = "table_name string, exists boolean, schema_valid boolean, schema_errors string, is_open boolean, reason string"


@dataclass(frozen=True)
class TableSpec:
    table_name: str
    source: str | None  # None: no location is known, the gate stays closed
    expected_schema: Mapping[str, str] | Sequence[str] | None = None
    strict: bool = True
    mode: str = "loose"
    require_rows: bool = False
    fmt: str = "parquet"


@dataclass(frozen=True)
class GateState:
    table_name: str
    exists: bool
    schema_valid: bool | None
    schema_errors: str | None
    not_empty: bool | None
    is_open: bool
    reason: str | None


def _map_threads(fn, items, max_workers: int):
    """``map`` on a driver thread pool (Spark sessions are thread-safe)."""
    items = list(items)
    if max_workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(max_workers, len(items))) as ex:
        return list(ex.map(fn, items))


def _load(spark: SparkSession, spec: TableSpec):
    """``(DataFrame, reason)``: the table (one footer read), or why there is none.

    Whatever keeps one table from being read closes its gate, not the run.
    """
    if not spec.source:
        return None, "no location given"
    try:
        df = try_read_table(spark, spec.source, spec.fmt)
    except (PySparkException, Py4JJavaError) as e:
        return None, f"unreadable: {type(e).__name__}"
    return df, None if df is not None else "table not found"


def evaluate_gates(spark: SparkSession, specs: Sequence[TableSpec],
                   max_workers: int = 8) -> tuple[list[GateState], dict[str, DataFrame]]:
    """Metadata checks of many tables: name-only expectations are compared on
    the driver (set differences of metadata), typed ones in one
    schema-comparison job per (strict, mode) group, and one emptiness probe
    job covers all tables that ask for it.  Returns the states and the loaded
    DataFrames of open tables.

    Tables are resolved (catalog lookup or footer read) on ``max_workers``
    driver threads: with thousands of tables the latency of these metadata
    reads, not Spark work, bounds the run.
    """
    frames: dict[str, DataFrame] = {}
    absent: dict[str, str] = {}
    for spec, (df, why) in zip(specs, _map_threads(lambda sp: _load(spark, sp), specs, max_workers)):
        if df is not None:
            frames[spec.table_name] = df
        else:
            absent[spec.table_name] = why
    errors: dict[str, list[str]] = {}
    groups: dict[tuple[bool, str], list[TableSpec]] = {}
    for spec in specs:
        if spec.table_name not in frames or spec.expected_schema is None:
            continue
        if isinstance(spec.expected_schema, Mapping):
            groups.setdefault((spec.strict, spec.mode), []).append(spec)
            continue
        # names only: set differences of metadata, no job (same order as below)
        actual = set(frames[spec.table_name].columns)
        expected = set(spec.expected_schema)
        diffs = [("missing", c) for c in expected - actual]
        if spec.strict:
            diffs += [("extra", c) for c in actual - expected]
        if diffs:
            errors[spec.table_name] = [f"{k} {c}" for k, c in sorted(diffs)]
    for (strict, mode), group in groups.items():
        actual_rows, expected_rows = [], []
        for spec in group:
            for i, f in enumerate(frames[spec.table_name].schema.fields):
                actual_rows.append((spec.table_name, i + 1, f.name, f.dataType.simpleString(), str(f.dataType)))
            exp = spec.expected_schema
            if isinstance(exp, Mapping):
                expected_rows += [(spec.table_name, c, t, _canonical(t)) for c, t in exp.items()]
            else:
                expected_rows += [(spec.table_name, c, None, None) for c in exp]
        diffs = schema_differences(spark.createDataFrame(actual_rows, SCHEMA_SCHEMA),
                                   spark.createDataFrame(expected_rows, EXPECTED_SCHEMA), strict, mode)
        # at most one row per declared or actual column of the group
        for r in diffs.orderBy("table_name", "kind", "column_name").collect():
            errors.setdefault(r["table_name"], []).append(f"{r['kind']} {r['column_name']}")
    wants_rows = [s for s in specs if s.require_rows and s.table_name in frames]
    non_empty: set[str] = set()
    if wants_rows:
        probes = [frames[s.table_name].limit(1).select(F.lit(s.table_name).alias("t")) for s in wants_rows]
        while len(probes) > 1:  # a balanced union: its depth is the logarithm of the tables
            probes = [a.unionByName(b) for a, b in zip(probes[::2], probes[1::2])] + (probes[-1:] if len(probes) % 2 else [])
        non_empty = {r["t"] for r in probes[0].collect()}
    states = []
    for spec in specs:
        if spec.table_name not in frames:
            states.append(GateState(spec.table_name, False, None, None, None, False, absent[spec.table_name]))
            continue
        errs = errors.get(spec.table_name)
        valid = not errs
        ne = (spec.table_name in non_empty) if spec.require_rows else None
        reason = f"schema: {'; '.join(errs)}" if errs else ("table is empty" if ne is False else None)
        states.append(GateState(spec.table_name, True, valid, "; ".join(errs) if errs else None, ne,
                                valid and ne is not False, reason))
    return states, {s.table_name: frames[s.table_name] for s in states if s.is_open}


def evaluate_gate(spark: SparkSession, spec: TableSpec) -> GateState:
    """Metadata checks of one table (see :func:`evaluate_gates`)."""
    return evaluate_gates(spark, [spec])[0][0]


def gate_frame(spark: SparkSession, states: Sequence[GateState]) -> DataFrame:
    rows = [(s.table_name, s.exists, s.schema_valid, s.schema_errors, s.is_open, s.reason) for s in states]
    return spark.createDataFrame(rows, GATE_DDL)


def gate_from_checks(checks: DataFrame) -> DataFrame:
    """Gate from a metadata-results frame ``(table_name, check_name, passed)``.

    The gate is open only when every gating check passed; a table with no
    checks at all is absent (closed by ``coalesce(is_open, False)`` on join).
    """
    return (checks.groupBy("table_name")
            .agg(F.bool_and(F.coalesce(F.col("passed"), F.lit(False))).alias("is_open"),
                 F.array_sort(F.collect_set(F.when(~F.coalesce(F.col("passed"), F.lit(False)),
                                                   F.col("check_name")))).alias("failed_checks")))


def stop_decision(validation_results: DataFrame, gate: DataFrame, policies: DataFrame,
                  rows: int | None = None) -> DataFrame:
    """Per table: ``stop`` when a failure hits a stop policy, else ``warn``/``continue``.

    ``policies``: ``(table_name, metadata_stop_on_failure, data_stop_on_threshold)``;
    ``rows``: the number of gate rows, if known.
    """
    data = (validation_results.groupBy("table_name")
            .agg(F.bool_and("passed").alias("data_passed")))
    # policies and gate are configuration-sized: size-checked broadcast
    j = (join_small(policies, gate.select("table_name", "is_open"), "table_name", "left", rows)
         .join(data, "table_name", "left"))
    meta_ok = F.coalesce(F.col("is_open"), F.lit(False))
    data_ok = F.coalesce(F.col("data_passed"), F.lit(True))
    decision = (F.when(~meta_ok & F.col("metadata_stop_on_failure"), F.lit("stop"))
                .when(meta_ok & ~data_ok & F.col("data_stop_on_threshold"), F.lit("stop"))
                .when(~meta_ok | ~data_ok, F.lit("warn"))
                .otherwise(F.lit("continue")))
    return j.select("table_name", meta_ok.alias("metadata_passed"),
                    F.col("data_passed"), decision.alias("decision"))
