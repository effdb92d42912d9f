"""Run every table of a registry: structured tables and file sets.

Structured tables go through the gate (existence + expected schema), then the
fused suite; ``incremental`` tables are cut to ``[start, end)`` on their
``timestamp_column`` when an interval is given.  Unstructured sets get a
directory gate and, where the registry asks for it, an existence check (at
least one file).  JSON sets get a required-keys check (table threshold) and a
size check on the file manifest (zero tolerance); other file sets get the
file-metadata check over a caller-supplied metadata frame or the manifest.

A registered table without a location is not left out: its gate is closed and
its rules are ``skipped``.  A location for an unregistered name is an error.
``decisions`` applies the registry's stop policies.

All results come back in the validation-results schema, so roll-ups,
summaries and trends apply to both kinds.  File checks use
``validation_type`` = check name, ``total_rows`` = files, one rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import files as FC
from ..operators.joins import join_small
from ..operators.gate import TableSpec, stop_decision
from ..operators.validate import VALIDATION_RESULT_COLUMNS, VALIDATION_RESULT_SCHEMA
from ..sources import files as FS
from ..sources.tables import incremental_slice
from .registry import Registry, UnknownTableError
from .run import SuiteRun, _union, run_suite


@dataclass
class RegistryRun:
    suite: SuiteRun
    file_gate: DataFrame
    validation_results: DataFrame
    decisions: DataFrame


def file_results_as_validation(df: DataFrame) -> DataFrame:
    """File-check rows (``FILE_CHECK_COLUMNS``) in the validation-results schema."""
    return df.select("table_name", F.col("check_name").alias("validation_type"),
                     F.col("total_files").alias("total_rows"), F.lit(1).alias("rules_configured"),
                     F.col("violations").cast("bigint").alias("total_violations"),
                     "violation_percentage", "threshold", "passed")


def run_registry(spark: SparkSession, registry: Registry, locations: Mapping[str, str],
                 interval: tuple[str, str] | None = None, mode: str = "loose",
                 metadata_frames: Mapping[str, DataFrame] | None = None,
                 prepare: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
                 state_dir: str | None = None) -> RegistryRun:
    """Run the registry against ``locations[table_name]`` (table names or paths).

    With ``state_dir``, JSON sets marked ``incremental`` are checked as a file
    stream: this run covers only the files that arrived since the previous
    run with the same ``state_dir``.
    """
    metadata_frames = metadata_frames or {}
    unknown = sorted(set(locations) - set(registry.get_all_tables()))
    if unknown:
        raise UnknownTableError(f"locations for unregistered tables: {', '.join(unknown)}")
    pairs, slices = [], dict(prepare or {})
    for name, conf in registry.get_structured_tables().items():
        tr = registry.table_rules(name)
        pairs.append((TableSpec(name, locations.get(name), tr.expected_schema, tr.strict_schema, mode,
                                fmt=conf.get("format") or "parquet"), tr))
        if interval is not None and tr.incremental and tr.timestamp_column:
            base = slices.get(name)

            part = registry.get_table_config(name).get("partition_column")

            def cut(df, ts=tr.timestamp_column, base=base, part=part):
                df = base(df) if base else df
                return incremental_slice(df, ts, *interval, partition_column=part)
            slices[name] = cut
    suite = run_suite(spark, pairs, slices)

    gate_rows, file_frames = [], []
    for name, conf in registry.get_unstructured_tables().items():
        tr = registry.table_rules(name)
        v = conf.get("validations", {})
        path = locations.get(name)
        if path is None:
            gate_rows.append((name, False, False, "no location given"))
            continue
        status = FS.directory_status(spark, path).first()
        is_open = bool(status["exists"] and status["is_directory"])
        gate_rows.append((name, bool(status["exists"]), is_open,
                          None if is_open else "directory not found"))
        if not is_open:
            continue
        size = v.get("file_size", {})
        lo, hi = size.get("min_bytes"), size.get("max_bytes")
        is_json = conf.get("format") == "json"
        glob = conf.get("glob", "*.json" if is_json else "*")
        # taken when a check first asks for it, then shared
        manifest = cache(lambda path=path, glob=glob: FS.stored_manifest(spark, path, glob))
        if v.get("file_existence", {}).get("enabled", False):
            file_frames.append(FC.existence_check(manifest(), name))
        if is_json:
            layout = conf.get("layout", "document")
            keys = v.get("metadata_keys", {}).get("required", [])
            if state_dir and tr.incremental:
                from ..streaming.documents import check_new_documents
                file_frames.append(check_new_documents(spark, path, {"required_keys": keys}, name,
                                                       f"{state_dir}/{name}", glob, layout, tr.threshold))
            else:
                docs = FS.scan_json_files(spark, path, glob, mode=layout,
                                          manifest=manifest() if layout == "document" else None)
                file_frames.append(FC.required_keys_check(docs, "value", keys, name, "required_keys", tr.threshold))
            if lo is not None or hi is not None:
                # sizes come from the listing, so every run checks all files, empty ones too
                file_frames.append(FC.bound_check(manifest(), F.col("file_size"), lo, hi, name, "file_size"))
        else:
            meta = metadata_frames.get(name)
            if meta is None:
                meta = manifest().drop("file_uri")
            allowed = v.get("file_extensions", {}).get("allowed")
            required = v.get("metadata_keys", {}).get("required", [])
            file_frames.append(_file_metadata_rows(meta, name, required, lo, hi, allowed))
    file_gate = spark.createDataFrame(gate_rows, "table_name string, exists boolean, is_open boolean, reason string")
    empty = spark.createDataFrame([], VALIDATION_RESULT_SCHEMA)
    files = [file_results_as_validation(f) for f in file_frames]
    results = _union([suite.validation_results, *files], empty).select(*VALIDATION_RESULT_COLUMNS)
    n_tables = len(registry.get_all_tables())
    gates = suite.gate.select("table_name", "is_open").unionByName(file_gate.select("table_name", "is_open"))
    policies = registry.tables_df(spark).select("table_name", "metadata_stop_on_failure", "data_stop_on_threshold")
    return RegistryRun(suite, file_gate, results, stop_decision(results, gates, policies, rows=n_tables))


def _file_metadata_rows(meta: DataFrame, name: str, required, lo, hi, allowed) -> DataFrame:
    """The file-metadata report as check rows: missing keys, size, extension."""
    rep = FC.validate_file_metadata(meta, required, lo, hi, allowed)
    structs = [
        F.struct(F.lit("metadata_keys").alias("check_name"),
                 (F.col("missing_keys") != "").cast("bigint").alias("violations")),
        F.struct(F.lit("file_size").alias("check_name"), F.col("size_violations").alias("violations")),
        F.struct(F.lit("file_extension").alias("check_name"), F.col("extension_violations").alias("violations")),
    ]
    rows = rep.select("total_files", F.inline(F.array(*structs)))
    rate = F.coalesce(F.try_divide(F.col("violations").cast("double"), F.col("total_files").cast("double")),
                      F.lit(0.0))
    return rows.select(F.lit(name).alias("table_name"), "check_name", "total_files", "violations",
                       rate.alias("violation_percentage"), F.lit(0.0).alias("threshold"),
                       (F.col("violations") == 0).alias("passed"))


def annotate_results(results: DataFrame, tables: DataFrame, tags: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``table_type, namespace, incremental`` from the registry's tables
    frame and a ``tags`` map (environment labels) to every result row."""
    meta = tables.select("table_name", "table_type", "namespace", "incremental")
    out = join_small(results, meta, "table_name", "left")
    tag_map = F.create_map(*[x for k, v in sorted((tags or {}).items()) for x in (F.lit(k), F.lit(v))]) \
        if tags else F.create_map().cast("map<string,string>")
    return out.withColumn("tags", tag_map)
