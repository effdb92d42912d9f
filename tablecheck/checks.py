"""Call-style facades returning Python values, for test suites and scripts.

``MetadataChecks`` and ``FileChecks`` answer the usual questions (does the
table exist, is its schema valid, how many rows, are the files well formed)
with booleans, counts and error lists.  The work is done by the DataFrame
operators of this package; only bounded results (one row, or one row per
schema difference) reach the driver.
"""

from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .operators import files as FC
from .operators import schema as S
from .sources import files as FS
from .sources.tables import read_table, table_exists


class MetadataChecks:
    def __init__(self, spark: SparkSession, fmt: str = "parquet"):
        self.spark = spark
        self.fmt = fmt

    def check_table_exists(self, source: str) -> bool:
        return table_exists(self.spark, source, self.fmt)

    def validate_schema(self, source: str, expected_schema: Mapping[str, str] | Sequence[str],
                        strict_mode: bool = True, mode: str = "loose") -> tuple[bool, list[str]]:
        """``(is_valid, errors)``: missing columns, extra columns (strict mode)
        and type mismatches, one message per kind, names sorted."""
        diffs = S.schema_check(self.spark, source, source, expected_schema, strict_mode, mode) \
            .orderBy("kind", "column_name").collect()  # one row per differing column
        errors: list[str] = []
        for kind, label in (("missing", "absent"), ("extra", "not expected")):
            cols = [d["column_name"] for d in diffs if d["kind"] == kind]
            if cols:
                errors.append(f"columns {label}: {', '.join(cols)}")
        for d in diffs:
            if d["kind"] == "type_mismatch":
                errors.append(f"type of {d['column_name']}: {d['actual_type']} instead of {d['expected_type']}")
            elif d["kind"] == "error":
                errors.append(f"schema not comparable: {d['actual_type']}")
        return not errors, errors

    def get_row_count(self, source: str, filter_condition: str | None = None) -> int | None:
        """Row count, or None when the table or the filter cannot be analysed."""
        if not self.check_table_exists(source):
            return None
        r = S.row_count(read_table(self.spark, source, fmt=self.fmt), source, filter_condition).first()
        return r["row_count"]

    def is_not_empty(self, source: str) -> bool:
        return not read_table(self.spark, source, fmt=self.fmt).isEmpty()


class FileChecks:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def directory_exists(self, path: str) -> bool:
        r = FS.directory_status(self.spark, path).first()
        return bool(r["exists"] and r["is_directory"])

    def json_files(self, path: str, glob: str = "*.json", sample: int = 5) -> tuple[int, list[str]]:
        """Number of ``glob`` files (empty ones too) and the first ``sample`` names."""
        m = FS.file_manifest(self.spark, path, glob)
        names = [r["file_name"] for r in m.orderBy("file_name").limit(sample).collect()]
        return m.count(), names

    def required_keys(self, path: str, required: Sequence[str], threshold: float = 0.10,
                      glob: str = "*.json", mode: str = "document", details: int = 10) -> dict[str, Any]:
        """Documents, invalid documents, rate, verdict and the first invalid files."""
        docs = FS.scan_json_files(self.spark, path, glob, mode)
        r = FC.required_keys_check(docs, "value", required, path, threshold=threshold).first()
        bad = FC.invalid_document_details(docs, "value", required, ["file_name"], details).collect()
        return {"total_files": r["total_files"], "invalid_files": r["violations"],
                "violation_percentage": r["violation_percentage"], "threshold": threshold,
                "passed": r["passed"],
                "invalid_details": [{"file": b["file_name"], "missing_keys": b["missing_keys"], "error": b["error"]}
                                    for b in bad]}

    def validate_file_metadata(self, metadata_df: DataFrame, required_keys: Sequence[str],
                               file_size_min: float | None = None, file_size_max: float | None = None,
                               allowed_extensions: Sequence[str] | None = None) -> tuple[bool, dict[str, Any]]:
        r = FC.validate_file_metadata(metadata_df, required_keys, file_size_min, file_size_max,
                                      allowed_extensions).first()
        report = {"total_files": r["total_files"],
                  "missing_keys": [k for k in r["missing_keys"].split(",") if k],
                  "size_violations": r["size_violations"], "extension_violations": r["extension_violations"],
                  "errors": [e for e in r["errors"].split("; ") if e]}
        return bool(r["passed"]), report
