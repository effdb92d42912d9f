"""Checks on JSON documents and on file metadata.

Document check (per document): valid when it is one strict JSON value, an
object, and holds every required top-level key (a null value counts as
present).  The verdict is ``invalid / total <= threshold`` (10 % by default).
Duplicate keys make a document invalid unless the session sets
``spark.sql.variant.allowDuplicateKeys=true`` (Python's ``json`` accepts them).

File-metadata check (per file-metadata frame): required *columns* must be
present, sizes must lie in bounds, extensions must be allowed; zero
tolerance by default.  Everything is one aggregation over the frame.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import (bound_violation, extension_of, json_is_object, json_key_present, json_parsed,
                                    json_parsed_ok)

FILE_CHECK_COLUMNS = ["table_name", "check_name", "total_files", "violations", "violation_percentage",
                      "threshold", "passed"]


_PARSED = "_parsed_document"


def _valid_object(v: Column) -> Column:
    return F.coalesce(json_parsed_ok(F.col(_PARSED), v) & json_is_object(v), F.lit(False))


def _all_present(required: Sequence[str]) -> Column:
    """Every required key present; keys are read from the parsed variant."""
    parsed = F.col(_PARSED)
    out = F.lit(True)
    for k in required:
        out = out & json_key_present(parsed, k)
    return F.coalesce(out, F.lit(False))


def document_status(df: DataFrame, value_col: str, required: Sequence[str]) -> DataFrame:
    """Adds ``valid_json``, ``missing_keys`` (array) and ``is_valid``.

    A document that is not an object has every key missing.
    """
    v = F.col(value_col)
    df = df.withColumn(_PARSED, json_parsed(v))
    ok = _valid_object(v)
    parsed = F.col(_PARSED)
    missing = F.array_compact(F.array(*[F.when(~F.coalesce(ok & json_key_present(parsed, k), F.lit(False)),
                                               F.lit(k)) for k in required])) \
        if required else F.array().cast("array<string>")
    return (df.withColumn("valid_json", json_parsed_ok(parsed, v))
              .withColumn("missing_keys", missing)
              .withColumn("is_valid", ok & (F.size("missing_keys") == 0)).drop(_PARSED))


def _verdict(total: Column, bad: Column, threshold: float) -> list[Column]:
    rate = F.coalesce(F.try_divide(bad.cast("double"), total.cast("double")), F.lit(0.0))
    return [rate.alias("violation_percentage"), F.lit(float(threshold)).alias("threshold"),
            (rate <= F.lit(float(threshold))).alias("passed")]


def required_keys_check(df: DataFrame, value_col: str, required: Sequence[str], table_name: str,
                        check_name: str = "required_keys", threshold: float = 0.10) -> DataFrame:
    """One row: documents, invalid documents, rate and verdict."""
    return required_keys_checks(df, value_col, {check_name: required}, table_name, threshold)


def required_keys_checks(df: DataFrame, value_col: str, key_sets: Mapping[str, Sequence[str]], table_name: str,
                         threshold: float = 0.10) -> DataFrame:
    """Several named required-key sets over the same documents, one scan.

    The document is parsed once per row; each set adds one ``count_if``.
    """
    v = F.col(value_col)
    ok = _valid_object(v)
    aggs = [F.count(F.lit(1)).alias("total_files")]
    names = list(key_sets)
    for i, n in enumerate(names):
        aggs.append(F.count_if(~(ok & _all_present(key_sets[n]))).alias(f"_k{i}"))
    # the parse is a projection of its own: the aggregate reads it once per key set
    agg = df.select(value_col, json_parsed(v).alias(_PARSED)).agg(*aggs)
    structs = [F.struct(F.lit(n).alias("check_name"), F.col(f"_k{i}").alias("violations"))
               for i, n in enumerate(names)]
    rows = agg.select("total_files", F.inline(F.array(*structs)))
    return rows.select(F.lit(table_name).alias("table_name"), "check_name", "total_files", "violations",
                       *_verdict(F.col("total_files"), F.col("violations"), threshold))


def invalid_document_details(df: DataFrame, value_col: str, required: Sequence[str], order_by: Sequence[str],
                             limit: int = 10) -> DataFrame:
    """The first ``limit`` invalid documents by ``order_by`` with their reasons."""
    s = document_status(df, value_col, required).filter(~F.col("is_valid"))
    reason = (F.when(~F.col("valid_json"), F.lit("invalid JSON document"))
              .when(~json_is_object(F.col(value_col)), F.lit("not a JSON object"))
              .otherwise(F.lit("missing keys")))
    return (s.orderBy(*order_by).limit(limit)
            .select(*order_by, F.array_join("missing_keys", ",").alias("missing_keys"), reason.alias("error")))


def bound_check(df: DataFrame, value: Column, lo: float | None, hi: float | None, table_name: str,
                check_name: str, threshold: float = 0.0) -> DataFrame:
    """Files whose ``value`` (size) is outside ``[lo, hi]``."""
    agg = df.agg(F.count(F.lit(1)).alias("total_files"),
                 F.count_if(bound_violation(value, lo, hi)).alias("violations"))
    return agg.select(F.lit(table_name).alias("table_name"), F.lit(check_name).alias("check_name"),
                      "total_files", "violations", *_verdict(F.col("total_files"), F.col("violations"), threshold))


def existence_check(manifest: DataFrame, table_name: str, check_name: str = "file_existence") -> DataFrame:
    """One row that fails when there is no file at all."""
    agg = manifest.agg(F.count(F.lit(1)).alias("total_files"))
    none = (F.col("total_files") == 0)
    return agg.select(F.lit(table_name).alias("table_name"), F.lit(check_name).alias("check_name"), "total_files",
                      none.cast("bigint").alias("violations"), none.cast("double").alias("violation_percentage"),
                      F.lit(0.0).alias("threshold"), (~none).alias("passed"))


def extension_check(df: DataFrame, path: Column, allowed: Sequence[str], table_name: str,
                    check_name: str = "file_extension", threshold: float = 0.0) -> DataFrame:
    allowed_l = [a.lower() for a in allowed]
    bad = ~extension_of(path).isin(allowed_l)
    agg = df.agg(F.count(F.lit(1)).alias("total_files"), F.count_if(bad).alias("violations"))
    return agg.select(F.lit(table_name).alias("table_name"), F.lit(check_name).alias("check_name"),
                      "total_files", "violations", *_verdict(F.col("total_files"), F.col("violations"), threshold))


def validate_file_metadata(metadata_df: DataFrame, required_keys: Sequence[str],
                           file_size_min: float | None = None, file_size_max: float | None = None,
                           allowed_extensions: Sequence[str] | None = None,
                           size_col: str = "file_size", path_col: str = "file_path") -> DataFrame:
    """One row: ``total_files, missing_keys, size_violations,
    extension_violations, errors, passed`` (passed = no errors).

    The size test needs ``size_col`` and at least one bound; the extension test
    needs ``path_col`` and a list.  A bound of 0 is a real bound.
    """
    cols = set(metadata_df.columns)
    missing = [k for k in required_keys if k not in cols]
    aggs = [F.count(F.lit(1)).alias("total_files")]
    size_on = (file_size_min is not None or file_size_max is not None) and size_col in cols
    ext_on = bool(allowed_extensions) and path_col in cols
    if size_on:
        aggs.append(F.count_if(bound_violation(F.col(size_col), file_size_min, file_size_max))
                    .alias("size_violations"))
    if ext_on:
        aggs.append(F.count_if(~extension_of(F.col(path_col)).isin([a.lower() for a in allowed_extensions]))
                    .alias("extension_violations"))
    agg = metadata_df.agg(*aggs)
    size_v = F.col("size_violations") if size_on else F.lit(0).cast("bigint")
    ext_v = F.col("extension_violations") if ext_on else F.lit(0).cast("bigint")
    errors = F.concat_ws("; ",
                         F.lit(f"metadata lacks {', '.join(missing)}" if missing else None),
                         F.when(size_v > 0, F.format_string("size out of bounds: %d", size_v)),
                         F.when(ext_v > 0, F.format_string("extension not allowed: %d", ext_v)))
    return agg.select(
        "total_files", F.lit(",".join(missing)).alias("missing_keys"),
        size_v.alias("size_violations"), ext_v.alias("extension_violations"),
        errors.alias("errors"), (errors == F.lit("")).alias("passed"))
