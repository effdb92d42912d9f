"""Validation per time window (hourly backfill) and per run.

``windowed_validation`` validates every interval of a table in one job:
``groupBy(window(ts, '1 hour'))`` with the same fused ``count_if`` list.  The
window ``[start, end)`` equals the half-open incremental slice, so the result
for one hour equals validating that slice alone.  Rows without a timestamp
belong to no hour: they form a group of their own with NULL bounds, so the
windows add up to the table.  Partial aggregation happens
map-side, so the shuffle carries one row per (task, window), whatever the
table size, and a window holding most of the rows costs no more.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import col as qcol
from ..operators.validate import FusedCheck
from ..rules import TableRules


NO_TIME = "1900-01-01 00:00:00"
NO_TIME_COLUMN, WINDOW_COLUMN = "_window_time", "_window"


def stand_in_type(dtype: T.DataType) -> str:
    return "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"


def windowed_check(df: DataFrame, table_rules: TableRules, timestamp_column: str,
                   duration: str = "1 hour", on_error: str = "fail", keys: Sequence[Column] = ()) -> FusedCheck:
    # F.window() drops rows without a timestamp: they are given a stand-in and its window is made NULL
    dtype = df.schema[timestamp_column].dataType
    ts = qcol(timestamp_column)
    stand_in = F.lit(NO_TIME).cast(stand_in_type(dtype))
    timed = df.withColumn(NO_TIME_COLUMN, F.coalesce(ts.cast(stand_in_type(dtype)), stand_in)) \
        .withColumn(WINDOW_COLUMN, F.window(NO_TIME_COLUMN, duration))
    w = F.when(ts.isNotNull(), F.col(WINDOW_COLUMN))
    return FusedCheck(timed, table_rules, on_error, group_by=[w.alias("window"), *keys])


def _flatten(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def windowed_validation(df: DataFrame, table_rules: TableRules, timestamp_column: str,
                        duration: str = "1 hour", on_error: str = "fail", keys: Sequence[Column] = ()) -> DataFrame:
    """Validation results per window (and ``keys``): ``window_start, window_end`` + the usual columns."""
    return _flatten(windowed_check(df, table_rules, timestamp_column, duration, on_error, keys).validation_results())


def windowed_rule_results(df: DataFrame, table_rules: TableRules, timestamp_column: str,
                          duration: str = "1 hour", on_error: str = "fail") -> DataFrame:
    return _flatten(windowed_check(df, table_rules, timestamp_column, duration, on_error).rule_results())
