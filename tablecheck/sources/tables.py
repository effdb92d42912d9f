"""Table scans and table sinks.

A table is addressed either by a catalog name (``db.tbl``) or by a path
(anything with ``/`` or a URI scheme), read with ``fmt`` (Parquet by default;
Iceberg/Delta work the same way when their jars are on the classpath).

Filters are built from typed ``Column`` literals, never from interpolated SQL
text, so Catalyst pushes them into the Parquet scan (``PushedFilters``) and
prunes columns (``ReadSchema``).
"""

from __future__ import annotations

import datetime as _dt
import os
import re
import uuid
from typing import Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import col as qcol
from ..functions.time import utc_instant_as_ntz
from ..session import scratch_path


def is_path(source: str) -> bool:
    return "/" in source or "://" in source or source.endswith(".parquet")


def read_table(spark: SparkSession, source: str, columns: Sequence[str] | None = None,
               fmt: str = "parquet", options: Mapping[str, str] | None = None) -> DataFrame:
    """Catalog or path scan with an optional projection."""
    if is_path(source):
        df = spark.read.format(fmt).options(**(options or {})).load(source)
    else:
        df = spark.table(source)
    if columns:
        df = df.select(*[qcol(c) for c in columns])
    return df


def pruned_filtered_read(spark: SparkSession, source: str, columns: Sequence[str],
                         filter_condition: str | Column | None = None, fmt: str = "parquet") -> DataFrame:
    """Projection then filter.

    The filter may name a column that is not projected: the analyzer resolves
    it against the scan below the projection, so it is still pushed down.
    """
    df = read_table(spark, source, columns, fmt)
    if filter_condition is not None:
        df = df.filter(filter_condition)
    return df


_OFFSET = re.compile(r"(?:[zZ]|[+-]\d\d(?::?\d\d)?)\s*$")


def _has_offset(value) -> bool:
    if isinstance(value, str):
        return bool(re.search(r"\d:\d", value) and _OFFSET.search(value.split(":", 1)[1]))
    return getattr(value, "tzinfo", None) is not None


def _typed_literal(value, dtype: T.DataType) -> Column:
    """A literal of the column's own type (no session-time-zone surprises).

    A bound with an offset names an instant.  Wall-clock columns
    (``TIMESTAMP_NTZ``) hold UTC here as elsewhere, so it becomes the UTC wall
    clock of that instant.
    """
    if isinstance(dtype, T.TimestampNTZType):
        if _has_offset(value):
            return utc_instant_as_ntz(F.lit(value).cast("timestamp"))
        return F.lit(value).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit(value).cast("timestamp")
    if isinstance(dtype, T.DateType):
        return F.lit(value).cast("date")
    return F.lit(value).cast(dtype)


def interval_filter(df: DataFrame, timestamp_column: str, start, end) -> Column:
    """``start <= ts < end`` (half-open) with literals of the column's type."""
    dtype = df.schema[timestamp_column].dataType
    c = qcol(timestamp_column)
    return (c >= _typed_literal(start, dtype)) & (c < _typed_literal(end, dtype))


def partition_date_filter(df: DataFrame, partition_column: str, start, end, timestamp_column: str | None = None,
                          partition_zone: str | None = None) -> Column:
    """Dates covering ``[start, end)`` on a date-valued partition column.

    Redundant with the timestamp filter for the rows it keeps, but it lets the
    planner prune whole partitions (``PartitionFilters``) before listing files.
    The dates follow from the same typed bounds as the row filter, in the zone
    the partitions were written with (``partition_zone``; the session's by
    default, UTC for wall-clock columns).  An end at midnight needs no next day.
    """
    p = qcol(partition_column)
    dtype = df.schema[partition_column].dataType
    ts_type = df.schema[timestamp_column].dataType if timestamp_column else T.TimestampNTZType()

    def wall(value) -> Column:
        typed = _typed_literal(value, ts_type)
        if isinstance(ts_type, T.TimestampType) and partition_zone:
            return F.convert_timezone(F.lit("UTC"), F.lit(partition_zone), utc_instant_as_ntz(typed))
        return typed.cast("timestamp_ntz")

    lo = F.to_date(wall(start))
    hi = F.to_date(wall(end) - F.expr("INTERVAL '0.000001' SECOND"))
    if not isinstance(dtype, T.DateType):
        lo, hi = lo.cast(dtype), hi.cast(dtype)
    return (p >= lo) & (p <= hi)


def incremental_slice(df: DataFrame, timestamp_column: str, start, end,
                      columns: Sequence[str] | None = None, partition_column: str | None = None,
                      partition_zone: str | None = None) -> DataFrame:
    """Rows of one interval ``[start, end)``; the time column need not be kept.

    ``partition_column`` names a date partition column of the table (values
    ``yyyy-MM-dd``) so that partitions outside the interval are not read;
    ``partition_zone`` is the zone of its dates.
    """
    cond = interval_filter(df, timestamp_column, start, end)
    if partition_column:
        cond = partition_date_filter(df, partition_column, start, end, timestamp_column, partition_zone) & cond
    out = df.filter(cond)
    if columns:
        out = out.select(*[qcol(c) for c in columns])
    return out


def get_incremental_data(spark: SparkSession, source: str, timestamp_column: str, start, end,
                         columns: Sequence[str] | None = None, fmt: str = "parquet",
                         partition_column: str | None = None) -> DataFrame:
    return incremental_slice(read_table(spark, source, fmt=fmt), timestamp_column, start, end, columns,
                             partition_column)


def default_interval(env: Mapping[str, str] | None = None,
                     now: _dt.datetime | None = None) -> tuple[str, str]:
    """``DATA_INTERVAL_START``/``END`` when both are set, else the last hour."""
    env = os.environ if env is None else env
    s, e = env.get("DATA_INTERVAL_START"), env.get("DATA_INTERVAL_END")
    if s and e:
        return s, e
    end = now or _dt.datetime.now()
    start = end - _dt.timedelta(hours=1)
    fmt = "%Y-%m-%d %H:%M:%S"
    return start.strftime(fmt), end.strftime(fmt)


# -- existence ---------------------------------------------------------------

def try_read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None when it is not found; other errors propagate."""
    if not is_path(source):
        return spark.table(source) if spark.catalog.tableExists(source) else None
    try:
        df = spark.read.format(fmt).load(source)
        df.schema
        return df
    except AnalysisException as e:
        if (e.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            return None
        raise


def table_exists(spark: SparkSession, source: str, fmt: str = "parquet") -> bool:
    """False only when the table/path is not found; other errors propagate."""
    return try_read_table(spark, source, fmt) is not None


# -- sinks ---------------------------------------------------------------------

def _namespace(name: str) -> str | None:
    parts = name.split(".")
    return ".".join(parts[:-1]) if len(parts) > 1 else None


# Table formats written through the DataSource V2 API (``writeTo``).
V2_FORMATS = ("iceberg", "delta")


def _reads_target(spark: SparkSession, df: DataFrame, target: str, fmt: str) -> bool:
    """Whether ``df``'s plan reads files of the table or path ``target``."""
    old = try_read_table(spark, target, fmt)
    if old is None:
        return False
    try:
        return bool(set(df.inputFiles()) & set(old.inputFiles()))
    except PySparkException:
        return True  # cannot be told: take the safe way


def create_table(spark: SparkSession, target: str, df: DataFrame,
                 partition_cols: Sequence[str] | None = None, fmt: str = "parquet",
                 location: str | None = None, namespace_location: str | None = None) -> None:
    """Create or replace a table with ``df``'s rows.

    Path targets are overwritten in place; catalog targets get their namespace
    created first (at ``namespace_location`` when given).  ``location`` makes a
    catalog table external (shared path).  Iceberg and Delta catalog tables
    are written with ``writeTo(...).createOrReplace()``, an atomic replace.
    """
    if fmt in V2_FORMATS and not is_path(target):
        ns = _namespace(target)
        if ns:
            spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns}")
        w = df.writeTo(target).using(fmt)
        if partition_cols:
            w = w.partitionedBy(*[F.col(c) for c in partition_cols])
        if location:
            w = w.tableProperty("location", location)
        w.createOrReplace()
        return
    w = df.write.format(fmt).mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if _reads_target(spark, df, target, fmt):
        # the rows come from the table that is replaced: write them aside first
        aside = scratch_path(spark, f"replace_{uuid.uuid4().hex[:8]}")
        df.write.format("parquet").save(aside)
        w = spark.read.schema(df.schema).parquet(aside).write.format(fmt).mode("overwrite")
        if partition_cols:
            w = w.partitionBy(*partition_cols)
    if is_path(target):
        w.save(target)
        return
    ns = _namespace(target)
    if ns:
        where = f" LOCATION '{namespace_location}'" if namespace_location else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns}{where}")
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    if location:
        w = w.option("path", location)
    w.saveAsTable(target)


def append_table(spark: SparkSession, target: str, df: DataFrame, fmt: str = "parquet") -> None:
    """Append rows; the table must already exist."""
    if not table_exists(spark, target, fmt):
        raise ValueError(f"table {target!r} does not exist")
    if fmt in V2_FORMATS and not is_path(target):
        df.writeTo(target).append()
        return
    if is_path(target):
        df.write.format(fmt).mode("append").save(target)
    else:
        df.write.format(fmt).mode("append").saveAsTable(target)
