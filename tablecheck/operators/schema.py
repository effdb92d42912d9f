"""Metadata checks: existence, schema, row counts.

Schema work reads only the table's schema (no Spark job): a schema is a few
hundred fields at most, so it is turned into a small DataFrame on the driver
and compared with joins, which keeps every result an ordinary DataFrame.
Row counts are Spark aggregations (Parquet answers them from footers).

Type matching has two modes:

* ``loose`` (default, for parity): lower-case both names, strip ``type()`` and
  ``()``, accept when either contains the other, any decimal matches any
  decimal, and ``date``/``timestamp`` match each other.  So ``string`` matches
  ``array<string>`` and ``timestamp`` matches ``timestamp_ntz``, while
  ``integer`` does not match ``long``.  Declared types use the PySpark class
  spelling (``long``, ``integer``).
* ``exact``: the declared type is parsed as a Spark DDL type and must equal
  the actual type (nullability ignored).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import read_table, table_exists

SCHEMA_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("type_class", T.StringType()),
])

EXPECTED_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("expected_type", T.StringType()),
    T.StructField("expected_canonical", T.StringType()),
])

DIFF_COLUMNS = ["table_name", "kind", "column_name", "expected_type", "actual_type"]


def schema_frame(spark: SparkSession, table_name: str, schema: T.StructType) -> DataFrame:
    """``(table_name, ordinal, column_name, data_type, type_class)`` per field.

    ``data_type`` is Spark's simple string (``bigint``); ``type_class`` is the
    PySpark class spelling (``LongType()``) that loose matching works on.
    """
    rows = [(table_name, i + 1, f.name, f.dataType.simpleString(), str(f.dataType))
            for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, SCHEMA_SCHEMA)


def table_schema(spark: SparkSession, source: str, table_name: str | None = None) -> DataFrame:
    df = read_table(spark, source)
    return schema_frame(spark, table_name or source, df.schema)


def _canonical(type_string: str) -> str | None:
    """Spark's simple string of a declared DDL type (``long`` -> ``bigint``)."""
    try:
        return T.DataType.fromDDL(type_string).simpleString()
    except Exception:  # noqa: BLE001 - undeclarable type: never equal
        return None


def expected_frame(spark: SparkSession, table_name: str, expected: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Expected schema as a frame; a plain column list means 'any type'."""
    if isinstance(expected, Mapping):
        rows = [(table_name, c, t, _canonical(t)) for c, t in expected.items()]
    else:
        rows = [(table_name, c, None, None) for c in expected]
    return spark.createDataFrame(rows, EXPECTED_SCHEMA)


def normalized_type(c: Column) -> Column:
    return F.replace(F.replace(F.lower(c), F.lit("type()"), F.lit("")), F.lit("()"), F.lit(""))


def loose_type_match(expected: Column, actual_class: Column) -> Column:
    e, a = normalized_type(expected), normalized_type(actual_class)
    return (F.contains(a, e) | F.contains(e, a)
            | (F.contains(e, F.lit("decimal")) & F.contains(a, F.lit("decimal")))
            | (e.isin("timestamp", "date") & a.isin("timestamptype", "datetype", "timestamp", "date"))
            | (e == a))


def schema_differences(actual: DataFrame, expected: DataFrame, strict: bool = True,
                       mode: str = "loose") -> DataFrame:
    """One row per difference: ``kind`` in missing / extra / type_mismatch.

    Names compare case-sensitively.  ``extra`` rows only in strict mode.  Type
    rows only where the expected type is declared.
    """
    a = actual.select("table_name", "column_name", "data_type", "type_class",
                      F.lit(True).alias("_in_actual"))
    e = expected.withColumn("_in_expected", F.lit(True))
    j = e.join(a, ["table_name", "column_name"], "full_outer")
    if mode == "exact":
        ok = F.coalesce(F.col("expected_canonical") == F.col("data_type"), F.lit(False))
    elif mode == "loose":
        ok = loose_type_match(F.col("expected_type"), F.col("type_class"))
    else:
        raise ValueError("mode must be 'loose' or 'exact'")
    kind = (F.when(F.col("_in_actual").isNull(), F.lit("missing"))
            .when(F.col("_in_expected").isNull(), F.lit("extra"))
            .when(F.col("expected_type").isNotNull() & ~ok, F.lit("type_mismatch")))
    out = j.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    if not strict:
        out = out.filter(F.col("kind") != "extra")
    return out.select("table_name", "kind", "column_name", "expected_type",
                      F.col("data_type").alias("actual_type"))


def schema_check(spark: SparkSession, source: str, table_name: str,
                 expected: Mapping[str, str] | Sequence[str], strict: bool = True,
                 mode: str = "loose") -> DataFrame:
    """Differences between a table and its expected schema (empty = valid).

    A table that cannot be read yields one ``kind='error'`` row.
    """
    try:
        actual = table_schema(spark, source, table_name)
    except (AnalysisException, PySparkException) as err:
        code = err.getCondition() if isinstance(err, PySparkException) else None
        rows = [(table_name, "error", None, None, code or type(err).__name__)]
        return spark.createDataFrame(rows, "table_name string, kind string, column_name string, "
                                           "expected_type string, actual_type string")
    return schema_differences(actual, expected_frame(spark, table_name, expected), strict, mode)


def schema_verdict(differences: DataFrame, tables: DataFrame) -> DataFrame:
    """``(table_name, is_valid, errors)`` for every table in ``tables``."""
    per = (differences.groupBy("table_name")
           .agg(F.count(F.lit(1)).alias("errors")))
    return (tables.select("table_name").join(per, "table_name", "left")
            .select("table_name", F.coalesce(F.col("errors"), F.lit(0)).cast("bigint").alias("errors"))
            .withColumn("is_valid", F.col("errors") == 0))


# -- existence and counts ----------------------------------------------------------

def exists_frame(spark: SparkSession, sources: Mapping[str, str]) -> DataFrame:
    """``(table_name, exists)``; False only when not found."""
    rows = [(name, table_exists(spark, src)) for name, src in sources.items()]
    return spark.createDataFrame(rows, "table_name string, exists boolean")


def row_count(df: DataFrame, table_name: str, filter_condition: str | Column | None = None) -> DataFrame:
    """``(table_name, row_count, error)``; a filter that does not analyse gives
    a NULL count and the error code instead of a silent 0."""
    spark = df.sparkSession
    try:
        f = df.filter(filter_condition) if filter_condition is not None else df
        f.schema  # analyse now
    except (AnalysisException, PySparkException) as err:
        code = err.getCondition() if isinstance(err, PySparkException) else None
        return spark.createDataFrame([(table_name, None, code or type(err).__name__)],
                                     "table_name string, row_count bigint, error string")
    return f.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table_name).alias("table_name"), "row_count", F.lit(None).cast("string").alias("error"))


def not_empty(df: DataFrame, table_name: str) -> DataFrame:
    """``(table_name, row_count, not_empty)``; for Parquet the count is
    answered from footers, so this is cheap at any size."""
    return (df.agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(table_name).alias("table_name"), "row_count",
                    (F.col("row_count") > 0).alias("not_empty")))
