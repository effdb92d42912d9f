"""Many tables in few plans: one scan for all tables of equal schema and rules.

Planning a scan costs the driver the same whatever its size, so thousands of
small tables are driver work.  Tables whose columns and rules are equal form a
class; a class is read as one relation of many paths, its counters are grouped
by the file they come from (map-side combined, one row per file), and files
meet their table through the folders above them, an equi-join.  Tables without
a row keep their rows of results, with zero counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_small
from ..operators.validate import FusedCheck, rollup_rule_results
from ..rules import TableRules
from .run import _map_threads, _union


def _plain(path: Column) -> Column:
    """A path without what differs between ways to write it: the local scheme, a last slash, escapes."""
    return F.regexp_replace(F.regexp_replace(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), "^file:/+", "/"), "/+$", "")


def _folders(path: Column) -> Column:
    """The path and all folders above it."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def schema_classes(spark: SparkSession, tables: Sequence[tuple[str, TableRules]], fmt: str = "parquet",
                   schemas: Mapping[str, T.StructType] | None = None, max_workers: int = 8) -> list[tuple[T.StructType, list[tuple[str, TableRules]]]]:
    """Tables (``path, rules``) by equal schema and rules.  ``schemas`` names those that are known; the others are read."""
    known = dict(schemas or {})
    unknown = [p for p in dict.fromkeys(p for p, _ in tables) if p not in known]
    known |= dict(zip(unknown, _map_threads(lambda p: spark.read.format(fmt).load(p).schema, unknown, max_workers)))
    classes: dict[tuple, list] = {}
    for path, rules in tables:
        classes.setdefault((known[path].json(), rules.rules), []).append((path, rules))
    return [(known[members[0][0]], members) for members in classes.values()]


def _class_results(spark: SparkSession, schema: T.StructType, members: list[tuple[str, TableRules]], fmt: str, on_error: str) -> DataFrame:
    paths = list(dict.fromkeys(p for p, _ in members))
    rows = spark.read.format(fmt).schema(schema).load(paths)
    check = FusedCheck(rows, members[0][1], on_error, group_by=[F.col("_metadata.file_path").alias("_file")])
    counted = check.counts
    counters = [c for c in counted.columns if c != "_file"]
    names = spark.createDataFrame([(p, r.table_name) for p, r in members], "path string, _table string") \
        .select(_plain(F.col("path")).alias("_folder"), "_table")
    held = counted.withColumn("_folder", F.explode(_folders(_plain(F.col("_file"))))).drop("_file")
    sums = join_small(held, names, "_folder", "inner").groupBy("_table").agg(*[F.sum(c).alias(c) for c in counters])
    whole = names.select("_table").distinct().join(sums, "_table", "left").select(
        "_table", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counters])
    # the counters of the class now stand per table: the check's own projections make the rule rows
    check.chunks = [([i for i, c in enumerate(check.compiled) if c.violation is not None], whole)]
    check.group_names = ["_table"]
    return check.rule_results().withColumn("table_name", F.col("_table")).drop("_table")


def validate_paths(spark: SparkSession, tables: Sequence[tuple[str, TableRules]], fmt: str = "parquet",
                   schemas: Mapping[str, T.StructType] | None = None, on_error: str = "fail",
                   max_workers: int = 8) -> tuple[DataFrame, DataFrame]:
    """``(rule_results, validation_results)`` of many tables given by path, one scan per class.

    Table names are unique and each has its own threshold; several names may
    share a path.  A table that lies inside the folder of another counts for both.
    """
    if not tables:
        raise ValueError("no tables to validate")
    if len({r.table_name for _, r in tables}) < len(tables):
        raise ValueError("table names must be unique")
    parts = [_class_results(spark, schema, members, fmt, on_error)
             for schema, members in schema_classes(spark, tables, fmt, schemas, max_workers)]
    results = _union(parts, parts[0])
    thresholds = {r.table_name: r.threshold for _, r in tables}
    default = set(thresholds.values())
    return results, rollup_rule_results(results, default.pop() if len(default) == 1 else
                                        spark.createDataFrame(list(thresholds.items()), "table_name string, threshold double"), on_error)
