"""Write, audit, publish: a table changes only to rows that passed their rules.

The rows are written to a folder of their own while counters observe them: one
pass over the data, no second scan for the audit.  Only if every family of
rules passes is the table's location moved to that folder, one change in the
catalog.  A reader sees the former rows or the new ones, never none or half of
them; rows that fail stay aside for inspection and the table stays as it was.
A job that fails on the way changes nothing either.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.validate import MAX_RULES_PER_AGGREGATE, FusedCheck
from ..rules import TableRules


@dataclass(frozen=True)
class Published:
    """What became of the rows: ``path`` holds them, ``published`` says whether the table shows them."""

    check: FusedCheck
    path: str
    published: bool

    def verdicts(self, threshold: float | None = None) -> DataFrame:
        return self.check.validation_results(threshold).withColumn("published", F.lit(self.published))


def observed_write(df: DataFrame, rules: TableRules, path: str, on_error: str = "fail") -> FusedCheck:
    """Write ``df`` to ``path`` as Parquet and count its rules' violations on the way.

    The check holds the counters; asking it for results runs no job over the data.
    """
    check = FusedCheck(df, rules, on_error)
    counted = [i for i, c in enumerate(check.compiled) if c.violation is not None]
    watched, seen = df, []
    for k in range(0, max(1, len(counted)), MAX_RULES_PER_AGGREGATE):
        counters = [F.count(F.lit(1)).alias("total_rows")] if k == 0 else []
        counters += [F.count_if(check.compiled[i].violation).alias(f"_v{i}") for i in counted[k:k + MAX_RULES_PER_AGGREGATE]]
        seen.append(Observation(f"audit-{uuid.uuid4().hex}"))
        watched = watched.observe(seen[-1], *counters)
    watched.write.parquet(path)
    values: dict = {}
    for s in seen:
        values |= s.get
    names = ["total_rows", *[f"_v{i}" for i in counted]]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    check.chunks = [(counted, df.sparkSession.createDataFrame([tuple(values.get(n, 0) for n in names)], schema))]
    return check


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def publish_table(spark: SparkSession, name: str, df: DataFrame, rules: TableRules, versions: str,
                  threshold: float | None = None, on_error: str = "fail") -> Published:
    """Make ``df``'s rows the rows of the catalog table ``name`` if they pass ``rules``.

    ``versions`` is a shared folder that holds one sub-folder per attempt.  The
    first version that passes creates the table, unpartitioned Parquet; later
    ones must have its columns and types (``ValueError`` before anything is
    written).  Rules that tolerate errors do so here as everywhere.
    """
    exists = spark.catalog.tableExists(name)
    if exists and _columns(spark.table(name).schema) != _columns(df.schema):
        raise ValueError(f"table {name!r} has other columns than the rows to publish")
    path = f"{versions.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    check = observed_write(df, rules, path, on_error)
    passed = all(r["passed"] for r in check.validation_results(threshold).collect())  # one row a family
    if passed and exists:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    elif passed:
        spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)
    return Published(check, path, passed)
