"""Result sinks.

Results are appended to a table partitioned by ``run_date`` and ``run_id``.
A rerun of the same run replaces only its own partition (dynamic partition
overwrite), so a retried job never duplicates results, and reports that keep
a retention window read only the dates they need (partition pruning).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_results(results: DataFrame, target: str, run_id: str, run_ts=None, fmt: str = "parquet") -> None:
    """Write ``results`` with ``run_id``, ``run_ts`` and ``run_date`` columns,
    idempotently per run.

    Pass ``run_ts`` (for an hourly run, the interval start) as the run's logical
    time.  Without it a retry takes the time that the run was first written
    with (found by partition pruning on ``run_id``), so it lands in the same
    partition even after midnight; a new run reads the driver's clock.
    """
    ts = run_ts
    if ts is None:
        first = _first_written(results.sparkSession, target, run_id, fmt)
        ts = first or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    out = (results.withColumn("run_ts", F.lit(ts).cast("timestamp"))
           .withColumn("run_date", F.to_date(F.lit(ts).cast("timestamp")))
           .withColumn("run_id", F.lit(run_id)))
    (out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date", "run_id").save(target))


def _first_written(spark, target: str, run_id: str, fmt: str):
    """The ``run_ts`` of the stored rows of a run, if there are any."""
    try:
        return read_results(spark, target, run_id, fmt).agg(F.min("run_ts").cast("string")).first()[0]
    except AnalysisException as e:
        if (e.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            return None
        raise


def read_results(spark, target: str, run_id: str | None = None, fmt: str = "parquet") -> DataFrame:
    df = spark.read.format(fmt).load(target)
    return df.filter(F.col("run_id") == run_id) if run_id is not None else df
