"""Structured Streaming forms of the hourly validation.

``stream_windowed_validation``: a file stream of a table, an event-time
watermark, and the fused ``count_if`` list grouped by a tumbling window.  With
``complete`` output every window is re-emitted per trigger (bounded runs,
backfills); with ``update``/``append`` only changed or closed windows are, and
rows later than the watermark are dropped, so a continuous verdict can differ
from a batch recomputation by exactly those late rows.

``stream_batch_suite``: each micro-batch is validated as a table of its own
and its results are written under ``batch_id``; a replayed batch overwrites
its own partition, so the sink is idempotent.

Both use a checkpoint under the session's shared checkpoint folder, so a
restarted query resumes from its last committed batch.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import col as qcol
from ..functions.time import ntz_as_utc_instant, utc_instant_as_ntz
from ..operators.validate import FusedCheck
from ..plans.windows import windowed_validation
from ..rules import TableRules
from ..session import scratch_path

EVENT_TIME = "_event_time"


def write_batch(results: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch's results under ``batch_id``; a replayed batch
    overwrites its own partition only (idempotent sink)."""
    (results.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Results written by ``write_batch`` (``batch_id`` back as bigint)."""
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def file_stream(spark: SparkSession, directory: str, schema: T.StructType, glob: str | None = None,
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def _event_time(df: DataFrame, ts: str) -> tuple[DataFrame, bool]:
    """Watermarks need TIMESTAMP: a TIMESTAMP_NTZ column is read as a UTC wall
    clock (and window bounds are turned back into wall-clock times later), so
    windows do not depend on the session time zone."""
    ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    event = ntz_as_utc_instant(qcol(ts)) if ntz else qcol(ts)
    return df.withColumn(EVENT_TIME, event), ntz


def windowed_stream(df: DataFrame, table_rules: TableRules, timestamp_column: str, duration: str = "1 hour",
                    watermark: str = "1 hour", on_error: str = "fail") -> DataFrame:
    """Streaming validation results per window (lazy streaming DataFrame)."""
    s, ntz = _event_time(df, timestamp_column)
    s = s.withWatermark(EVENT_TIME, watermark)
    check = FusedCheck(s, table_rules, on_error, group_by=[F.window(EVENT_TIME, duration).alias("window")])
    out = check.validation_results()
    start, end = F.col("window.start"), F.col("window.end")
    if ntz:
        start, end = utc_instant_as_ntz(start), utc_instant_as_ntz(end)
    rest = [c for c in out.columns if c != "window"]
    return out.select(start.alias("window_start"), end.alias("window_end"), *rest)


def run_to_table(stream: DataFrame, output_path: str, checkpoint: str, output_mode: str = "complete",
                 available_now: bool = True) -> None:
    """Drive a streaming result into a Parquet table, idempotently.

    complete: each batch holds the whole result and overwrites the table;
    update/append: each batch goes to its own ``batch_id`` partition (a batch
    replayed after a failure replaces itself instead of adding duplicates).
    Blocks until the available input is processed (``availableNow``).
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        if output_mode == "complete":
            batch.write.mode("overwrite").parquet(output_path)
        else:
            write_batch(batch, output_path, batch_id)

    w = (stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def latest_windows(batches: DataFrame, keys=("window_start", "table_name", "validation_type")) -> DataFrame:
    """The newest version of every window from per-batch update-mode output
    (one group per window: bounded by the number of windows)."""
    cols = [c for c in batches.columns if c != "batch_id"]
    newest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("batch_id")).alias("_row")
    return batches.groupBy(*keys).agg(newest).select("_row.*")


def stream_windowed_validation(spark: SparkSession, directory: str, schema: T.StructType, table_rules: TableRules,
                               timestamp_column: str, glob: str | None = None, duration: str = "1 hour",
                               watermark: str = "1 hour", output_mode: str = "complete",
                               output_path: str | None = None, checkpoint: str | None = None,
                               max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the windowed validation as a stream over ``directory``; return the result table.

    Append mode holds back the windows that the watermark has not passed; with
    :func:`with_open_windows` they are added as they stand.
    """
    output_path = output_path or scratch_path(spark, "stream_windows_out")
    checkpoint = checkpoint or scratch_path(spark, "stream_windows_ckpt")
    src = file_stream(spark, directory, schema, glob, max_files_per_trigger=max_files_per_trigger)
    run_to_table(windowed_stream(src, table_rules, timestamp_column, duration, watermark), output_path,
                 checkpoint, output_mode)
    if output_mode == "complete":
        return spark.read.parquet(output_path)
    batches = read_batches(spark, output_path)
    if output_mode == "update":
        return latest_windows(batches)
    return batches.drop("batch_id")


def with_open_windows(emitted: DataFrame, source: DataFrame, table_rules: TableRules, timestamp_column: str,
                      duration: str = "1 hour") -> DataFrame:
    """Append-mode windows plus those still open, validated over the rows from the newest emitted end on.

    The filter reaches the scan, so only the tail of ``source`` is read; rows
    without a timestamp, which no stream window holds, come with it.
    """
    newest = emitted.agg(F.max("window_end")).first()[0]
    tail = source if newest is None else source.filter((qcol(timestamp_column) >= F.lit(newest)) | qcol(timestamp_column).isNull())
    return emitted.unionByName(windowed_validation(tail, table_rules, timestamp_column, duration))


def stream_batch_suite(spark: SparkSession, directory: str, schema: T.StructType, table_rules: TableRules,
                       glob: str | None = None, results_path: str | None = None, checkpoint: str | None = None,
                       max_files_per_trigger: int | None = None,
                       prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Validate every micro-batch with the fused suite; results keyed by ``batch_id``."""
    results_path = results_path or scratch_path(spark, "stream_suite_out")
    checkpoint = checkpoint or scratch_path(spark, "stream_suite_ckpt")
    src = file_stream(spark, directory, schema, glob, max_files_per_trigger=max_files_per_trigger)
    if prepare is not None:
        src = prepare(src)

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(FusedCheck(batch, table_rules).validation_results(), results_path, batch_id)

    q = (src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_batches(spark, results_path)
