"""Incremental checks of JSON document directories with Structured Streaming.

A file stream over the directory sees each file once: every trigger checks
only the documents of the files that arrived since the last committed batch
(the checkpoint records them), instead of re-reading the whole directory on
every hourly run.  Results are written per ``batch_id`` (idempotent on
replay); ``report.cumulative_results`` turns them into the verdict over all
documents so far.

Zero-length files produce no row in a file stream: ``stream_required_keys``
does not see them.  ``check_new_documents`` adds them from the listing, with a
record of those it has counted before.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.files import required_keys_checks
from ..session import scratch_path
from ..sources.files import stored, zero_length_files
from .hourly import read_batches, write_batch

#: Files of one micro-batch of ``check_new_documents``: what the driver holds of a batch does not grow with the folder.
FILES_PER_BATCH = 20_000
#: A batch's files are looked up by so many tasks (Spark's default is 10,000, mostly one per file).
LISTING_TASKS = 200
_LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def stream_required_keys(spark: SparkSession, directory: str, key_sets: Mapping[str, Sequence[str]],
                         table_name: str, glob: str = "*.json", mode: str = "document",
                         threshold: float = 0.10, results_path: str | None = None,
                         checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                         available_now: bool = True) -> DataFrame:
    """Check the documents of newly arrived files; return all per-batch results.

    Columns: the ``required_keys_checks`` columns plus ``batch_id``.
    """
    results_path = results_path or scratch_path(spark, "stream_documents_out")
    checkpoint = checkpoint or scratch_path(spark, "stream_documents_ckpt")
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if mode == "document":
        reader = reader.option("wholetext", True)
    elif mode != "lines":
        raise ValueError("mode must be 'document' or 'lines'")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.load(directory)
    if mode == "lines":
        docs = docs.filter(F.length(F.trim("value")) > 0)

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(required_keys_checks(batch, "value", key_sets, table_name, threshold), results_path, batch_id)

    w = docs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    before = spark.conf.get(_LISTING_CONF)
    spark.conf.set(_LISTING_CONF, min(int(before), LISTING_TASKS))
    try:
        q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
        q.awaitTermination()
    finally:
        spark.conf.set(_LISTING_CONF, before)
    if q.exception() is not None:
        raise q.exception()
    stored = _stored(spark, results_path)
    if stored is None:  # an empty folder: no batch ran
        empty = required_keys_checks(spark.createDataFrame([], "value string"), "value", key_sets, table_name, threshold)
        return empty.withColumn("batch_id", F.lit(0).cast("bigint")).filter(F.lit(False))
    return read_batches(spark, results_path)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A state table, or None before its first write; other errors propagate."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            return None
        raise


def check_new_documents(spark: SparkSession, directory: str, key_sets: Mapping[str, Sequence[str]],
                        table_name: str, state_dir: str, glob: str = "*.json", mode: str = "document",
                        threshold: float = 0.10, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Checks over the files that arrived since the previous call with the same
    ``state_dir`` (one row per key set; zero files when nothing arrived), all of
    them, in micro-batches of ``files_per_batch`` files.

    The stream's checkpoint and per-batch results live under ``state_dir``.
    What is new is what no finished call has reported: ``reported`` holds the
    last batch of each finished call, so a batch whose run died after writing
    its result but before the stream's commit is replayed and reported by the
    next call.  A call that dies later still is reported again, never lost.

    In document mode a zero-length file is an invalid document; those counted
    by a finished call are listed in ``empty_files``.
    """
    from ..operators.files import _verdict
    from ..operators.joins import join_small

    results_path, checkpoint = f"{state_dir}/results", f"{state_dir}/checkpoint"
    reported_path, empty_path = f"{state_dir}/reported", f"{state_dir}/empty_files"
    reported = _stored(spark, reported_path)
    before = -1 if reported is None else reported.agg(F.max("batch_id")).first()[0]
    res = stream_required_keys(spark, directory, key_sets, table_name, glob, mode, threshold,
                               results_path, checkpoint, files_per_batch)
    new = res.filter(F.col("batch_id") > F.lit(before))
    names = spark.createDataFrame([(n,) for n in key_sets], "check_name string")
    sums = (new.groupBy("check_name").agg(F.sum("total_files").cast("bigint").alias("total_files"),
                                          F.sum("violations").cast("bigint").alias("violations")))
    n_empty = 0
    if mode == "document":
        empty_now = zero_length_files(spark, directory, glob).select("file_path")
        counted = _stored(spark, empty_path)
        empty_new = stored(spark, empty_now if counted is None else empty_now.join(counted, "file_path", "left_anti"), "empty_files")
        n_empty = empty_new.count()
    last = res.agg(F.max("batch_id")).first()[0]
    # one row per configured key set on both sides: a size-checked broadcast
    rows = join_small(names, sums, "check_name", "left", rows=len(key_sets)).select(
        "check_name", (F.coalesce("total_files", F.lit(0)) + n_empty).cast("bigint").alias("total_files"),
        (F.coalesce("violations", F.lit(0)) + n_empty).cast("bigint").alias("violations"))
    rows = spark.createDataFrame(rows.collect(), rows.schema)  # a row per key set, before the marks below move
    if n_empty:
        empty_new.write.mode("append").parquet(empty_path)
    if last is not None and last > before:
        spark.createDataFrame([(last,)], "batch_id bigint").coalesce(1).write.mode("append").parquet(reported_path)
    return rows.select(F.lit(table_name).alias("table_name"), "check_name", "total_files", "violations",
                       *_verdict(F.col("total_files"), F.col("violations"), threshold))
