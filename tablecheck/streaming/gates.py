"""Gates over time: each key's gate opens, closes and reopens as its windows pass or fail.

A file stream is validated per key and event-time window.  A window is judged
once a later window of its key shows: the gate is open if every family of
rules keeps its threshold.  Only changes are emitted, each once: ``open`` (the
first verdict passes), ``close`` and ``reopen``.  Windows without rows change
nothing.

Rows that come for a window already judged are *late*: they are counted with
the batch they came in, and change no verdict.  Rows without a timestamp
belong to no window and are counted too.  So for every batch

    rows = counted + late + untimed

and the sums over all batches give the table.

Each micro-batch reads its rows once (the fused counters, combined map-side,
so a hot key or window costs a row per task) and writes two small tables under
its ``batch_id``: the counters, and the windows they make with their verdicts.
The newest window of each key is the state: the next batch adds to its
counters.  A batch replayed after a failure reads the same state and replaces
its own partitions.  A row without a key belongs to the gate NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.predicates import col as qcol
from ..plans.windows import windowed_validation
from ..rules import TableRules
from ..session import scratch_path
from .hourly import file_stream, read_batches, write_batch

COUNTERS = ["gate", "window_start", "validation_type", "total_rows", "rules_configured", "total_violations", "threshold"]


@dataclass(frozen=True)
class GateHistory:
    """Where a gate stream keeps its tables; the same path resumes it."""
    spark: SparkSession
    path: str

    def _table(self, name: str) -> DataFrame:
        return read_batches(self.spark, f"{self.path}/{name}")

    def transitions(self) -> DataFrame:
        """``batch_id, gate, window_start, is_open, change`` for every change of a gate."""
        changed = self._table("windows").filter((F.col("window_start") < F.col("newest")) & F.col("change").isNotNull())
        return changed.select("batch_id", "gate", "window_start", "is_open", "change")

    def accounting(self) -> DataFrame:
        """``batch_id, gate, total_rows, counted_rows, late_rows, untimed_rows``."""
        def rows(kind: str):
            return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("total_rows"))), F.lit(0)).alias(f"{kind}_rows")

        # every family counts the rows of its group: one of them stands for all
        groups = (self._table("counters").filter("kind <> 'carried'").groupBy("batch_id", "gate", "window_start", "kind")
                  .agg(F.max("total_rows").alias("total_rows")))
        return groups.groupBy("batch_id", "gate").agg(F.sum("total_rows").alias("total_rows"), rows("counted"), rows("late"),
                                                      rows("untimed"))

    def gates(self) -> DataFrame:
        """``gate, window_start, is_open``: each gate as it stands, its unfinished window counted as it is."""
        windows = self._table("windows")
        newest = windows.agg(F.max("batch_id")).scalar()
        return (windows.filter((F.col("batch_id") == newest) & (F.col("window_start") == F.col("newest")))
                .select("gate", "window_start", "is_open"))

    def carried(self, batch_id: int) -> DataFrame:
        """The counters that batch ``batch_id`` left: of each gate the newest window, and the verdict before it."""
        left = self._table("windows").filter((F.col("batch_id") == batch_id) & (F.col("window_start") == F.col("newest")))
        return left.select("gate", "window_start", F.inline("families"), F.col("last").alias("was_open")).select(*COUNTERS, "was_open")


def judged_windows(counters: DataFrame) -> DataFrame:
    """``gate, window_start, is_open, last, change, newest, families`` from counters that may be in parts.

    ``last`` is the verdict of the gate's window before; ``families`` the whole counters (an entry per family of rules).
    """
    whole = (counters.groupBy("gate", "window_start", "validation_type")
             .agg(F.sum("total_rows").alias("total_rows"), F.max("rules_configured").alias("rules_configured"),
                  F.sum("total_violations").alias("total_violations"), F.max("threshold").alias("threshold"),
                  F.bool_and("was_open").alias("was_open")))
    rate = (F.when(F.col("total_violations") > 0, F.col("total_violations").cast("double")
                   / (F.col("total_rows") * F.col("rules_configured")).cast("double")).otherwise(0.0))
    verdicts = whole.groupBy("gate", "window_start").agg(
        F.bool_and(rate <= F.col("threshold")).alias("is_open"), F.bool_and("was_open").alias("was_open"),
        F.collect_list(F.struct(*COUNTERS[2:])).alias("families"))
    by_gate = Window.partitionBy("gate")
    last = F.coalesce(F.lag("is_open").over(by_gate.orderBy("window_start")), F.col("was_open"))
    steps = verdicts.withColumn("last", last).withColumn("newest", F.max("window_start").over(by_gate))
    change = (F.when(~F.col("is_open") & F.coalesce("last", F.lit(True)), "close")
              .when(F.col("is_open") & F.col("last").isNull(), "open")
              .when(F.col("is_open") & ~F.col("last"), "reopen"))
    return steps.withColumn("change", change).drop("was_open")


def _step(history: GateHistory, batch: DataFrame, batch_id: int, table_rules: TableRules, key: str, ts: str,
          duration: str) -> None:
    found = windowed_validation(batch, table_rules, ts, duration, keys=[qcol(key).alias("gate")])
    found = found.select(*COUNTERS, F.lit(None).cast("boolean").alias("was_open"), F.lit(False).alias("carried"))
    if batch_id > 0:
        found = found.unionByName(history.carried(batch_id - 1).withColumn("carried", F.lit(True)))
    floor = F.max(F.when(F.col("carried"), F.col("window_start"))).over(Window.partitionBy("gate"))
    kind = (F.when(F.col("carried"), "carried").when(F.col("window_start").isNull(), "untimed")
            .when(F.col("window_start") < F.col("floor"), "late").otherwise("counted"))
    write_batch(found.withColumn("floor", floor).select(*COUNTERS, "was_open", kind.alias("kind")),
                f"{history.path}/counters", batch_id)
    counted = read_batches(history.spark, f"{history.path}/counters").filter(
        (F.col("batch_id") == batch_id) & F.col("kind").isin("counted", "carried"))
    write_batch(judged_windows(counted), f"{history.path}/windows", batch_id)


def stream_gates(spark: SparkSession, directory: str, schema: T.StructType, table_rules: TableRules, key: str,
                 timestamp_column: str, duration: str = "1 hour", path: str | None = None, glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> GateHistory:
    """Validate the files of ``directory`` that no finished run has seen and move the gates on.

    ``path`` holds checkpoint and tables, and is passed again to go on from there.
    """
    path = path or scratch_path(spark, "gates")
    source = file_stream(spark, directory, schema, glob, max_files_per_trigger=max_files_per_trigger)

    def step(batch: DataFrame, batch_id: int) -> None:
        _step(GateHistory(batch.sparkSession, path), batch, batch_id, table_rules, key, timestamp_column, duration)

    q = (source.writeStream.option("checkpointLocation", f"{path}/checkpoint").foreachBatch(step)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return GateHistory(spark, path)
