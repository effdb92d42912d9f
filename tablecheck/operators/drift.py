"""Drift of a column's distribution over runs, from mergeable sketches.

``value_sketches`` reduces a table to one row per run: rows, nulls, a quantile
sketch of a number and a distinct-count sketch of a key.  Partial sketches are
made map-side, so a run's rows never meet; a sketch has a few kilobytes
whatever the run's size.  The rows are stored as history.

``quantile_drift`` compares each run with the runs before it within a trailing
window, by merging their stored sketches: no row of an older run is read
again.  The shift at a baseline quantile is the change of rank it would have
among the run's values (0 where nothing moved), with the error of the sketches
(about 1.65 / k^0.9 in rank for size k, either side).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
#: Quantile sketch size; rank error about half a percent.
KLL_K = 400
#: Steps of rank at which a run's sketch is read.
GRID = 200


def value_sketches(df: DataFrame, run: Column, value: str, key: str, k: int = KLL_K) -> DataFrame:
    """``run, rows, nulls, values, keys``: a row per run, to be stored; NaN counts as null.

    A run without any value has a NULL sketch.
    """
    number = F.col(value).cast("double")
    clean = F.when(~F.isnan(number), number)
    return df.groupBy(run.alias("run")).agg(
        F.count("*").alias("rows"), F.count_if(clean.isNull()).alias("nulls"),
        F.when(F.count(clean) > 0, F.kll_sketch_agg_double(clean, k)).alias("values"),
        F.theta_sketch_agg(key).alias("keys"))


def baselines(history: DataFrame, days: int, k: int = KLL_K) -> DataFrame:
    """``run, runs_before, rows_before, values_before, keys_before``: the runs of the ``days`` before each, merged.

    ``run`` is a date or timestamp.  Each stored row meets at most the runs of ``days``, and merges map-side.
    """
    now = history.select(F.col("run").alias("at"))
    before = history.join(now, (F.col("run") < F.col("at")) & (F.col("run") >= F.col("at") - F.make_dt_interval(F.lit(days))))
    return before.groupBy(F.col("at").alias("run")).agg(
        F.count("*").alias("runs_before"), F.sum("rows").alias("rows_before"),
        F.when(F.count("values") > 0, F.kll_merge_agg_double("values", k)).alias("values_before"),
        F.theta_union_agg("keys").alias("keys_before"))


def quantile_drift(history: DataFrame, days: int = 7, quantiles: Sequence[float] = QUANTILES, limit: float = 0.1,
                   k: int = KLL_K) -> DataFrame:
    """``run, rows, runs_before, rows_before, quantiles, shifts, max_shift, drifted, keys, keys_before``.

    ``quantiles`` are the baseline's values at the asked ranks, ``shifts`` their change of rank;
    ``drifted`` if the largest exceeds ``limit``.  A run without a baseline or without values has NULL there.
    """
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    merged = history.select("run", "rows", "values", "keys").join(baselines(history, days, k), "run", "left")
    at = F.when(F.col("values").isNotNull() & F.col("values_before").isNotNull(),
                F.kll_sketch_get_quantile_double("values_before", ranks))
    steps = F.kll_sketch_get_quantile_double("values", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))

    def shift(v: Column, rank: Column) -> Column:
        below = (F.size(F.filter("steps", lambda x: x < v)) - 1) / GRID
        upto = F.size(F.filter("steps", lambda x: x <= v)) / GRID
        return F.when(rank < below, below - rank).when(rank > upto, upto - rank).otherwise(0.0)

    out = (merged.withColumn("quantiles", at).withColumn("steps", F.when(F.col("quantiles").isNotNull(), steps))
           .withColumn("shifts", F.zip_with("quantiles", ranks, shift)))
    largest = F.array_max(F.transform("shifts", F.abs))
    return out.select("run", "rows", F.coalesce("runs_before", F.lit(0)).alias("runs_before"),
                      F.coalesce("rows_before", F.lit(0)).alias("rows_before"), "quantiles", "shifts",
                      largest.alias("max_shift"), (largest > limit).alias("drifted"),
                      F.theta_sketch_estimate("keys").alias("keys"), F.theta_sketch_estimate("keys_before").alias("keys_before"))
