"""Roll-ups, summaries, alerts and trends over validation results.

Inputs are validation-results DataFrames (see
:mod:`tablecheck.operators.validate`), possibly unioned across tables and runs.
All outputs are aggregations or projections of them.  A result without a
``passed`` value counts as failed in roll-ups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Severity labels of a summary and of a gate-closed rule.
SEVERITY_NORMAL = "normal"
SEVERITY_CRITICAL = "critical"
SEVERITY_BLOCKER = "blocker"


def _passed(c: str = "passed") -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def results_rollup(results: DataFrame) -> DataFrame:
    """``total_validations, passed, failed, overall_passed`` (one row)."""
    return (results.agg(F.count(F.lit(1)).alias("total_validations"),
                        F.count_if(_passed()).alias("passed"))
            .withColumn("failed", F.col("total_validations") - F.col("passed"))
            .withColumn("overall_passed", F.col("failed") == 0))


def summary_overall(results: DataFrame) -> DataFrame:
    """Totals over all results (one row).

    ``tables_validated`` is the sorted, comma-joined set of table names;
    ``tables_validated_count`` its size.
    """
    tables = F.array_sort(F.collect_set("table_name"))
    return results.agg(
        F.count(F.lit(1)).alias("total_validations"),
        F.count_if(_passed()).alias("passed"),
        F.count_if(~_passed()).alias("failed"),
        F.coalesce(F.sum("total_rows"), F.lit(0)).cast("bigint").alias("total_rows_validated"),
        F.coalesce(F.sum("total_violations"), F.lit(0)).cast("bigint").alias("total_violations"),
        F.array_join(tables, ",").alias("tables_validated"),
        F.size(tables).alias("tables_validated_count"),
    )


def summary_by_type(results: DataFrame) -> DataFrame:
    """``validation_type, count, passed, failed``; a missing type is ``unknown``."""
    return (results.groupBy(F.coalesce(F.col("validation_type"), F.lit("unknown")).alias("validation_type"))
            .agg(F.count(F.lit(1)).alias("count"),
                 F.count_if(_passed()).alias("passed"),
                 F.count_if(~_passed()).alias("failed")))


def validation_summary(results: DataFrame) -> DataFrame:
    """Per result: the per-row violation rate in percent and a severity.

    Unlike ``violation_percentage`` (pooled over rules), this rate divides by
    rows only; it is 0 for an empty input.
    """
    per_row = F.coalesce(F.try_divide(F.col("total_violations").cast("double"),
                                      F.col("total_rows").cast("double")) * 100.0, F.lit(0.0))
    return results.select(
        "table_name", "validation_type", "passed", "total_rows", "total_violations",
        per_row.alias("violations_per_row_pct"),
        (F.col("threshold") * 100.0).alias("threshold_pct"),
        F.when(_passed(), F.lit(SEVERITY_NORMAL)).otherwise(F.lit(SEVERITY_CRITICAL)).alias("severity"))


def alert_messages(results: DataFrame) -> DataFrame:
    """A one-line alert for each failed result and a success line for each
    table whose results all passed."""
    failed = results.filter(~_passed()).select(
        "table_name", "validation_type", F.lit("alert").alias("kind"),
        F.format_string("%s: %s check failed, %.2f%% of the tests violated where %.2f%% are allowed "
                        "(%s violations); loads that depend on it should wait",
                        F.col("table_name"), F.col("validation_type"),
                        F.col("violation_percentage") * 100.0, F.col("threshold") * 100.0,
                        F.format_number(F.col("total_violations"), 0)).alias("message"))
    per_table = (results.groupBy("table_name")
                 .agg(F.bool_and(_passed()).alias("all_passed"),
                      F.max("total_rows").alias("total_rows"),
                      F.count(F.lit(1)).alias("validations")))
    passed = per_table.filter("all_passed").select(
        "table_name", F.lit(None).cast("string").alias("validation_type"), F.lit("passed").alias("kind"),
        F.format_string("%s: nothing over its threshold, %s rows, %d checks",
                        F.col("table_name"), F.format_number(F.col("total_rows"), 0),
                        F.col("validations")).alias("message"))
    return failed.unionByName(passed)


def results_as_json(results: DataFrame) -> DataFrame:
    """Each result row as one JSON document (for attachments or log sinks)."""
    return results.select(F.to_json(F.struct(*[F.col(c) for c in results.columns])).alias("json"))


def results_trend(history: DataFrame, run_col: str = "run_ts", retention_days: int | None = 30) -> DataFrame:
    """Run-over-run change per ``(table_name, validation_type)``.

    ``history`` is validation results plus a ``run_col`` timestamp.  Rows older
    than ``retention_days`` before the newest run are dropped first.  The window
    is partitioned by table and type, so each partition holds one series.
    """
    h = history
    if retention_days is not None:
        # scalar subquery: planned once, its value is a literal in the filter
        newest = h.select(F.max(run_col)).scalar()
        keep = F.col(run_col) >= newest - F.make_dt_interval(F.lit(retention_days))
        if "run_date" in h.columns:
            # a date-partitioned results table: prune the dates out of the window
            keep = (F.col("run_date") >= F.date_sub(F.to_date(newest), retention_days + 1)) & keep
        h = h.filter(keep)
    w = Window.partitionBy("table_name", "validation_type").orderBy(run_col)
    prev = F.lag("violation_percentage").over(w)
    return (h.select(run_col, "table_name", "validation_type", "total_rows", "total_violations",
                     "violation_percentage", "passed",
                     prev.alias("previous_percentage"),
                     (F.col("violation_percentage") - prev).alias("change"),
                     F.lag("passed").over(w).alias("previous_passed")))


def validation_details(rule_results: DataFrame) -> DataFrame:
    """Per ``(table_name, validation_type)``: the rules validated (in name order)
    and a map of the rules that have violations to their counts.

    ``collect_list`` is bounded by the number of rules of one table and family.
    """
    named = F.struct(F.col("rule_name"), F.col("violations"))
    # one entry per name even if a name is configured twice in a family
    per_name = (rule_results.groupBy("table_name", "validation_type", "rule_name")
                .agg(F.sum("violations").cast("bigint").alias("violations")))
    return (per_name.groupBy("table_name", "validation_type")
            .agg(F.array_sort(F.collect_list("rule_name")).alias("rules_validated"),
                 F.array_sort(F.collect_list(F.when(F.col("violations") > 0, named))).alias("_nz"))
            .select("table_name", "validation_type", "rules_validated",
                    F.map_from_entries("_nz").alias("violations")))


def cumulative_results(history: DataFrame, threshold: float | None = None) -> DataFrame:
    """Validation results over many runs or windows, from their stored counts.

    Counts add up across disjoint slices (hours, batches), so a table-level
    verdict follows from the per-slice results without scanning the table
    again.  ``rules_configured`` must be the same in every slice; the
    threshold is the slices' (or ``threshold``).
    """
    agg = (history.groupBy("table_name", "validation_type")
           .agg(F.sum("total_rows").cast("bigint").alias("total_rows"),
                F.max("rules_configured").alias("rules_configured"),
                F.sum("total_violations").cast("bigint").alias("total_violations"),
                F.max("threshold").alias("threshold")))
    rate = (F.when(F.col("total_violations") > 0,
                   F.col("total_violations").cast("double")
                   / (F.col("total_rows") * F.col("rules_configured")).cast("double"))
            .otherwise(F.lit(0.0)))
    t = F.col("threshold") if threshold is None else F.lit(float(threshold))
    return agg.select("table_name", "validation_type", "total_rows", "rules_configured", "total_violations",
                      rate.alias("violation_percentage"), t.alias("threshold"), (rate <= t).alias("passed"))
