"""Registered queries over time and depth: gates that change, late rows, drift from sketches, nested schemas.

Oracles state the expected rows from the given tables, independently of the code under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift as DR
from ..operators.nested import nested_check
from ..rules import TableRules, in_range, not_null
from ..session import scratch_path
from ..streaming.gates import GateHistory, stream_gates
from .registered import register
from .testdata_checks import table

# -- gates over time, late rows ----------------------------------------------------

GATE_RULES = TableRules("events", (not_null("user_id"), in_range("value", max=100)), threshold=0.14)
#: Arrivals end within a day; every 50th event comes one arrival late.
ARRIVALS = ("2024-01-08 12:00:00", "2024-01-15 07:00:00", "2024-01-22 00:00:00")
LATE_EVERY, LATE_REST = 50, 7


def _arrival(ts_literal: str) -> str:
    return (" + ".join(f"CASE WHEN ts >= {ts_literal} '{a}' THEN 1 ELSE 0 END" for a in ARRIVALS)
            + f" + CASE WHEN event_id % {LATE_EVERY} = {LATE_REST} THEN 1 ELSE 0 END")


def _gate_run(spark: SparkSession, sf_dir: str) -> GateHistory:
    """The events arrive in five parts; after each a run validates the new files, as a scheduled job would."""
    events = table(spark, sf_dir, "events")
    inbox, path = scratch_path(spark, "gate_inbox"), scratch_path(spark, "gate_stream")
    history = None
    for k in range(len(ARRIVALS) + 2):
        events.filter(F.expr(_arrival("TIMESTAMP_NTZ")) == k).write.mode("append").parquet(inbox)
        history = stream_gates(spark, inbox, events.schema, GATE_RULES, "event_type", "ts", "1 day", path)
    return history


_JUDGED_SQL = (
    f"WITH a AS (SELECT *, date_trunc('day', ts) AS day, {_arrival('TIMESTAMP')} AS part FROM events), "
    "reach AS (SELECT event_type, p.k AS part, max(a.day) AS floor FROM a JOIN range(1, 6) p(k) ON a.part < p.k GROUP BY ALL), "
    "m AS (SELECT a.*, coalesce(a.day < reach.floor, false) AS late FROM a LEFT JOIN reach USING (event_type, part))")


@register("stream_gate_transitions",
          _JUDGED_SQL + ", v AS (SELECT event_type AS gate, CAST(day AS TIMESTAMP) AS window_start, "
          "count_if(value > 100) / count(*) <= 0.14 AND count_if(user_id IS NULL) / count(*) <= 0.14 AS is_open "
          "FROM m WHERE NOT late GROUP BY ALL), "
          "c AS (SELECT *, lag(is_open) OVER w AS last, max(window_start) OVER (PARTITION BY gate) AS newest FROM v "
          "WINDOW w AS (PARTITION BY gate ORDER BY window_start)) "
          "SELECT gate, window_start, is_open, CASE WHEN NOT is_open THEN 'close' WHEN last IS NULL THEN 'open' "
          "ELSE 'reopen' END AS change FROM c WHERE window_start < newest AND is_open IS DISTINCT FROM last")
def stream_gate_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type has a gate, judged day by day while files arrive; its changes, each once."""
    return _gate_run(spark, sf_dir).transitions().drop("batch_id")


@register("stream_late_rows",
          _JUDGED_SQL + " SELECT CAST(part AS BIGINT) AS batch_id, event_type AS gate, count(*) AS total_rows, "
          "count_if(NOT late)::BIGINT AS counted_rows, count_if(late)::BIGINT AS late_rows, CAST(0 AS BIGINT) AS untimed_rows "
          "FROM m GROUP BY ALL")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that came after their day was judged, per arrival; counted and late rows add up to the table."""
    return _gate_run(spark, sf_dir).accounting()


# -- drift from sketches ---------------------------------------------------------------

DRIFT_DAYS, RANK_ERROR, KEY_ERROR = 7, 0.03, 0.1


@register("quantile_drift",
          "WITH d AS (SELECT date_trunc('day', ts) AS day, count(*) AS n, count(DISTINCT user_id) AS users "
          "FROM events GROUP BY ALL) SELECT CAST(day AS DATE) AS run, n AS rows, "
          f"coalesce((SELECT CAST(sum(b.n) AS BIGINT) FROM d b WHERE b.day < d.day AND b.day >= d.day - INTERVAL {DRIFT_DAYS} DAY), 0) "
          "AS rows_before, true AS quantiles_hold, true AS keys_hold FROM d")
def quantile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sketches of the event values, each day against the seven before; the estimates are held against the events.

    ``quantiles_hold``: each merged baseline quantile has its rank among the baseline's own events, within the
    sketches' error.  The check expands each event to the days whose baseline it is in, and counts map-side.
    """
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "sketches")
    day = F.to_date("ts")
    DR.value_sketches(events, day, "value", "user_id").write.parquet(path)
    found = DR.quantile_drift(spark.read.parquet(path), DRIFT_DAYS)
    path = scratch_path(spark, "drift")
    found.write.parquet(path)
    found = spark.read.parquet(path)

    days = F.explode(F.sequence(F.date_add(day, 1), F.date_add(day, DRIFT_DAYS)))
    based = events.select(days.alias("run"), "value").join(found.select("run", "quantiles").filter("quantiles IS NOT NULL"), "run")
    under = [F.avg((F.col("value") <= F.col("quantiles")[i]).cast("double")) for i in range(len(DR.QUANTILES))]
    near = [F.abs(u - q) <= RANK_ERROR + 1 / F.count("*") for u, q in zip(under, DR.QUANTILES)]
    ranks = based.groupBy("run").agg(F.array(*near).alias("near")).select("run", F.forall("near", lambda x: x).alias("quantiles_hold"))
    users = events.groupBy(day.alias("run")).agg(F.countDistinct("user_id").alias("users"))
    keys_hold = F.abs(F.col("keys") - F.col("users")) <= KEY_ERROR * F.col("users")
    return (found.join(ranks, "run", "left").join(users, "run")
            .select("run", "rows", "rows_before", F.coalesce("quantiles_hold", F.col("rows_before") == 0).alias("quantiles_hold"),
                    keys_hold.alias("keys_hold")))


# -- nested schemas ------------------------------------------------------------------

NESTED_EXPECTED = ("event_id bigint, who struct<user_id: bigint, kind: struct<event_type: string, value: decimal(30,2)>, email: string>, "
                   "pieces array<struct<piece: string, size: bigint>>, tags map<string, string>, seen timestamp")


def _nested(events: DataFrame) -> DataFrame:
    kind = F.struct("event_type", F.when(F.col("value") <= 100, F.col("value")).alias("value"))
    piece = lambda x: F.when(F.length(x) > 3, F.struct(x.alias("piece"), F.nullif(F.length(x), F.lit(5)).alias("size")))
    return events.select("event_id", F.when(F.col("event_type") != "error", F.struct("user_id", kind.alias("kind"))).alias("who"),
                         F.transform(F.split("props", " "), piece).alias("pieces"),
                         F.create_map(F.lit("v"), F.when(F.col("value") > 10, F.col("value"))).alias("tags"),
                         F.array("user_id").alias("seen"))


@register("nested_schema_check",
          "WITH e AS (SELECT *, CAST(event_type <> 'error' AS INTEGER) AS w FROM events), "
          "p AS (SELECT unnest(string_split(props, ' ')) AS x FROM events), "
          "n AS (SELECT count(*) AS n, CAST(sum(w) AS BIGINT) AS w, count_if(w = 1 AND value > 100)::BIGINT AS big, "
          "count_if(value <= 10)::BIGINT AS small FROM e), "
          "q AS (SELECT count(*) AS n, count_if(length(x) <= 3)::BIGINT AS short, count_if(length(x) = 5)::BIGINT AS five FROM p) "
          "SELECT t.* FROM n, q, LATERAL (VALUES "
          "('event_id', 'same', 'bigint', 'bigint', n.n, 0), ('who', 'same', 'struct', 'struct', n.n, n.n - n.w), "
          "('who.user_id', 'same', 'bigint', 'bigint', n.w, 0), ('who.kind', 'same', 'struct', 'struct', n.w, 0), "
          "('who.kind.event_type', 'same', 'string', 'string', n.w, 0), "
          "('who.kind.value', 'type_mismatch', 'decimal(30,2)', 'double', n.w, n.big), "
          "('who.email', 'missing', 'string', NULL, NULL, NULL), ('pieces', 'same', 'array', 'array', n.n, 0), "
          "('pieces[]', 'same', 'struct', 'struct', q.n, q.short), "
          "('pieces[].piece', 'same', 'string', 'string', q.n - q.short, 0), "
          "('pieces[].size', 'widened', 'bigint', 'int', q.n - q.short, q.five), "
          "('tags', 'same', 'map', 'map', n.n, 0), ('tags{key}', 'same', 'string', 'string', n.n, 0), "
          "('tags{value}', 'type_mismatch', 'string', 'double', n.n, n.small), "
          "('seen', 'type_mismatch', 'timestamp', 'array', n.n, 0)) "
          "t(path, kind, expected_type, actual_type, instances, nulls)")
def nested_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested rows against a nested expected schema: one row per path, with its values counted."""
    path = scratch_path(spark, "nested")
    _nested(table(spark, sf_dir, "events")).write.parquet(path)
    return nested_check(spark.read.parquet(path), NESTED_EXPECTED)
