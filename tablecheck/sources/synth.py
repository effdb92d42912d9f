"""Synthetic transactions, user profiles and event logs with injected faults.

Rows are generated by Spark from an id column (``spark.range(n)`` or any
DataFrame's key column), never on the driver.  Every random draw is a hash of
``(id, seed, salt)``, so a rerun, a different partitioning or a lost executor
recomputes identical rows.

Fault model (each row is faulty with probability ``fault_rate``; the kind is
drawn uniformly):

* transactions: ``null`` (user_id NULL), ``range`` (amount -50), ``regex``
  (half: id ``INVALID<n>``, half: status ``UNKNOWN``), ``future`` (timestamp
  one year after ``as_of``);
* users: ``null`` (email NULL), ``range_age`` (age 150), ``range_balance``
  (balance -1000), ``regex`` (half: id ``INVALID<n>``, half: email
  ``not-email``);
* event logs: a faulty document holds only ``event_id``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Value domains and id formats of the generated data.
STATUSES = ["COMPLETED", "PENDING", "FAILED", "REFUNDED"]
EVENT_TYPES = ["page_view", "click", "purchase", "logout"]
TXN_FAULTS = ["null", "range", "regex", "future"]
USER_FAULTS = ["null", "range_age", "range_balance", "regex"]
TXN_ID_BASE = 1000000000
USER_ID_BASE = 10000000
DEFAULT_FAULT_RATE = 0.05
# Default volumes per mode (transactions, users, log files).
VOLUMES = {"initial": (1000, 500, 100), "append": (100, 50, 10)}

_SCALE = 1 << 30


def _u(idc: Column, seed: int, salt: int) -> Column:
    """Uniform [0, 1) from a hash of (id, seed, salt)."""
    return F.pmod(F.xxhash64(idc, F.lit(seed), F.lit(salt)), F.lit(_SCALE)).cast("double") / float(_SCALE)


def _pick(values: list[str], u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(u * len(values)) + 1).cast("int"))


def _ids(spark: SparkSession, num_rows: int | None, ids: DataFrame | None, id_col: str) -> DataFrame:
    if ids is not None:
        return ids.select(F.col(id_col).cast("bigint").alias("id"))
    if num_rows is None:
        raise ValueError("give num_rows or ids")
    return spark.range(num_rows)


def _ts(v) -> Column:
    if v is None:
        return F.current_timestamp()
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        v = v.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(v).cast("timestamp")


def _between(start: Column, end: Column, u: Column) -> Column:
    secs = F.unix_micros(end) - F.unix_micros(start)
    return F.timestamp_micros(F.unix_micros(start) + (u * secs).cast("bigint"))


def generate_transactions(spark: SparkSession, num_rows: int | None = None, start_time=None, end_time=None,
                          ids: DataFrame | None = None, id_col: str = "id", fault_rate: float = DEFAULT_FAULT_RATE,
                          seed: int = 42, as_of=None, with_fault_kind: bool = False) -> DataFrame:
    """Transactions over ``[start_time, end_time)`` (default: the 7 days before ``as_of``)."""
    now = _ts(as_of)
    end = _ts(end_time) if end_time is not None else now
    start = _ts(start_time) if start_time is not None else now - F.make_dt_interval(F.lit(7))
    base = _ids(spark, num_rows, ids, id_col)
    i = F.col("id")
    uid = i + TXN_ID_BASE
    faulty = _u(i, seed, 1) < fault_rate
    kind = F.when(faulty, _pick(TXN_FAULTS, _u(i, seed, 2)))
    bad_id = (kind == "regex") & (_u(i, seed, 3) < 0.5)
    bad_status = (kind == "regex") & ~bad_id
    good_amount = 0.01 + _u(i, seed, 5) * (10000 - 0.01)
    fault_amount = 10 + _u(i, seed, 5) * 990
    out = base.select(
        F.when(bad_id, F.concat(F.lit("INVALID"), uid.cast("string")))
         .otherwise(F.format_string("TXN%010d", uid)).alias("transaction_id"),
        F.when(kind == "null", F.lit(None).cast("string"))
         .otherwise(F.format_string("USR%08d", (F.floor(_u(i, seed, 4) * 90000000) + 10000000).cast("bigint")))
         .alias("user_id"),
        F.when(kind == "range", F.lit(-50.0)).when(faulty, fault_amount).otherwise(good_amount).alias("amount"),
        F.when(kind == "future", now + F.make_dt_interval(F.lit(365)))
         .otherwise(_between(start, end, _u(i, seed, 6))).alias("transaction_timestamp"),
        F.when(bad_status, F.lit("UNKNOWN")).otherwise(_pick(STATUSES, _u(i, seed, 7))).alias("status"),
        F.concat(F.lit("M"), (F.floor(_u(i, seed, 8) * 9000) + 1000).cast("bigint").cast("string"))
         .alias("merchant_id"),
        F.lit("RETAIL").alias("category"),
        F.when(bad_id, F.lit("regex_id")).when(bad_status, F.lit("regex_status")).otherwise(kind)
         .alias("fault_kind"),
    )
    return out if with_fault_kind else out.drop("fault_kind")


def generate_users(spark: SparkSession, num_rows: int | None = None, start_time=None, end_time=None,
                   ids: DataFrame | None = None, id_col: str = "id", fault_rate: float = DEFAULT_FAULT_RATE,
                   seed: int = 42, as_of=None, with_fault_kind: bool = False) -> DataFrame:
    """User profiles updated over ``[start_time, end_time)`` (default: the hour before ``as_of``)."""
    now = _ts(as_of)
    end = _ts(end_time) if end_time is not None else now
    start = _ts(start_time) if start_time is not None else now - F.make_dt_interval(F.lit(0), F.lit(1))
    base = _ids(spark, num_rows, ids, id_col)
    i = F.col("id")
    uid = i + USER_ID_BASE
    faulty = _u(i, seed, 11) < fault_rate
    kind = F.when(faulty, _pick(USER_FAULTS, _u(i, seed, 12)))
    bad_id = (kind == "regex") & (_u(i, seed, 13) < 0.5)
    bad_email = (kind == "regex") & ~bad_id
    reg_date = F.date_add(F.to_date(now - F.make_dt_interval(F.lit(365))), F.pmod(i, F.lit(365)).cast("int"))
    out = base.select(
        F.when(bad_id, F.concat(F.lit("INVALID"), uid.cast("string")))
         .otherwise(F.format_string("USR%08d", uid)).alias("user_id"),
        F.when(kind == "null", F.lit(None).cast("string"))
         .when(bad_email, F.lit("not-email"))
         .otherwise(F.concat(F.lit("user"), uid.cast("string"), F.lit("@example.com"))).alias("email"),
        F.when(kind == "range_age", F.lit(150).cast("bigint"))
         .otherwise((F.floor(_u(i, seed, 14) * 63) + 18).cast("bigint")).alias("age"),
        reg_date.alias("registration_date"),
        F.when(kind == "range_balance", F.lit(-1000.0))
         .when(faulty, _u(i, seed, 15) * 10000).otherwise(_u(i, seed, 15) * 50000).alias("account_balance"),
        F.when(faulty, F.lit(True)).otherwise(_u(i, seed, 16) < 0.5).alias("is_active"),
        _between(start, end, _u(i, seed, 17)).alias("updated_at"),
        F.when(bad_id, F.lit("regex_id")).when(bad_email, F.lit("regex_email")).otherwise(kind)
         .alias("fault_kind"),
    )
    return out if with_fault_kind else out.drop("fault_kind")


def generate_event_logs(spark: SparkSession, num_files: int | None = None, ids: DataFrame | None = None,
                        id_col: str = "id", fault_rate: float = DEFAULT_FAULT_RATE, seed: int = 42,
                        as_of=None) -> DataFrame:
    """Event documents as columns; a faulty document has only ``event_id``
    (its other fields are NULL, which the JSON writer leaves out)."""
    now = _ts(as_of)
    base = _ids(spark, num_files, ids, id_col)
    i = F.col("id")
    ok = ~(_u(i, seed, 21) < fault_rate)
    return base.select(
        F.format_string("EVT%06d", i).alias("event_id"),
        F.when(ok, _pick(EVENT_TYPES, _u(i, seed, 22))).alias("event_type"),
        F.when(ok, F.date_format(now - F.make_dt_interval(F.lit(0), F.floor(_u(i, seed, 23) * 25).cast("int")),
                                 "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("event_time"),
        F.when(ok, F.format_string("USR%08d", (F.floor(_u(i, seed, 24) * 90000000) + 10000000).cast("bigint")))
         .alias("user_id"),
        F.when(ok, F.struct(F.concat(F.lit("value"), i.cast("string")).alias("key"))).alias("payload"),
    )


def seed_tables(spark: SparkSession, root: str, mode: str = "initial", num_transactions: int | None = None,
                num_users: int | None = None, num_logs: int | None = None, start_time=None, end_time=None,
                seed: int = 42, batch: int = 0, as_of=None) -> dict[str, str]:
    """Create (``initial``) or append to (``append``) the example data set under ``root``.

    Volumes default per mode (0 also means the default).  Ids restart in every
    batch, as with hourly appends; ``batch`` salts the draws so appended rows
    differ.  Returns the paths written.
    """
    from .files import write_json_documents
    from .tables import append_table, create_table

    if mode not in VOLUMES:
        raise ValueError(f"mode must be one of {sorted(VOLUMES)}")
    d_txn, d_usr, d_log = VOLUMES[mode]
    n_txn, n_usr, n_log = num_transactions or d_txn, num_users or d_usr, num_logs or d_log
    s = seed + 1000 * batch
    paths = {"transactions": f"{root}/transactions", "user_profiles": f"{root}/user_profiles",
             "event_logs": f"{root}/event_logs"}
    txn = generate_transactions(spark, n_txn, start_time, end_time, seed=s, as_of=as_of)
    usr = generate_users(spark, n_usr, start_time, end_time, seed=s, as_of=as_of)
    logs = generate_event_logs(spark, n_log, seed=s, as_of=as_of)
    if mode == "initial":
        create_table(spark, paths["transactions"], txn)
        create_table(spark, paths["user_profiles"], usr)
        write_json_documents(logs, paths["event_logs"], one_per_file=True, mode="overwrite")
    else:
        append_table(spark, paths["transactions"], txn)
        append_table(spark, paths["user_profiles"], usr)
        write_json_documents(logs, paths["event_logs"], one_per_file=True, mode="append")
    return paths
