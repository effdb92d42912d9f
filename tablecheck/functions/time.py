"""Zone-independent conversions between wall-clock and instant timestamps.

Structured Streaming watermarks need ``TIMESTAMP`` (an instant) while the
tables hold ``TIMESTAMP_NTZ`` (a wall-clock time).  A plain cast interprets
the wall clock in the session time zone, which shifts hourly windows in zones
with half-hour offsets and moves times that fall in a DST gap.  These helpers
read the wall clock as UTC instead, so window boundaries always fall on the
wall clock's own hours, whatever the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_as_utc_instant(c: Column) -> Column:
    """TIMESTAMP_NTZ wall clock -> TIMESTAMP instant of that wall clock in UTC."""
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def utc_instant_as_ntz(c: Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ of its UTC wall clock (inverse of the above)."""
    secs = (F.unix_micros(c).cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)")
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
