"""Joins of result frames with configuration-sized frames.

Frames built on the driver (``createDataFrame`` of configuration rows) carry no
size statistics, so the planner cannot prove them small and plans a
sort-merge join.  ``join_small`` broadcasts such a frame when its caller knows
its row count and the bytes that follow from it are under a bound; otherwise
the join is planned by Spark from its own statistics.  Nothing is counted while
a plan is built.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed bound: at most this many bytes of configuration rows are broadcast.
BROADCAST_MAX_BYTES = 16 << 20
#: Bytes reckoned for a value without a fixed width (names, messages, expressions).
TEXT_BYTES = 200


def reckoned_bytes(df: DataFrame, rows: int) -> int:
    """An estimate on the high side of a configuration frame's size."""
    fixed = {"boolean": 1, "int": 4, "bigint": 8, "double": 8, "date": 4, "timestamp": 8}
    return rows * sum(fixed.get(t, TEXT_BYTES) + 8 for _, t in df.dtypes)


def join_small(left: DataFrame, right: DataFrame, on, how: str = "left", rows: int | None = None,
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``left.join(right)``, with ``right`` broadcast when its known ``rows`` stay under ``max_bytes``."""
    if rows is not None and reckoned_bytes(right, rows) <= max_bytes:
        right = F.broadcast(right)
    return left.join(right, on, how)


def lookup(mapping: Mapping[str, object], key: Column) -> Column:
    """``mapping[key]`` as a map-literal column (NULL when absent): a join with
    a small dictionary compiled into the projection, no shuffle at all."""
    if not mapping:
        return F.lit(None)
    return F.element_at(F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]), key)
