"""Join helpers: broadcast only behind a size check, with a shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes that Catalyst must prove a side to stay under before it is broadcast.
BROADCAST_BYTES = 32 << 20


def planned_bytes(df: DataFrame) -> int:
    """Upper estimate of a plan's output in bytes, from file sizes and column
    types alone: no job runs. A plan that Catalyst cannot bound is huge."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a side whose statistics prove it small; otherwise the
    choice is left to Catalyst and AQE (which measures the shuffle output)."""
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df


def take_bounded(df: DataFrame, max_rows: int) -> list:
    """Collect a result whose size is fixed by a parameter, refusing more."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows; refusing to collect to the driver")
    return rows
