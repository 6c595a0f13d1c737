"""The change feed: batch filters (F5, V4) shared by the streaming jobs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _whole_second(ts) -> str:
    if isinstance(ts, str):
        ts = _dt.datetime.fromisoformat(ts.replace("Z", ""))
    return ts.replace(microsecond=0, tzinfo=None).isoformat(sep=" ")


def changed_since(changes: DataFrame, last_sync, time_col: str = "modified_time") -> DataFrame:
    """Keep events whose modified time, cut to the second, is not
    older than the last sync time (itself kept to the second).

    With a whole-second threshold, ``trunc(t) >= s`` is ``t >= s``, so the
    comparison is on the raw column and can be pushed into the scan. Events
    without a time are dropped.
    """
    threshold = F.expr(f"TIMESTAMP_NTZ'{_whole_second(last_sync)}'")
    return changes.filter(F.col(time_col) >= threshold)
