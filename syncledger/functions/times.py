"""Remote time text <-> timestamp (T5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REMOTE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_remote_time(col) -> Column:
    """``2024-01-01T10:00:07.179Z`` -> ``2024-01-01 10:00:07`` (fraction and
    zone suffix cut, kept to the second). Text without a fraction is accepted."""
    text = F.regexp_replace(F.regexp_replace(_c(col), r"\.[^.]*$", ""), r"Z$", "")
    return F.to_timestamp_ntz(text, F.lit(REMOTE_FORMAT))


def format_remote_time(col) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ss.ffffffZ`` (microseconds and ``Z``)."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
