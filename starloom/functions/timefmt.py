"""ISO-8601 text and millisecond arithmetic on timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_millis(ts: str | Column) -> Column:
    """``2024-01-01T00:00:07.179Z`` (UTC session, milliseconds, Z suffix)."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def millis_between(start: str | Column, end: str | Column) -> Column:
    """Whole milliseconds from start to end, the difference truncated toward zero."""
    micros = F.unix_micros(_col(end)) - F.unix_micros(_col(start))
    # integral division truncates toward zero like int(seconds * 1000)
    return F.when(micros >= 0, F.floor(micros / 1000)).otherwise(-F.floor(-micros / 1000)).cast("long")
