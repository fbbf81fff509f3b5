"""Event time that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp without time zone, read as UTC."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")


def instant(ts: str) -> Column:
    """The same moment as a timestamp with time zone, as watermarks need it."""
    return F.timestamp_micros(epoch_micros(ts))
