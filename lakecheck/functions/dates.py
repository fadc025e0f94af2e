"""Date keys and run identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: text patterns of the date-dimension weekday and of run ids
WEEKDAY_PATTERN = "EEEE"              # full English weekday name, e.g. "Wednesday"
RUN_ID_PATTERN = "yyyyMMdd_HHmmss"    # e.g. 20250601_000000


def date_key(d: Column) -> Column:
    """Integer ``yyyyMMdd`` key of a date, by arithmetic (no string round trip)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def weekday_name(d: Column) -> Column:
    return F.date_format(d, WEEKDAY_PATTERN)


def run_id_of(ts: Column) -> Column:
    """Run id text of a timestamp column."""
    return F.date_format(ts, RUN_ID_PATTERN)
