"""Date and time expressions over a timestamp column, with or without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(ts: str) -> Column:
    """First instant of the month, without a time zone."""
    return F.date_trunc("month", F.col(ts)).cast("timestamp_ntz")


def calendar_parts(ts: str, prefix: str) -> list[Column]:
    """``<prefix>_year``, ``_month``, ``_day`` and ``_weekday`` (1 = Sunday)."""
    return [
        F.year(ts).alias(f"{prefix}_year"),
        F.month(ts).alias(f"{prefix}_month"),
        F.dayofmonth(ts).alias(f"{prefix}_day"),
        F.dayofweek(ts).alias(f"{prefix}_weekday"),
    ]


def minutes_between(start: str, end: str) -> Column:
    """Minutes from ``start`` to ``end``, two decimals."""
    return F.round((F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60), 2)


def weekday_name(ts: str) -> Column:
    """Full English weekday name."""
    return F.date_format(ts, "EEEE")
