"""Streaming aggregates. The same functions accept batch frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, columns: list[str]) -> DataFrame:
    """Running count per key. Each batch is pre-counted before the shuffle."""
    return df.groupBy(*columns).count()


def windowed_count(
    df: DataFrame,
    ts: str,
    keys: list[str],
    window_duration: str,
    slide_duration: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Count per event-time window and key; tumbling without ``slide_duration``.

    Without a watermark every late row counts and state is kept for ever. With one,
    a window closes when it falls behind and its state is dropped.
    """
    if watermark:
        df = df.withWatermark(ts, watermark)
    return df.groupBy(F.window(ts, window_duration, slide_duration), *keys).count()


def observe_rejects(df: DataFrame, ts: str, name: str = "rides") -> DataFrame:
    """Per-batch ``rows`` and ``rejected`` (no usable event time) in the query progress."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(ts).isNull()).alias("rejected"),
    )
