"""Tumbling, sliding and chained event-time windows. They run on batch and stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _millis(ms: int) -> str:
    return f"{ms} milliseconds"


def tumbling_counts(df: DataFrame, ts: str, size_ms: int, *keys: str) -> DataFrame:
    """(window, keys, n) over disjoint windows."""
    return df.groupBy(F.window(ts, _millis(size_ms)), *keys).agg(F.count("*").alias("n"))


def sliding_counts(df: DataFrame, ts: str, size_ms: int, slide_ms: int, *keys: str) -> DataFrame:
    """(window, keys, n) over overlapping windows."""
    return df.groupBy(F.window(ts, _millis(size_ms), _millis(slide_ms)), *keys).agg(F.count("*").alias("n"))


def chained_sums(windowed: DataFrame, size_ms: int, slide_ms: int, *keys: str) -> DataFrame:
    """Sum window results again over sliding windows of their own event time."""
    return windowed.groupBy(
        F.window(F.window_time("window"), _millis(size_ms), _millis(slide_ms)), *keys
    ).agg(F.sum("n").alias("n"))
