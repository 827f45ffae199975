"""Event time as epoch milliseconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.params import DAY_MS

# The two text forms of event time (posts and comments; likes).
TIME_PATTERNS = {
    "seconds": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$",
    "millis": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$",
}


def with_event_time(df: DataFrame, col: str, fmt: str, out: str = "ts_ms") -> DataFrame:
    """Parse UTC text to epoch milliseconds; text of another form becomes null."""
    text = F.col(col)
    parsed = F.when(text.rlike(TIME_PATTERNS[fmt]), text).try_cast("timestamp")
    return df.withColumn(out, F.unix_millis(parsed))


def epoch_ms(df: DataFrame, col: str) -> Column:
    """Epoch milliseconds of a timestamp column; zone-less values count as UTC."""
    c = F.col(col)
    if not isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return F.unix_millis(c)
    seconds = F.date_part(F.lit("SECOND"), c)
    return (
        F.unix_date(c.cast("date")).cast("long") * DAY_MS
        + F.hour(c) * 3_600_000
        + F.minute(c) * 60_000
        + F.floor(seconds * 1000).cast("long")
    )


def floor_to(ms: Column, step_ms: int) -> Column:
    """Start of the step that holds ``ms`` (times are not negative)."""
    return ms - ms % F.lit(step_ms)


def window_ends(ms: Column, window_ms: int, slide_ms: int) -> Column:
    """Array of the ends of all sliding windows that hold ``ms``."""
    first = floor_to(ms, slide_ms)
    return F.array(*[first + F.lit(slide_ms * i) for i in range(1, window_ms // slide_ms + 1)])


def as_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)
