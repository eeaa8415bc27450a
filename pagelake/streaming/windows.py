"""Event-time windows: tumbling, sliding and session, the same for tables and for streams with a watermark.

In a stream a window goes out once, when the watermark (the latest time seen, less the delay) is past its end. A row is
dropped if its window was closed by the watermark of the batch before the last; rows that come late, but not so late, are in.
A table of the rows that came in time gives the same windows, and those still open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def watched(events: DataFrame, delay: str | None, ts: str = "ts") -> DataFrame:
    """events, with a watermark if it is a stream."""
    return events.withWatermark(ts, delay) if delay and events.isStreaming else events


def windowed(events: DataFrame, window: Column, keys: list[str], aggregates: dict[str, Column], delay: str | None = None, ts: str = "ts") -> DataFrame:
    """A row for each window and key: window_start, window_end, the keys and the aggregates."""
    grouped = watched(events, delay, ts).groupBy(window.alias("window"), *keys)
    named = [v.alias(k) for k, v in aggregates.items()]
    return grouped.agg(*named).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *aggregates)


def tumbling(events: DataFrame, width: str, keys: list[str], aggregates: dict[str, Column], delay: str | None = None, ts: str = "ts") -> DataFrame:
    return windowed(events, F.window(ts, width), keys, aggregates, delay, ts)


def sliding(events: DataFrame, width: str, step: str, keys: list[str], aggregates: dict[str, Column], delay: str | None = None, ts: str = "ts") -> DataFrame:
    return windowed(events, F.window(ts, width, step), keys, aggregates, delay, ts)


def sessions(events: DataFrame, gap: str, keys: list[str], aggregates: dict[str, Column], delay: str | None = None, ts: str = "ts") -> DataFrame:
    """Sessions of each key: rows less than gap apart; window_end is the last row's time and the gap."""
    return windowed(events, F.session_window(ts, gap), keys, aggregates, delay, ts)
