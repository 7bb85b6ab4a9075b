"""Stream form of the day series. The day series groups by the date of the event time, so it needs no change to run on
a stream; nothing else of the library is tied to streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..operators.timeline import daily_series


def stream_daily_series(events: DataFrame, ts: str, value: str, mask: Column, delay: str = "1 day"):
    """Day series of a streaming frame with a watermark on the event time."""
    return daily_series(events.withWatermark(ts, delay) if events.isStreaming else events, ts, value, mask)
