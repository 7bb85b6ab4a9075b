"""Date and time features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def date_parts(ts: str) -> list[Column]:
    """Date, day of week (Monday 0), day of month and ISO week."""
    return [
        F.to_date(ts).alias("date"),
        F.weekday(ts).alias("dayofweek"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
    ]


def time_class(ts) -> Column:
    """Part of the day by the hour: night to 7, morning to 12, afternoon to 18, then evening."""
    hour = F.hour(ts)
    return (
        F.when(hour <= 7, "night").when(hour <= 12, "morning").when(hour <= 18, "afternoon").otherwise("evening")
    )


def holiday_flag(date, ranges: Sequence[tuple[str, str]]) -> Column:
    """1 where the date lies in one of the closed ranges."""
    day = F.to_date(date)
    hit = F.lit(False)
    for first, last in ranges:
        hit = hit | day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return hit.cast("int")
