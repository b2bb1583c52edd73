"""Time columns from epoch values and timestamps."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

MILLIS_FROM = 1_000_000_000_000


def epoch_timestamp(epoch: Column) -> Column:
    """Epoch seconds, or milliseconds where the value exceeds 10**12, as a timestamp."""
    seconds = F.when(epoch > MILLIS_FROM, F.floor(epoch / 1000)).otherwise(epoch)
    return F.timestamp_seconds(seconds.cast("long"))


def epoch_within(epoch: Column, first_day: str, last_day: str) -> Column:
    """Whether an epoch, in seconds or milliseconds, may lie on first_day..last_day (UTC).

    Plain comparisons of the stored column, which a scan can use to skip row groups. It may let
    too much pass, never too little; the exact test is on the date.
    """
    low = int(datetime.fromisoformat(first_day).replace(tzinfo=timezone.utc).timestamp())
    high = int((datetime.fromisoformat(last_day) + timedelta(days=1)).replace(tzinfo=timezone.utc).timestamp())
    seconds = (epoch >= low) & (epoch < high)
    millis = (epoch >= low * 1000) & (epoch < high * 1000)
    return seconds | millis


def bucket_columns(ts: Column) -> dict[str, Column]:
    """Hour, weekday (1 = Sunday), month and year of a timestamp."""
    return {
        "hour": F.hour(ts),
        "dow": F.dayofweek(ts),
        "mon": F.month(ts),
        "yr": F.year(ts),
    }


def month_number(ts: Column) -> Column:
    return F.year(ts) * 100 + F.month(ts)


def month_text(ts: Column) -> Column:
    """``yyyy-MM``; padded so that it sorts by time."""
    return F.date_format(ts, "yyyy-MM")


def period_label(day: Column, event_day: str, before: str, after: str) -> Column:
    return F.when(day < F.to_date(F.lit(event_day)), before).otherwise(after)
