"""ISO-8601 text to timestamps and back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_timestamp(text: Column) -> Column:
    """ISO text, with or without zone, to a timestamp; NULL where it does not parse."""
    return text.try_cast("timestamp")


def iso_format(ts: Column) -> Column:
    """``2024-01-01T00:00:07.179575``; the fraction is left out when it is zero."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")
