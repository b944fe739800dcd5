"""Window alignment and snapshot names, independent of the session time zone."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

DAY_MS = 86_400_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def window_start(time_ms: Column, window_ms: int) -> Column:
    """Start of the epoch-aligned tumbling window that holds the instant."""
    return time_ms - F.pmod(time_ms, F.lit(window_ms))


def align_from(from_ms: int | Column, window_ms: int) -> int | Column:
    """Lower query bound moved back to the start of its aggregation window."""
    if isinstance(from_ms, Column):
        return window_start(from_ms, window_ms)
    return from_ms - from_ms % window_ms


def query_range(now_ms: int, window_ms: int, from_ms: int | None = None, to_ms: int | None = None) -> tuple[int, int]:
    """Bounds of a graph query: the last 24 hours unless given, the lower one aligned."""
    lower = now_ms - DAY_MS if from_ms is None else from_ms
    return align_from(lower, window_ms), now_ms if to_ms is None else to_ms


def window_date(start_ms: Column) -> Column:
    """UTC day of a window start, the partition column of the windowed-edge table."""
    day = F.floor(start_ms / F.lit(DAY_MS)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), day).cast("string")


def date_of(ms: int) -> str:
    return (_EPOCH + timedelta(milliseconds=ms)).strftime("%Y-%m-%d")


def midnight_of(date: str) -> int:
    return int((datetime.strptime(date, "%Y-%m-%d").replace(tzinfo=timezone.utc) - _EPOCH) / timedelta(milliseconds=1))


def snapshot_name(instant_ms: Column) -> Column:
    """ISO-8601 instant with three fraction digits; sorts as text in time order."""
    rest = F.pmod(instant_ms, F.lit(DAY_MS))
    part = lambda unit, size: F.call_function("div", F.pmod(rest, F.lit(unit * size)), F.lit(unit))
    return F.format_string(
        "%sT%02d:%02d:%02d.%03dZ",
        window_date(instant_ms), part(3_600_000, 24), part(60_000, 60), part(1_000, 60), part(1, 1_000),
    )


def snapshot_name_of(instant_ms: int) -> str:
    moment = _EPOCH + timedelta(milliseconds=instant_ms)
    return moment.strftime("%Y-%m-%dT%H:%M:%S.") + f"{instant_ms % 1000:03d}Z"
