"""Date-time helpers; every one uses the session zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

STAMP = "yyyy-MM-dd HH:mm:ss"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, b: int) -> Column:
    """Integer division of whole numbers, cut towards zero."""
    return F.call_function("div", a, F.lit(b))


def stamp(ts: Column | str) -> Column:
    """Timestamp to ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(col(ts), STAMP)


def _has_time(text: Column) -> Column:
    return F.contains(text, F.lit(" "))


def parse_stamp(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to timestamp; a malformed value fails the job.

    The plain cast is many times faster than a pattern; it would also take a
    bare date, so values without a time part go to the pattern, which refuses.
    """
    c = col(text)
    return F.when(_has_time(c), c.cast("timestamp")).otherwise(F.to_timestamp(c, STAMP))


def parse_stamp_or(text: Column | str, fallback: Column) -> Column:
    """Event time from text, or the record's own time where the text is malformed."""
    c = col(text)
    return F.coalesce(F.when(_has_time(c), c.try_cast("timestamp")), fallback)


def stamp_millis(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to epoch milliseconds."""
    return F.unix_millis(parse_stamp(text))


def millis_time(ms: Column | str) -> Column:
    """Epoch milliseconds to timestamp, keeping the milliseconds."""
    return F.timestamp_millis(col(ms))


def second_time(ms: Column | str) -> Column:
    """Epoch milliseconds to timestamp, cut to whole seconds (SQL tables' ``rt``)."""
    return F.timestamp_seconds(int_div(col(ms), 1000))


def day_of(ms: Column | str) -> Column:
    """Epoch milliseconds to DATE."""
    return F.to_date(millis_time(ms))


def day_number(ts: Column | str) -> Column:
    """Timestamp or stamp text to the integer day key yyyyMMdd."""
    return F.date_format(col(ts), "yyyyMMdd").cast("int")


def create_parts(create_time: Column | str) -> tuple[Column, Column, Column]:
    """(create_date, create_hour, create_ts) of an order's creation stamp."""
    c = col(create_time)
    halves = F.split(c, " ")
    return halves[0], F.split(halves[1], ":")[0], stamp_millis(c)


def age_years(birthday: Column | str, as_of: Column | None = None) -> Column:
    """Whole 365-day years from the birthday to ``as_of`` (default: now)."""
    now = as_of if as_of is not None else F.current_timestamp()
    lived = F.unix_millis(now) - F.unix_millis(F.to_timestamp(F.to_date(col(birthday))))
    return int_div(lived, 365 * 24 * 3600 * 1000).cast("int")


def now_millis(as_of: int | None = None) -> Column:
    """Processing time in milliseconds at second precision, or a fixed value."""
    if as_of is not None:
        return F.lit(as_of).cast("bigint")
    return F.unix_timestamp(F.current_timestamp()) * F.lit(1000)
