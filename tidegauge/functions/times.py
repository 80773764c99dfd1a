"""Time functions. All instants are UTC; arithmetic is on whole microseconds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F, types as T

# Later instants are treated as invalid.
LAST_INSTANT = "9999-12-31 23:59:59.999999"
_YEAR_FIRST = r"^\s*[+-]?\d{4}"
_FAR_FUTURE = 2**63 - 1


def instant(value: Column | dt.datetime | str) -> Column:
    """A literal instant; a text or value without zone is UTC, wherever the driver runs."""
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def int_div(a: Column, b: Column | int) -> Column:
    """Integer division, truncating."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def parse_timestamp_utc(c: Column, dtype: T.DataType, formats: tuple[str, ...] = ()) -> Column:
    """Timestamp; a text or value without zone is UTC, unparsable text is null.

    ISO forms are understood as they are, ``formats`` adds further patterns. A
    time of day without a date is no timestamp.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    text = c.cast("string")
    return F.coalesce(
        # The cast is slow on junk.
        F.when(text.rlike(_YEAR_FIRST), text.try_cast("timestamp")),
        *[F.try_to_timestamp(text, F.lit(f)) for f in formats],
    )


def add_ms(ts: Column, ms: Column) -> Column:
    """``ts`` plus ``ms`` milliseconds; an instant far in the future, instead
    of an error, when the sum is out of range."""
    micros = F.try_add(F.unix_micros(ts), F.try_multiply(ms, F.lit(1000).cast("bigint")))
    return F.timestamp_micros(F.coalesce(micros, F.lit(_FAR_FUTURE)))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def bucket_minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def bucket_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def bucket_n_minutes(ts: Column, n: int, restart_hourly: bool = False) -> Column:
    """Start of the n-minute bucket.

    Buckets run on through the hours; with ``restart_hourly`` the minute
    *field* is floored, so for n that does not divide 60 the last bucket of an
    hour is short.
    """
    if n <= 0:
        raise ValueError("n must be > 0")
    width = n * 60_000_000
    if restart_hourly:
        hour = F.unix_micros(bucket_hour(ts))
        return F.timestamp_micros(hour + int_div(F.minute(ts), n).cast("bigint") * width)
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width)))


def scale_event_time(ts: Column, factor: float, anchor_event: Column, anchor_wall: Column) -> Column:
    """Wall time of an event replayed ``factor`` times as fast."""
    if factor <= 0:
        raise ValueError("factor must be > 0")
    elapsed = F.unix_micros(ts) - F.unix_micros(anchor_event)
    return F.timestamp_micros(F.unix_micros(anchor_wall) + F.rint(elapsed / F.lit(float(factor))).cast("bigint"))
