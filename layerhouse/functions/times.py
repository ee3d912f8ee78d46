"""Business dates and times.  Dates are DateType throughout; strings are parsed at the source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

OPEN_END = dt.date(9999, 12, 31)


def business_date(text: str | dt.date) -> dt.date:
    """A run date from either partition format, ``yyyy-MM-dd`` or ``yyyyMMdd``."""
    if isinstance(text, dt.datetime):
        return text.date()
    if isinstance(text, dt.date):
        return text
    return dt.datetime.strptime(text, "%Y-%m-%d" if "-" in text else "%Y%m%d").date()


def parse_date(value: Column) -> Column:
    """A date column from text in either format; unreadable text becomes null."""
    return F.coalesce(
        F.to_date(F.try_to_timestamp(value, F.lit("yyyy-MM-dd"))),
        F.to_date(F.try_to_timestamp(value, F.lit("yyyyMMdd"))),
    )


def from_epoch_ms(value: Column, zone: str | None = None) -> Column:
    """Timestamp of an epoch-milliseconds column (text or number), shown in ``zone``."""
    stamp = F.timestamp_millis(value.try_cast("bigint"))
    return F.from_utc_timestamp(stamp, zone) if zone else stamp


def from_iso(value: Column) -> Column:
    """Timestamp from ISO text, ignoring the zone tail: date and wall-clock time as written."""
    wall = F.concat(F.substring(value, 1, 10), F.lit(" "), F.substring(value, 12, 8))
    return wall.try_cast("timestamp")


def as_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")


def within(column: Column, as_of: dt.date, days: int) -> Column:
    """True for the ``days`` calendar days ending at ``as_of``; both bounds reach the scan."""
    return column.between(F.lit(as_of - dt.timedelta(days=days - 1)), F.lit(as_of))
