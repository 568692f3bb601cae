"""Date helpers (H4, H6-H9).  ``as_of`` replaces the wall clock everywhere."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two text formats used for dates and date-times.
SHORT_DATE_FORMAT = "yyyy-MM-dd"
LONG_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Days per unit (month = 30, year = 365).
UNIT_DAYS = {"day": 1, "month": 30, "year": 365}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_text_to_int(text) -> Column:
    """H4: ``1982-01-11`` -> 19820111; text that is not a number afterwards -> null."""
    return F.regexp_replace(_c(text), "-", "").try_cast("int")


def date_to_int(col) -> Column:
    """Typed date/timestamp -> yyyyMMdd int (same value as H4 on its text)."""
    return F.date_format(_c(col), "yyyyMMdd").try_cast("int")


def epoch_to_text(epoch, fmt: str = LONG_DATE_FORMAT) -> Column:
    """H6: epoch seconds (number or text) -> formatted text in the session time zone."""
    return F.from_unixtime(_c(epoch).try_cast("long"), fmt)


def epoch_day_start(day) -> Column:
    """Epoch seconds of midnight UTC of a date: days since 1970-01-01 * 86400."""
    return F.datediff(_c(day).cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400


def shift_to_midnight_epoch(col, days: int) -> Column:
    """H7: move a date-time by ``days`` and truncate to midnight, as epoch seconds (UTC)."""
    return epoch_day_start(F.date_add(_c(col).cast("date"), days))


def shift_epoch_to_midnight(epoch, days: int) -> Column:
    """H7 on epoch-second input (the order table's finish time)."""
    return shift_to_midnight_epoch(F.timestamp_seconds(_c(epoch).try_cast("long")), days)


def days_since(col, as_of: str) -> Column:
    """H8: whole days from ``col`` to ``as_of`` (date boundaries crossed)."""
    return F.datediff(F.lit(as_of).cast("date"), _c(col).cast("date"))


def format_date(col, fmt: str = SHORT_DATE_FORMAT) -> Column:
    """H9: format a date/time column as text."""
    return F.date_format(_c(col), fmt)


def parse_date(text, fmt: str = SHORT_DATE_FORMAT) -> Column:
    """H9: parse text to a date; bad text -> null."""
    return F.try_to_timestamp(_c(text), F.lit(fmt)).cast("date")


def add_days(col, days) -> Column:
    """H9: date + n days (n may be a Column)."""
    return F.date_add(_c(col).cast("date"), days)


def window_start(as_of: str, amount, unit: str = "day") -> Column:
    """H9/A4 as a Column: (as_of - 1 day) - amount * days(unit), as yyyy-MM-dd text."""
    if unit not in UNIT_DAYS:
        raise ValueError(f"unknown unit {unit!r}")
    amount = F.lit(amount) if isinstance(amount, int) else _c(amount)
    yesterday = F.date_sub(F.lit(as_of).cast("date"), 1)
    return F.date_format(F.date_sub(yesterday, (amount * UNIT_DAYS[unit]).cast("int")),
                         SHORT_DATE_FORMAT)


def yesterday_text(as_of: str) -> str:
    """Driver-side scalar: as_of - 1 day as yyyy-MM-dd."""
    return (_dt.date.fromisoformat(as_of) - _dt.timedelta(days=1)).isoformat()
