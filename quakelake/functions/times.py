"""Epoch milliseconds to text, and the date stamps built on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Years 1 to 9999: what four-digit text can show.
_FIRST_MILLIS = -62_135_596_800_000
_LAST_MILLIS = 253_402_300_799_999


def millis_to_text(millis: Column) -> Column:
    """Epoch millis as text in the session zone; fractions of a second go toward zero."""
    return F.from_unixtime(millis / 1000, TIME_FORMAT)


def millis_to_text_or_raw(value: Column) -> Column:
    """Epoch millis, as a number or numeric text, as text; anything else is kept as it is.

    Fractions of a second round down, also before 1970. Null stays null.
    """
    millis = value.try_cast("double")
    in_range = F.when(millis.between(_FIRST_MILLIS, _LAST_MILLIS), millis)
    text = F.date_format(F.timestamp_millis(F.floor(in_range)), TIME_FORMAT)
    return F.coalesce(text, value.cast("string"))


def load_time(at: str | None = None) -> Column:
    """The time of the load: now, or the instant that a rerun names."""
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def load_time_text(at: str | None = None) -> Column:
    return F.date_format(load_time(at), TIME_FORMAT)


def as_date(day: dt.date | str | None) -> Column:
    """A run date; today when none is given."""
    return F.current_date() if day is None else F.lit(str(day)).cast("date")


def date_stamp(day: dt.date | str | None = None) -> Column:
    """The run date as ``YYYYMMDD`` text."""
    return F.date_format(as_date(day), "yyyyMMdd")


def week_before(day: dt.date | str | None = None) -> Column:
    """The date seven days earlier, as text that compares like the event times."""
    return F.date_sub(as_date(day), 7).cast("string")
