from quakelake.functions.places import loose_area, strict_area
from quakelake.functions.times import (
    as_date,
    date_stamp,
    load_time,
    load_time_text,
    millis_to_text,
    millis_to_text_or_raw,
    week_before,
)

__all__ = [
    "as_date",
    "date_stamp",
    "load_time",
    "load_time_text",
    "loose_area",
    "millis_to_text",
    "millis_to_text_or_raw",
    "strict_area",
    "week_before",
]
