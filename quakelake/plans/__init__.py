from quakelake.plans.jobs import (
    gold_since_week,
    kept_rows,
    load_daily,
    load_historic,
    load_tolerant,
    merge_gold,
    set_aside,
    stamp,
    with_load_time,
)

__all__ = [
    "gold_since_week",
    "kept_rows",
    "load_daily",
    "load_historic",
    "load_tolerant",
    "merge_gold",
    "set_aside",
    "stamp",
    "with_load_time",
]
