from quakelake.operators import analytics
from quakelake.operators.checked import (
    checked_rows,
    explode_raw_features,
    lost_rows,
    outcomes,
    rejected_rows,
    strict_rows,
    tolerant_rows,
    with_derived,
)
from quakelake.operators.flatten import (
    explode_features,
    flatten_features,
    plain_outcomes,
    plain_silver,
    with_area,
    with_text_times,
)
from quakelake.operators.merge import (
    distinct_keys,
    matched_keys,
    ordered_by_key,
    rows_also_in,
    rows_only_in,
    unmatched_rows,
    upsert,
)

__all__ = [
    "analytics",
    "checked_rows",
    "distinct_keys",
    "explode_features",
    "explode_raw_features",
    "flatten_features",
    "lost_rows",
    "matched_keys",
    "ordered_by_key",
    "outcomes",
    "plain_outcomes",
    "plain_silver",
    "rejected_rows",
    "rows_also_in",
    "rows_only_in",
    "strict_rows",
    "tolerant_rows",
    "unmatched_rows",
    "upsert",
    "with_area",
    "with_derived",
    "with_text_times",
]
