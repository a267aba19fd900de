"""Latest-wins upsert by key. A null key never matches; copies inside one side all stay.

Semi and anti joins need only the keys of the other side, so that side is one narrow column of
distinct keys: copies collapse before their shuffle, and a hot key arrives once. The join method
is left to Spark, which broadcasts keys it knows to be few and sort-merges the rest; adaptive
execution then splits a hot (or null) key of the wide side over many tasks.

Where a side would be shuffled whole (rows of both sides without a match, an upsert), a bit map of the keys
that both have is broadcast, and only rows that hit it are joined: the others stay where they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakelake.operators.membership import with_membership

KEY = "ids"
_PERHAPS = "_perhaps"


def distinct_keys(rows: DataFrame) -> DataFrame:
    """Each key that can match at all, once."""
    return rows.select(KEY).filter(F.col(KEY).isNotNull()).distinct()


def _join_keys(rows: DataFrame) -> DataFrame:
    """Distinct keys that the join shuffles itself.

    Adaptive execution splits a skewed partition only where both inputs come straight from the
    join's own shuffle. Appending empty text keeps the join from reusing the shuffle below
    ``distinct``, at the price of moving the narrow keys once more.
    """
    return distinct_keys(rows).select(F.concat(KEY, F.lit("")).alias(KEY))


def _shared_keys(gold: DataFrame, daily: DataFrame) -> DataFrame:
    """Keys that both sides have, for a join that shuffles them itself; see ``_join_keys``."""
    tagged = gold.select(KEY, F.lit(1).alias("side")).unionByName(daily.select(KEY, F.lit(2).alias("side")))
    sides = tagged.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.bit_or("side").alias("sides"))
    return sides.where("sides = 3").select(F.concat(KEY, F.lit("")).alias(KEY))


def _without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Left anti with distinct keys, the key first; only rows that may have one of them are shuffled."""
    marked = with_membership(rows, F.col(KEY).cast("string"), keys, F.col(KEY).cast("string"), _PERHAPS)
    sure = marked.where(~F.col(_PERHAPS)).drop(_PERHAPS)
    unsure = marked.where(_PERHAPS).drop(_PERHAPS).join(keys, [KEY], "left_anti")
    return sure.select(*unsure.columns).unionByName(unsure)


def matched_keys(gold: DataFrame, daily_keys: DataFrame) -> DataFrame:
    """The distinct keys of daily that gold has: only they remove gold rows. One column is read."""
    return gold.select(KEY).join(daily_keys, [KEY], "left_semi").distinct()


def rows_only_in(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Left anti: rows whose key ``others`` lacks."""
    return rows.join(_join_keys(others), [KEY], "left_anti")


def rows_also_in(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Left semi: rows whose key ``others`` has."""
    return rows.join(_join_keys(others), [KEY], "left_semi")


def unmatched_rows(gold: DataFrame, daily: DataFrame) -> DataFrame:
    """Rows of either side whose key the other lacks, copies included.

    One aggregate finds the keys that both sides have; of each side the rows that may have one of
    them are then joined once with those.
    """
    shared = _shared_keys(gold, daily)
    return _without(gold, shared).unionByName(_without(daily, shared))


def upsert(
    gold: DataFrame,
    daily: DataFrame,
    daily_keys: DataFrame | None = None,
    few: bool = True,
    sorted_next: bool = False,
) -> DataFrame:
    """Gold after the batch: the gold rows that daily does not replace, then all of daily.

    Daily rows new to gold and daily rows that replace something are together all of daily, so
    one anti join does the work and daily is not joined at all. The key becomes the first column.
    ``daily_keys`` are distinct keys of daily when the caller has stored them, all or those that gold has:
    a ``few`` are joined as they are, which spares gold its shuffle altogether. Else only gold rows that
    may have one of the keys are shuffled, unless all rows are to be sorted next: a sort runs what is before
    it twice, but no shuffle again.
    """
    if daily_keys is not None and few:
        kept = gold.join(daily_keys, [KEY], "left_anti")
    elif sorted_next:
        kept = gold.join(_join_keys(daily if daily_keys is None else daily_keys), [KEY], "left_anti")
    else:
        kept = _without(gold, _shared_keys(gold, daily) if daily_keys is None else _join_keys(daily_keys))
    return kept.unionByName(daily)


def ordered_by_key(rows: DataFrame, *tie_break: str) -> DataFrame:
    """Total order by key, nulls first.

    Rows with equal sort values end up in one task. Name tie-break columns to let a hot key
    spread; a row's file and position in it tell even copies apart.
    """
    return rows.orderBy(F.asc_nulls_first(KEY), *tie_break)
