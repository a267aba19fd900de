"""The composite jobs. Each parses its documents once and goes on from stored columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakelake.files import stored_bytes
from quakelake.functions.times import load_time, load_time_text, week_before
from quakelake.operators.checked import (
    KEPT,
    OUTCOME,
    checked_rows,
    explode_raw_features,
    outcomes,
    with_derived,
)
from quakelake.operators.flatten import plain_outcomes
from quakelake.operators.merge import KEY, distinct_keys, matched_keys, ordered_by_key, upsert
from quakelake.schema import REJECTS
from quakelake.session import MIB, sized_shuffles
from quakelake.sources.silver_lines import outcome_lines, read_silver, silver_lines
from quakelake.sources.tables import POSITION, EmptyBatchError, VersionedTable, with_position

# Gold questions about recent days skip row groups by the event time.
GOLD_CLUSTER = ("time",)
LOAD_TIME = "insert_dt"
# Bounds of these are known for each file of gold: by key for the merge, by time for recent days.
GOLD_INDEX = (KEY, "time")
# Keys within both bounds go to every executor: some hundred MB there, against a shuffle of gold.
# The bytes are those of the stored, compressed keys.
BROADCAST_KEYS = 4_000_000
BROADCAST_BYTES = 64 * MIB


def with_load_time(rows: DataFrame, at: str | None = None) -> DataFrame:
    """The load timestamp, replacing an earlier one; now, unless a rerun names its instant."""
    return rows.withColumn(LOAD_TIME, load_time(at))


def stamp(at: str | None = None) -> dict[str, tuple[str, str]]:
    """The load timestamp as a stamp of the table: all rows have it, and none is rewritten for it."""
    return {LOAD_TIME: ("timestamp", at or dt.datetime.now(dt.timezone.utc).isoformat())}


def gold_since_week(gold: VersionedTable, as_of: dt.date | str | None = None) -> DataFrame:
    """The rows of the files of gold that may hold events since seven days before ``as_of``.

    The bounds of the time tell; years beyond 9999 start with a plus sign, which sorts first.
    """
    if not gold.is_indexed():
        return gold.read()
    late = (F.col("time_max") >= week_before(as_of)) | F.col("time_min").startswith("+")
    return gold.read_files(gold.files_where(late))


def kept_rows(silver: VersionedTable) -> DataFrame:
    """Plain silver: the 31 columns of the kept features."""
    rows = silver.read()
    return rows.where(F.col(OUTCOME) == KEPT).drop(*REJECTS.names, OUTCOME)


def set_aside(silver: VersionedTable) -> DataFrame:
    """(outcome, raw, reason) of what plain silver rejected, and of kept features that lost values."""
    return silver.read().where(F.col(OUTCOME) != KEPT).select(OUTCOME, *REJECTS.names)


def load_historic(
    lines: DataFrame, silver: VersionedTable, gold: VersionedTable, at: str | None = None
) -> DataFrame:
    """Documents to silver, and silver with a load time as the whole of gold.

    One pass writes kept rows and, beside them, what was rejected or lost.
    """
    silver.replace(plain_outcomes(lines))
    return gold.replace(kept_rows(silver), cluster_by=GOLD_CLUSTER, stamps=stamp(at), index_by=GOLD_INDEX)


def load_daily(
    lines: DataFrame, silver: VersionedTable, gold_daily: VersionedTable, at: str | None = None
) -> DataFrame:
    """Documents to daily silver, and that with a load time to daily gold."""
    silver.replace(plain_outcomes(lines))
    return gold_daily.replace(with_load_time(kept_rows(silver), at))


def _few(table: VersionedTable) -> bool:
    """Whether the counted rows and bytes of stored keys allow a broadcast."""
    return (
        table.row_count() <= BROADCAST_KEYS
        and stored_bytes(table.spark, table.location()) <= BROADCAST_BYTES
    )


def merge_gold(
    gold: VersionedTable,
    gold_daily: VersionedTable,
    daily_keys: VersionedTable,
    allow_empty: bool = False,
    ordered: bool = False,
    at: str | None = None,
) -> DataFrame:
    """Upsert the daily batch into gold, stamping every row with this load's time.

    Only files of gold that hold a key of the batch are rewritten, without the rows it replaces; the
    batch itself is added in new files, all others stay, and the load time is a stamp of the commit.
    So the work follows the batch and what it touches, not gold.

    The distinct daily keys are stored first, so their size is known before a join is planned:
    few keys are broadcast and gold is not shuffled. Of more keys, those that gold has are stored
    instead, found by reading its key column alone: only they remove rows, and most daily keys are
    new. If even they are many, both sides are shuffled by key and adaptive execution splits hot
    keys. Each shuffle is sized by what it moves. The content is the same each way.
    ``ordered`` writes all of gold anew in a total order by key, which makes the bounds of its files
    narrow. So does the first merge into a table that has no index.
    """
    if gold_daily.row_count() == 0 and not allow_empty:
        raise EmptyBatchError("refusing to merge an empty daily batch")
    keys = daily_keys
    keys.replace(distinct_keys(gold_daily.read()), allow_empty=True)
    if not _few(keys):
        matched = VersionedTable(keys.spark, f"{keys.path}_matched")
        matched.replace(matched_keys(gold.read(), keys.read()), allow_empty=True)
        keys = matched
    few = _few(keys)
    known = F.broadcast(keys.read()) if few else keys.read()
    daily = gold_daily.read().drop(LOAD_TIME)
    with sized_shuffles(gold.spark, 0 if few and not ordered else gold.stored_bytes()):
        if gold.is_indexed() and not ordered:
            touched = gold.files_with(KEY, known, keys.row_count())
            history = gold.read_files(touched).drop(LOAD_TIME)
            return gold.rewrite(touched, upsert(history, daily, known, few), cluster_by=GOLD_CLUSTER, stamps=stamp(at))
        history = gold.read().drop(LOAD_TIME)
        if ordered:
            history, daily = with_position(history), with_position(daily)
            merged, cluster = ordered_by_key(upsert(history, daily, known, few, sorted_next=True), *POSITION).drop(*POSITION), ()
        else:
            merged, cluster = upsert(history, daily, known, few), GOLD_CLUSTER
        return gold.replace(merged, cluster_by=cluster, allow_empty=allow_empty, stamps=stamp(at), index_by=GOLD_INDEX)


def load_tolerant(
    lines: DataFrame,
    silver_path: str,
    gold: VersionedTable,
    allow_empty: bool = False,
    at: str | None = None,
) -> DataFrame:
    """Document lines to checked JSON-lines silver with its rejects, then to a replaced gold.

    One pass writes kept, rejected and lost rows; gold is loaded from the kept ones. A batch without
    a kept row, or one that fails, leaves silver and gold as they were.
    """
    spark: SparkSession = lines.sparkSession
    checked = with_derived(checked_rows(explode_raw_features(lines)))
    silver_lines(spark, silver_path).replace(outcome_lines(outcomes(checked)), allow_empty=allow_empty)
    rows = read_silver(spark, silver_path).withColumn("insert_date", load_time_text(at))
    return gold.replace(rows, allow_empty=allow_empty)
