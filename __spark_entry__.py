
from __future__ import annotations

import importlib
import sys
import threading
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quakelake.files import packed  # noqa: E402
from quakelake.fixtures import feeds, oracle  # noqa: E402
from quakelake.functions import (  # noqa: E402
    load_time_text,
    loose_area,
    millis_to_text_or_raw,
)
from quakelake.operators import (  # noqa: E402
    analytics,
    distinct_keys,
    explode_features,
    explode_raw_features,
    flatten_features,
    lost_rows,
    ordered_by_key,
    plain_silver,
    rejected_rows,
    rows_also_in,
    rows_only_in,
    strict_rows,
    tolerant_rows,
    unmatched_rows,
    upsert,
    with_area,
    with_derived,
    with_text_times,
)
from quakelake.plans import (  # noqa: E402
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
from quakelake.session import pin_utc, shared_dir  # noqa: E402
from quakelake.sources import (  # noqa: E402
    POSITION,
    VersionedTable,
    land_documents,
    land_payloads,
    read_lost,
    read_rejects,
    read_silver,
    scan_documents,
    scan_lines,
    scan_payloads,
    scan_text,
    with_position,
    write_lines,
)

# The operators on training data are a package of their own, which may be left out.
try:
    training_data = importlib.import_module("quakelake.llm.queries")
except ImportError:
    training_data = None

RUN_DATE = "2024-01-30"
STAMP = "20240130"
AS_OF = "2024-01-27"
LOADED_AT = "2024-01-30 12:00:00"


class Lake:
    """Bronze, silver and gold of one set of tables, each stored on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = f"{shared_dir(spark)}/quakelake-{uuid.uuid4().hex}"
        self._done: set[str] = set()
        self._building = threading.RLock()

    def _once(self, step: str, build: Callable[[], object]) -> None:
        with self._building:
            if step not in self._done:
                build()
                self._done.add(step)

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}")

    def landed(self, feed: str) -> str:
        """Folder of a feed's documents, one per line under the run date."""
        path = f"{self.root}/bronze/{feed}"
        documents = getattr(feeds, feed)
        self._once(path, lambda: land_documents(documents(self.spark, self.sf_dir), path, RUN_DATE))
        return path

    def payloads(self, feed: str, plain: bool = False) -> str:
        """Folder of a feed's documents as raw multi-line files, one document per file.

        The files are compressed, unless they are to be cut.
        """
        path = f"{self.root}/raw/{feed}{'-plain' if plain else ''}"

        def build() -> None:
            writer = getattr(feeds, feed)(self.spark, self.sf_dir, separator="\n").write.mode("overwrite")
            (writer.option("maxRecordsPerFile", 1) if plain else packed(writer, 1)).text(path)

        self._once(path, build)
        return path

    def lines(self, feed: str) -> DataFrame:
        return scan_lines(self.spark, self.landed(feed), [STAMP])

    def historic(self) -> VersionedTable:
        """Gold as the historic load leaves it, beside ``silver_history``."""
        gold = self.table("gold_history")
        silver = self.table("silver_history")
        self._once("historic", lambda: load_historic(self.lines("history"), silver, gold))
        return gold

    def daily(self) -> VersionedTable:
        """Daily gold, beside ``silver_daily``."""
        gold = self.table("gold_daily")
        silver = self.table("silver_daily")
        self._once("daily", lambda: load_daily(self.lines("daily"), silver, gold))
        return gold

    def merged(self) -> DataFrame:
        """Gold after the daily merge."""
        gold = self.table("gold")

        def build() -> None:
            history = self.historic().read().drop("insert_dt")
            gold.replace(history, stamps=stamp(), index_by=("ids", "time"))
            merge_gold(gold, self.daily(), self.table("daily_keys"))

        self._once("merged", build)
        return gold.read()


_lakes: dict[tuple[str, str], Lake] = {}
_lock = threading.RLock()


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake of these tables in this application."""
    pin_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _lakes:
            _lakes[key] = Lake(spark, sf_dir)
        return _lakes[key]


def entry(spark: SparkSession) -> DataFrame:
    """Events per area, from documents to answer."""
    pin_utc(spark)
    return analytics.count_by_area(plain_silver(feeds.history(spark, "/root/testdata/sf0.001")))


def _read(path: str, type_: str) -> Column:
    return F.try_variant_get("feature", path, type_)


def _bronze_multiline_scan(lake: Lake) -> DataFrame:
    return _feature_totals(scan_documents(lake.spark, lake.payloads("history")))


def _bronze_split_scan(lake: Lake) -> DataFrame:
    """The same, with every file cut between its features into runs of some kilobytes."""
    return _feature_totals(scan_documents(lake.spark, lake.payloads("history", plain=True), split=16 << 10))


def _feature_totals(documents: DataFrame) -> DataFrame:
    features = explode_features(documents)
    event_time = _read("$.properties.time", "bigint")
    return features.groupBy(F.col("document_type").alias("type")).agg(
        F.count("*").alias("n_features"),
        F.min(event_time).alias("first_time"),
        F.max(event_time).alias("last_time"),
        F.sum(_read("$.properties.sig", "int")).alias("total_sig"),
    )


def _bronze_text_scan(lake: Lake) -> DataFrame:
    pattern = f"{lake.landed('history')}/ingest_date={STAMP}/*"
    return explode_features(scan_text(lake.spark, pattern)).select(
        _read("$.id", "string").alias("id"),
        _read("$.properties.mag", "double").alias("mag"),
        _read("$.properties.place", "string").alias("place"),
        _read("$.properties.time", "bigint").alias("time"),
    )


def _flat(lake: Lake) -> DataFrame:
    return flatten_features(explode_features(lake.lines("history")))


def _silver_times(lake: Lake) -> DataFrame:
    return with_text_times(_flat(lake)).select("code", "time", "updated")


def _silver_area_strict(lake: Lake) -> DataFrame:
    return with_area(_flat(lake)).select("code", "place", "area")


def _silver_typed(lake: Lake) -> DataFrame:
    return strict_rows(explode_raw_features(lake.lines("daily")))


def _tolerant(lake: Lake, *columns: str) -> DataFrame:
    return tolerant_rows(explode_raw_features(lake.lines("tolerant")), columns or None)


def _silver_rejects(lake: Lake) -> DataFrame:
    rejects = rejected_rows(explode_raw_features(lake.lines("tolerant")))
    return rejects.groupBy("reason").agg(F.count("*").alias("rejected"))


def _silver_lost(lake: Lake) -> DataFrame:
    lost = lost_rows(explode_raw_features(lake.lines("tolerant")))
    return lost.groupBy("reason").agg(F.count("*").alias("features"))


def _plain_faults(lake: Lake) -> DataFrame:
    """Silver of the faulty feed, as the historic load stores it."""
    silver, gold = lake.table("silver_faulty"), lake.table("gold_faulty")
    lake._once("faulty", lambda: load_historic(lake.lines("faulty"), silver, gold))
    return kept_rows(silver)


def _plain_rejects(lake: Lake) -> DataFrame:
    """What that load set aside or lost, counted."""
    _plain_faults(lake)
    records = set_aside(lake.table("silver_faulty"))
    return records.groupBy("outcome", "reason").agg(F.count("*").alias("n"))


def _times_utc_fallback(lake: Lake) -> DataFrame:
    return _tolerant(lake, "code", "time", "updated").select(
        "code",
        millis_to_text_or_raw(F.col("time")).alias("time"),
        millis_to_text_or_raw(F.col("updated")).alias("updated"),
    )


def _area_loose(lake: Lake) -> DataFrame:
    return _tolerant(lake, "code", "place").select("code", "place", loose_area(F.col("place")).alias("area"))


def _sides(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Gold before the merge and the daily batch, without load times."""
    return lake.historic().read().drop("insert_dt"), lake.daily().read().drop("insert_dt")


def _join_anti_new(lake: Lake) -> DataFrame:
    gold, daily = _sides(lake)
    return rows_only_in(daily, gold)


def _join_anti_kept(lake: Lake) -> DataFrame:
    gold, daily = _sides(lake)
    return rows_only_in(gold, daily)


def _join_semi_updated(lake: Lake) -> DataFrame:
    gold, daily = _sides(lake)
    return rows_also_in(daily, gold)


def _union_nonmatching(lake: Lake) -> DataFrame:
    return unmatched_rows(*_sides(lake))


def _scd1_merge(lake: Lake) -> DataFrame:
    return upsert(*_sides(lake))


def _gold_ordered(lake: Lake) -> DataFrame:
    gold, daily = (with_position(side) for side in _sides(lake))
    return ordered_by_key(upsert(gold, daily, sorted_next=True), *POSITION).drop(*POSITION)


def _distinct_daily_keys(lake: Lake) -> DataFrame:
    return distinct_keys(lake.daily().read())


def _gold_insert_dt(lake: Lake) -> DataFrame:
    gold = with_load_time(upsert(lake.historic().read(), lake.daily().read()), LOADED_AT)
    return gold.withColumn("insert_dt", F.col("insert_dt").cast("timestamp_ntz"))


def _insert_date_text(lake: Lake) -> DataFrame:
    return with_derived(_tolerant(lake)).withColumn("insert_date", load_time_text(LOADED_AT))


def _json_round_trip(lake: Lake) -> DataFrame:
    path = f"{lake.root}/silver_lines"
    rows = with_derived(_tolerant(lake))
    write_lines(rows, path, compressed=True)
    return lake.spark.read.schema(rows.schema).json(path)


def _payload_hash(payloads: DataFrame) -> Row:
    """A hash of names and bytes of files, in any order, each counted."""
    name = F.substring_index("path", "/", -1)
    return payloads.agg(F.sum(F.xxhash64(name, F.sha2("content", 256)) % 1_000_003), F.count("*")).first()


def _bronze_landing(lake: Lake) -> DataFrame:
    """Features of the landed files, and whether these have the names and bytes of the source files."""
    path, source = f"{lake.root}/landing", lake.payloads("history")
    land_payloads(lake.spark, source, path, RUN_DATE)
    same = _payload_hash(scan_payloads(lake.spark, f"{path}/ingest_date={STAMP}")) == _payload_hash(
        scan_payloads(lake.spark, source)
    )
    landed = lake.spark.read.schema("value STRING, ingest_date STRING").text(path, wholetext=True)
    features = explode_features(landed).where(F.col("problem").isNull())
    return features.agg(F.count("*").alias("n_features")).select(
        F.lit(STAMP).alias("ingest_date"), "n_features", F.lit(same).alias("same_texts")
    )


def _parquet_round_trip(lake: Lake) -> DataFrame:
    lake.historic()
    return kept_rows(lake.table("silver_history"))


def _gold_replace(lake: Lake) -> DataFrame:
    """A table replaced by content computed from itself."""
    table = lake.table("replaced")
    table.replace(lake.historic().read())
    table.replace(upsert(table.read(), lake.daily().read()))
    return table.read().drop("insert_dt")


def _top_area_since(lake: Lake) -> DataFrame:
    """Files of gold whose times are all older are not opened."""
    lake.merged()
    return analytics.top_area_of_week(gold_since_week(lake.table("gold"), AS_OF), AS_OF)


def _job_historic_daily_merge(lake: Lake) -> DataFrame:
    run = "jobs/plain"
    tables = {
        name: lake.table(f"{run}/{name}")
        for name in ("silver_history", "silver_daily", "gold", "gold_daily", "daily_keys")
    }
    load_historic(lake.lines("history"), tables["silver_history"], tables["gold"])
    load_daily(lake.lines("daily"), tables["silver_daily"], tables["gold_daily"])
    merged = merge_gold(tables["gold"], tables["gold_daily"], tables["daily_keys"])
    return merged.drop("insert_dt")


def _run_tolerant(lake: Lake) -> tuple[DataFrame, str]:
    run = "jobs/tolerant"
    silver = f"{lake.root}/{run}/silver"
    return load_tolerant(lake.lines("tolerant"), silver, lake.table(f"{run}/gold")), silver


def _job_tolerant(lake: Lake) -> DataFrame:
    return _run_tolerant(lake)[0].drop("insert_date")


def _job_tolerant_outcomes(lake: Lake) -> DataFrame:
    silver = _run_tolerant(lake)[1]
    kept = read_silver(lake.spark, silver).select(F.lit("kept").alias("outcome"))
    rejected = read_rejects(lake.spark, silver).select(F.col("reason").alias("outcome"))
    lost = read_lost(lake.spark, silver).select(F.col("reason").alias("outcome"))
    return kept.unionByName(rejected).unionByName(lost).groupBy("outcome").agg(F.count("*").alias("features"))


_LOST_COUNTS = """SELECT CASE WHEN k % 73 <> 0 THEN 'lost nst' WHEN k % 79 <> 0 THEN 'lost sig'
       ELSE 'lost sig, nst' END AS reason, count(*) AS features
FROM checked WHERE reason IS NULL AND (k % 73 = 0 OR k % 79 = 0) GROUP BY 1"""

_HISTORY_TOTALS = """SELECT 'FeatureCollection' AS type, count(*) AS n_features, min(ms) AS first_time,
       max(ms) AS last_time, CAST(sum(sig) AS BIGINT) AS total_sig
FROM history_features"""

_QUERIES: dict[str, tuple[Callable[[Lake], DataFrame], str]] = {
    "q_bronze_multiline_scan": (_bronze_multiline_scan, _HISTORY_TOTALS),
    "q_bronze_split_scan": (_bronze_split_scan, _HISTORY_TOTALS),
    "q_bronze_text_scan": (
        _bronze_text_scan,
        "SELECT id, mag, place, ms AS time FROM history_features",
    ),
    "q_silver_flatten": (_flat, oracle.FLAT_HISTORY),
    "q_silver_times": (_silver_times, "SELECT code, time, updated FROM history_silver"),
    "q_silver_area_strict": (_silver_area_strict, "SELECT code, place, area FROM history_silver"),
    "q_silver_typed": (_silver_typed, oracle.TYPED_DAILY),
    "q_silver_tolerant": (_tolerant, "SELECT * FROM tolerant"),
    "q_silver_rejects": (
        _silver_rejects,
        "SELECT reason, count(*) AS rejected FROM checked WHERE reason IS NOT NULL GROUP BY reason",
    ),
    "q_silver_lost": (_silver_lost, _LOST_COUNTS),
    "q_plain_faults": (_plain_faults, "SELECT * FROM faulty_silver"),
    "q_plain_rejects": (_plain_rejects, "SELECT * FROM faulty_records"),
    "q_times_utc_fallback": (
        _times_utc_fallback,
        "SELECT code, time, updated FROM tolerant_silver",
    ),
    "q_area_loose": (_area_loose, "SELECT code, place, area FROM tolerant_silver"),
    "q_join_anti_new": (
        _join_anti_new,
        """SELECT * FROM daily_silver d
           WHERE NOT EXISTS (SELECT 1 FROM history_silver h WHERE h.ids = d.ids)""",
    ),
    "q_join_anti_kept": (
        _join_anti_kept,
        """SELECT * FROM history_silver h
           WHERE NOT EXISTS (SELECT 1 FROM daily_silver d WHERE d.ids = h.ids)""",
    ),
    "q_union_nonmatching": (
        _union_nonmatching,
        """SELECT * FROM history_silver h
           WHERE NOT EXISTS (SELECT 1 FROM daily_silver d WHERE d.ids = h.ids)
           UNION ALL
           SELECT * FROM daily_silver d
           WHERE NOT EXISTS (SELECT 1 FROM history_silver h WHERE h.ids = d.ids)""",
    ),
    "q_join_semi_updated": (
        _join_semi_updated,
        """SELECT * FROM daily_silver d
           WHERE EXISTS (SELECT 1 FROM history_silver h WHERE h.ids = d.ids)""",
    ),
    "q_scd1_merge": (_scd1_merge, "SELECT * FROM gold"),
    "q_gold_ordered": (_gold_ordered, "SELECT * FROM gold ORDER BY ids NULLS FIRST"),
    "q_distinct_daily_keys": (
        _distinct_daily_keys,
        "SELECT DISTINCT ids FROM daily_silver WHERE ids IS NOT NULL",
    ),
    "q_gold_insert_dt": (
        _gold_insert_dt,
        f"SELECT *, TIMESTAMP '{LOADED_AT}' AS insert_dt FROM gold",
    ),
    "q_insert_date_text": (
        _insert_date_text,
        f"SELECT *, '{LOADED_AT}' AS insert_date FROM tolerant_silver",
    ),
    "q_count_by_area": (
        lambda lake: analytics.count_by_area(lake.merged()),
        "SELECT area, count(*) AS no_earthquakes FROM gold GROUP BY area",
    ),
    "q_avg_magnitude_by_area": (
        lambda lake: analytics.avg_magnitude_by_area(lake.merged()),
        "SELECT area, avg(magnitude) AS avg_magnitude FROM gold GROUP BY area",
    ),
    "q_count_by_day": (
        lambda lake: analytics.count_by_day(lake.merged()),
        """SELECT CAST(CAST(time AS TIMESTAMP) AS DATE) AS date, count(*) AS noofearthquakes
           FROM gold GROUP BY 1""",
    ),
    "q_count_by_day_area": (
        lambda lake: analytics.count_by_day_area(lake.merged()),
        """SELECT CAST(CAST(time AS TIMESTAMP) AS DATE) AS date, area,
                  count(*) AS no_of_earthquakes FROM gold GROUP BY 1, 2""",
    ),
    "q_half_count_by_day": (
        lambda lake: analytics.half_count_by_day(lake.merged()),
        """SELECT CAST(CAST(time AS TIMESTAMP) AS DATE) AS date, count(*) / 2 AS avg_earthquakes
           FROM gold GROUP BY 1""",
    ),
    "q_half_count_by_day_area": (
        lambda lake: analytics.half_count_by_day_area(lake.merged()),
        """SELECT CAST(CAST(time AS TIMESTAMP) AS DATE) AS date, area,
                  count(*) / 2 AS avg_earthquakes FROM gold GROUP BY 1, 2""",
    ),
    "q_top_area_since": (
        _top_area_since,
        f"""SELECT area FROM gold
            WHERE CAST(CAST(time AS TIMESTAMP) AS DATE) >= DATE '{AS_OF}' - 7
            ORDER BY magnitude DESC NULLS LAST, ids NULLS FIRST, area NULLS FIRST LIMIT 1""",
    ),
    "q_areas_over_5": (
        lambda lake: analytics.areas_over(lake.merged()),
        "SELECT area FROM gold WHERE magnitude > 5",
    ),
    "q_json_round_trip": (_json_round_trip, "SELECT * FROM tolerant_silver"),
    "q_bronze_landing": (
        _bronze_landing,
        f"SELECT '{STAMP}' AS ingest_date, count(*) AS n_features, TRUE AS same_texts FROM history_features",
    ),
    "q_parquet_round_trip": (_parquet_round_trip, "SELECT * FROM history_silver"),
    "q_gold_replace": (_gold_replace, "SELECT * FROM gold"),
    "q_job_historic_daily_merge": (_job_historic_daily_merge, "SELECT * FROM gold"),
    "q_job_tolerant": (_job_tolerant, "SELECT * FROM tolerant_silver"),
    "q_job_tolerant_outcomes": (
        _job_tolerant_outcomes,
        f"""SELECT coalesce(reason, 'kept') AS outcome, count(*) AS features FROM checked GROUP BY 1
            UNION ALL SELECT * FROM ({_LOST_COUNTS})""",
    ),
}


def _bound(run: Callable[[Lake], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(lake(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or job; each takes (spark, sf_dir)."""
    found = {name: _bound(run) for name, (run, _) in _QUERIES.items()}
    return found | (training_data.queries() if training_data else {})


def oracle_sql() -> dict[str, str]:
    """The same results in SQL."""
    found = {
        name: sql if sql.startswith("WITH") else oracle.query(sql)
        for name, (_, sql) in _QUERIES.items()
    }
    return found | (training_data.oracle_sql() if training_data else {})
