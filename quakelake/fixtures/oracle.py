"""The rows of ``quakelake.fixtures.feeds`` and what is asked of them, as SQL on the flat tables."""

from __future__ import annotations

_NATIONS = """nations AS (
  SELECT c_custkey, translate(n_name, '_0123456789', ' abcdefghij') AS nation
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

_HISTORY_BASE = """history_base AS (
  SELECT event_id AS k,
         (CASE WHEN event_id % 40 = 1 THEN event_id - 1 ELSE event_id END) * 2 AS key,
         epoch_us(ts) // 1000 AS ms,
         CASE WHEN event_id % 17 <> 0 THEN floor(value * 64) / 4096 END AS mag,
         event_type AS label,
         event_type AS tag,
         nation,
         CASE WHEN event_id % 29 <> 0
              THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) END AS depth,
         event_id % 43 = 0 AS short,
         event_id % 101 = 0 AS keyless
  FROM events LEFT JOIN nations ON user_id = c_custkey
)"""

_DAILY_BASE = """daily_base AS (
  SELECT o_orderkey AS k,
         (CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey - 1 ELSE o_orderkey END) * 3 AS key,
         epoch_us(o_orderdate) // 1000 + (o_orderkey * 1000) % 86400000 AS ms,
         floor(o_totalprice) / 65536 AS mag,
         o_orderstatus AS label,
         o_orderpriority AS tag,
         nation,
         CAST(o_orderkey % 700 AS DOUBLE) AS depth,
         FALSE AS short,
         o_orderkey % 103 = 0 AS keyless
  FROM orders LEFT JOIN nations ON o_custkey = c_custkey
)"""


def _properties(feed: str) -> str:
    """Every property of a feature, with missing and null alike as null."""
    return f"""{feed}_features AS (
  SELECT k, short, depth,
         'ev' || key AS id,
         mag,
         CASE WHEN k % 13 = 0 THEN NULL
              WHEN k % 11 = 0 THEN nation
              WHEN k % 19 = 0 THEN 'off the coast of ' || nation || ', ' || tag
              ELSE (k % 90) || ' km SSW of ' || nation END AS place,
         ms,
         ms + (k * 1000) % 86400000 AS updated_ms,
         'https://example.org/event/' || k AS url,
         'https://example.org/detail/' || k || '.geojson' AS detail,
         CAST(CASE WHEN k % 3 = 2 THEN k % 50 END AS INTEGER) AS felt,
         CASE WHEN k % 5 <> 0 THEN CAST(k % 90 AS DOUBLE) / 10 END AS cdi,
         CASE WHEN k % 4 <> 0 THEN CAST(k % 80 AS DOUBLE) / 10 END AS mmi,
         CASE WHEN k % 6 = 0 THEN 'green' END AS alert,
         label AS status,
         CAST(k % 2 AS INTEGER) AS tsunami,
         CAST(k % 1000 AS INTEGER) AS sig,
         'us' AS net,
         CAST(k AS VARCHAR) AS code,
         CASE WHEN NOT keyless THEN ',ev' || key || ',' END AS ids,
         ',us,' AS sources,
         ',origin,phase-data,' AS types,
         CAST(CASE WHEN k % 9 <> 0 THEN k % 60 END AS INTEGER) AS nst,
         CASE WHEN k % 8 <> 0 THEN CAST(k % 400 AS DOUBLE) / 100 END AS dmin,
         CAST(k % 150 AS DOUBLE) / 100 AS rms,
         CASE WHEN k % 10 <> 0 THEN CAST(k % 360 AS DOUBLE) END AS gap,
         'ml' AS magType,
         label AS type,
         'M event ' || k AS title,
         CAST(CASE WHEN k % 2 <> 0 THEN k % 24 * 60 - 720 END AS INTEGER) AS tz,
         CAST(k % 360 - 180 AS DOUBLE) AS longitude,
         CAST(k % 180 - 90 AS DOUBLE) AS latitude
  FROM {feed}_base
)"""


def _text_time(millis: str) -> str:
    return f"strftime(epoch_ms({millis}), '%Y-%m-%d %H:%M:%S')"


STRICT_AREA = r"regexp_extract(place, '\bof\s+([A-Za-z\s,]+)$', 1)"
LOOSE_AREA = (
    r"CASE WHEN regexp_matches(place, 'of\s+(.*)') "
    r"THEN trim(regexp_extract(place, 'of\s+(.*)', 1)) END"
)

_FLAT = """'Feature' AS feature_type, mag AS magnitude, place, {time} AS time, {updated} AS updated,
         tz AS timezone, url AS event_url, detail AS detail_url, felt, cdi, mmi, alert, status,
         tsunami, sig, net, code, ids, sources, types AS type_properties, nst, dmin, rms, gap,
         magType, type AS earthquake_type, title AS earthquake_title,
         longitude AS geometry_longitude, latitude AS geometry_latitude,
         CASE WHEN NOT short THEN depth END AS geometry_depth"""


def _silver(feed: str) -> str:
    flat = _FLAT.format(time=_text_time("ms"), updated=_text_time("updated_ms"))
    return f"""{feed}_silver AS (
  SELECT {flat}, {STRICT_AREA} AS area
  FROM {feed}_features
)"""


_GOLD = """gold AS (
  SELECT * FROM history_silver h
  WHERE NOT EXISTS (SELECT 1 FROM daily_silver d WHERE d.ids = h.ids)
  UNION ALL
  SELECT * FROM daily_silver
)"""

# The tolerant feed: which feature is set aside, and why; the first broken rule counts.
_CHECKED = """checked AS (
  SELECT *,
         CASE WHEN k % 83 = 0 THEN 'properties is not an object'
              WHEN k % 71 = 0 THEN 'missing id'
              WHEN k % 97 = 0 THEN 'bad mag'
              WHEN k % 59 = 0 THEN 'missing status'
              WHEN k % 53 = 0 THEN 'null tsunami'
              WHEN k % 67 = 0 THEN 'missing title'
              WHEN k % 89 = 0 THEN 'missing longitude'
              WHEN short THEN 'missing depth' END AS reason
  FROM history_features
)"""

_TOLERANT = """tolerant AS (
  SELECT id,
         CASE WHEN k % 23 <> 0 AND k % 19 = 1 THEN 0.0 ELSE coalesce(mag, 0.0) END AS mag,
         CASE WHEN k % 31 = 3 THEN 'Unknown' ELSE place END AS place,
         CASE WHEN k % 37 = 0 THEN 'abc' WHEN k % 31 <> 0 AND k % 41 = 0 THEN NULL
              ELSE CAST(ms AS VARCHAR) END AS time,
         CAST(updated_ms AS VARCHAR) AS updated,
         url, detail, coalesce(CAST(felt AS DOUBLE), 0.0) AS felt, coalesce(cdi, 0.0) AS cdi, mmi,
         alert, CASE WHEN k % 61 <> 0 THEN status END AS status, tsunami,
         CASE WHEN k % 73 = 0 THEN NULL WHEN k % 43 = 1 THEN CAST(sig AS BIGINT) + 5000000000
              ELSE CAST(sig AS BIGINT) END AS sig, net, code, ids,
         sources, types, CASE WHEN k % 79 <> 0 THEN nst END AS nst, coalesce(dmin, 0.0) AS dmin, rms, coalesce(gap, 0.0) AS gap, magType,
         type, title, tz, longitude, latitude, coalesce(depth, 0.0) AS depth
  FROM checked WHERE reason IS NULL
), tolerant_silver AS (
  SELECT * REPLACE (CASE WHEN time = 'abc' THEN time
                         ELSE {time} END AS time,
                    {updated} AS updated),
         {area} AS area
  FROM tolerant
)""".format(
    time=_text_time("TRY_CAST(time AS BIGINT)"),
    updated=_text_time("CAST(updated AS BIGINT)"),
    area=LOOSE_AREA,
)

# The faulty feed: what of it is kept, and what is recorded.
_FAULTY = """faulty_read AS (
  SELECT *, k // 200 AS document, k % 101 = 0 OR k % 103 = 0 AS stray,
         nullif(concat_ws(', ', CASE WHEN k % 97 = 0 THEN 'magnitude' END,
                                CASE WHEN k % 73 = 0 THEN 'sig' END,
                                CASE WHEN k % 89 = 0 THEN 'geometry_latitude' END), '') AS lost
  FROM history_features
), faulty_kept AS (
  SELECT * REPLACE (CASE WHEN k % 97 <> 0 THEN mag END AS mag,
                    CASE WHEN k % 73 <> 0 THEN sig END AS sig,
                    CASE WHEN k % 89 <> 0 THEN latitude END AS latitude)
  FROM faulty_read WHERE document % 5 IN (0, 4) AND NOT stray
), faulty_silver AS (
  SELECT {flat}, {area} AS area FROM faulty_kept
), faulty_records AS (
  SELECT 'rejected' AS outcome, 'unreadable document' AS reason, count(DISTINCT document) AS n
  FROM faulty_read WHERE document % 5 IN (1, 2, 3) HAVING count(*) > 0
  UNION ALL
  SELECT 'rejected', 'feature is not an object', count(*)
  FROM faulty_read WHERE document % 5 IN (0, 4) AND stray HAVING count(*) > 0
  UNION ALL
  SELECT 'lost', 'lost ' || lost, count(*) FROM faulty_kept WHERE lost IS NOT NULL GROUP BY lost
)""".format(flat=_FLAT.format(time=_text_time("ms"), updated=_text_time("updated_ms")), area=STRICT_AREA)

_STEPS = [
    _NATIONS,
    _HISTORY_BASE,
    _DAILY_BASE,
    _properties("history"),
    _properties("daily"),
    _silver("history"),
    _silver("daily"),
    _GOLD,
    _CHECKED,
    _TOLERANT,
    _FAULTY,
]


def query(select: str) -> str:
    """A full statement over ``*_features``, ``*_silver``, ``gold``, ``checked``, ``tolerant``."""
    return f"WITH {', '.join(_STEPS)}\n{select}"


FLAT_HISTORY = query(f"SELECT {_FLAT.format(time='ms', updated='updated_ms')} FROM history_features")

TYPED_DAILY = query(
    """SELECT id, mag, place, ms AS time, updated_ms AS updated, url, detail,
       CASE WHEN k % 3 = 0 THEN 0 ELSE felt END AS felt, coalesce(cdi, 0.0) AS cdi, mmi, alert,
       status, tsunami, sig, net, code, ids, sources, types, nst, coalesce(dmin, 0.0) AS dmin, rms,
       coalesce(gap, 0.0) AS gap, magType, type, title, tz, longitude, latitude, depth
FROM daily_features"""
)
