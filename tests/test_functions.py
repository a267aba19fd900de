import datetime as dt

from pyspark.sql import functions as F

from quakelake.functions import (
    date_stamp,
    load_time_text,
    loose_area,
    millis_to_text,
    millis_to_text_or_raw,
    strict_area,
    week_before,
)

AREAS = [
    ("10 km SSW of Ojai, CA", "Ojai, CA", "Ojai, CA"),
    ("south of the Fiji Islands", "the Fiji Islands", "the Fiji Islands"),
    ("off the coast of Oregon", "Oregon", "Oregon"),
    ("7 km of Isle of Man", "Isle of Man", "Isle of Man"),
    ("5 km W of St. Paul, MN", "", "St. Paul, MN"),
    ("3 km N of Cañon, PR", "", "Cañon, PR"),
    ("Mid-Atlantic Ridge", "", None),
    ("Roof top", "", "top"),
    ("of  X ", "X ", "X"),
    (" of ", "", ""),
    ("", "", None),
    (None, None, None),
    ("north of A\nB", "A\nB", "A"),
    ("north of A\rB ", "", "A\rB"),
]


def test_areas(spark):
    rows = spark.createDataFrame(AREAS, "place STRING, strict STRING, loose STRING")
    place = F.col("place")
    got = rows.select("place", strict_area(place).alias("s"), loose_area(place).alias("l")).collect()
    assert [tuple(row) for row in got] == AREAS


PLAIN_TIMES = [
    (1729555199999, "2024-10-21 23:59:59"),
    (0, "1970-01-01 00:00:00"),
    (-1, "1970-01-01 00:00:00"),
    (-1001, "1969-12-31 23:59:59"),
    (None, None),
]


def test_plain_times_go_toward_zero(spark):
    rows = spark.createDataFrame(PLAIN_TIMES, "t BIGINT, text STRING")
    got = rows.select("t", millis_to_text(F.col("t"))).collect()
    assert [tuple(row) for row in got] == PLAIN_TIMES


TOLERANT_TIMES = [
    ("1729555199999", "2024-10-21 23:59:59"),
    (" 1729555199999.9 ", "2024-10-21 23:59:59"),
    ("1.729555199999E12", "2024-10-21 23:59:59"),
    ("-1", "1969-12-31 23:59:59"),
    ("abc", "abc"),
    ("", ""),
    ("NaN", "NaN"),
    ("1e300", "1e300"),
    ("-1e300", "-1e300"),
    (None, None),
]


def test_tolerant_times_round_down_or_stay(spark):
    rows = spark.createDataFrame(TOLERANT_TIMES, "t STRING, text STRING")
    got = rows.select("t", millis_to_text_or_raw(F.col("t"))).collect()
    assert [tuple(row) for row in got] == TOLERANT_TIMES


def test_tolerant_times_take_numbers(spark):
    rows = spark.createDataFrame([(-1, 1.5)], "a BIGINT, b DOUBLE")
    got = rows.select(millis_to_text_or_raw(F.col("a")), millis_to_text_or_raw(F.col("b"))).first()
    assert tuple(got) == ("1969-12-31 23:59:59", "1970-01-01 00:00:00")


def test_run_dates(spark):
    one = spark.range(1)
    day = dt.date(2024, 3, 5)
    got = one.select(date_stamp(day), date_stamp("2024-03-05"), week_before(day)).first()
    assert tuple(got) == ("20240305", "20240305", "2024-02-27")
    today, stamp, week, text = one.select(
        F.current_date(), date_stamp(), week_before(), load_time_text()
    ).first()
    assert stamp == today.strftime("%Y%m%d")
    assert week == str(today - dt.timedelta(days=7))
    assert dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
