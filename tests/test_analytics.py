import datetime as dt

import pytest

from quakelake.operators import analytics

ROWS = [
    ("1", "2024-01-20 00:00:00", "A", 5.0),
    ("2", "2024-01-20 23:59:59", "A", 7.0),
    ("3", "2024-01-21 10:00:00", "", 5.5),
    ("4", "2024-01-21 11:00:00", None, None),
    ("5", "2024-01-19 23:59:59", "B", 9.0),
    ("0", "2024-01-25 11:00:00", "C", 7.0),
    ("6", None, "A", 5.5),
]
D19, D20, D21, D25 = (dt.date(2024, 1, day) for day in (19, 20, 21, 25))


@pytest.fixture
def gold(spark):
    return spark.createDataFrame(ROWS, "ids STRING, time STRING, area STRING, magnitude DOUBLE")


def bag(rows):
    return {tuple(row) for row in rows.collect()}


def test_by_area(gold):
    assert bag(analytics.count_by_area(gold)) == {("A", 3), ("", 1), (None, 1), ("B", 1), ("C", 1)}
    assert bag(analytics.avg_magnitude_by_area(gold)) == {
        ("A", 17.5 / 3),
        ("", 5.5),
        (None, None),
        ("B", 9.0),
        ("C", 7.0),
    }


def test_by_day(gold):
    counts = {(D20, 2), (D21, 2), (D19, 1), (D25, 1), (None, 1)}
    assert bag(analytics.count_by_day(gold)) == counts
    assert bag(analytics.half_count_by_day(gold)) == {(day, n / 2) for day, n in counts}


def test_by_day_and_area(gold):
    counts = {
        (D20, "A", 2),
        (D21, "", 1),
        (D21, None, 1),
        (D19, "B", 1),
        (D25, "C", 1),
        (None, "A", 1),
    }
    assert bag(analytics.count_by_day_area(gold)) == counts
    assert bag(analytics.half_count_by_day_area(gold)) == {(d, a, n / 2) for d, a, n in counts}


def test_strongest_of_the_week(gold):
    """The bound is a whole day; of equal magnitudes the first key wins."""
    assert bag(analytics.top_area_of_week(gold, "2024-01-27")) == {("C",)}
    assert bag(analytics.top_area_of_week(gold, dt.date(2024, 1, 26))) == {("B",)}
    assert bag(analytics.top_area_of_week(gold, "2024-03-01")) == set()


def test_over_a_magnitude(gold):
    areas = [row["area"] for row in analytics.areas_over(gold).collect()]
    assert sorted(areas) == ["", "A", "A", "B", "C"]
    assert [row["area"] for row in analytics.areas_over(gold, 7).collect()] == ["B"]


def test_years_beyond_9999_are_later_than_any_bound(spark):
    """As dates compare, though such a time sorts first as text."""
    rows = [("1", "+56777-01-20 00:00:00", "far", 9.5), ("2", "2024-01-25 00:00:00", "near", 5.0), ("3", "-0001-01-01 00:00:00", "old", 9.9)]
    gold = spark.createDataFrame(rows, "ids STRING, time STRING, area STRING, magnitude DOUBLE")
    assert bag(analytics.top_area_of_week(gold, "2024-01-27")) == {("far",)}
