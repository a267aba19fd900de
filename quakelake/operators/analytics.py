"""The eight questions asked of gold.

Each reads one or two columns. Grouped counts and means combine before their shuffle, so a hot
area or day costs one small row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakelake.functions.times import week_before


def _day() -> Column:
    return F.to_date("time").alias("date")


def count_by_area(gold: DataFrame) -> DataFrame:
    """Null and empty areas are two groups."""
    return gold.groupBy("area").agg(F.count("*").alias("no_earthquakes"))


def avg_magnitude_by_area(gold: DataFrame) -> DataFrame:
    return gold.groupBy("area").agg(F.avg("magnitude").alias("avg_magnitude"))


def count_by_day(gold: DataFrame) -> DataFrame:
    return gold.groupBy(_day()).agg(F.count("*").alias("noofearthquakes"))


def count_by_day_area(gold: DataFrame) -> DataFrame:
    return gold.groupBy(_day(), "area").agg(F.count("*").alias("no_of_earthquakes"))


def half_count_by_day(gold: DataFrame) -> DataFrame:
    """Half the count per day, named an average by its users; it is not one."""
    return gold.groupBy(_day()).agg((F.count("*") / 2).alias("avg_earthquakes"))


def half_count_by_day_area(gold: DataFrame) -> DataFrame:
    """Half the count per day and area; see ``half_count_by_day``."""
    return gold.groupBy(_day(), "area").agg((F.count("*") / 2).alias("avg_earthquakes"))


def top_area_of_week(gold: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Area of the strongest event since seven days before ``as_of`` (today by default).

    The time text sorts like the time, so the bound is compared as text and reaches the scan. Years
    beyond 9999 start with a plus sign, which sorts before all digits, and so does the minus sign
    of years before 0: the former are later than any bound. Ties go to the first key, then area; an unknown magnitude is the weakest.
    """
    return (
        gold.filter((F.col("time") >= week_before(as_of)) | F.col("time").startswith("+"))
        .orderBy(F.desc_nulls_last("magnitude"), "ids", "area")
        .select("area")
        .limit(1)
    )


def areas_over(gold: DataFrame, magnitude: float = 5) -> DataFrame:
    """The area of every event above ``magnitude``, repeated as often as it occurs."""
    return gold.filter(F.col("magnitude") > magnitude).select("area")
