import pytest
from pyspark.sql import functions as F

from quakelake.operators import (
    distinct_keys,
    ordered_by_key,
    rows_also_in,
    rows_only_in,
    unmatched_rows,
    upsert,
)

HISTORY = [("a", "h1"), ("b", "h2"), ("b2", "h3"), ("d", "h4"), ("d", "h5"), (None, "h6")]
DAILY = [("b", "d1"), ("b2", "d2"), ("b2", "d3"), ("c", "d4"), ("c", "d5"), (None, "d6")]


@pytest.fixture
def sides(spark):
    schema = "ids STRING, v STRING"
    return spark.createDataFrame(HISTORY, schema), spark.createDataFrame(DAILY, schema)


def bag(rows):
    return sorted((tuple(row) for row in rows.collect()), key=repr)


def three_joins(gold, daily):
    """The merge spelled out: rows of one side only, then daily rows that replace something."""
    only_gold = gold.join(daily, ["ids"], "left_anti")
    only_daily = daily.join(gold, ["ids"], "left_anti")
    both = daily.join(gold, ["ids"], "left_semi")
    return only_gold.unionByName(only_daily).unionByName(both)


def test_single_joins(sides):
    gold, daily = sides
    assert bag(rows_only_in(daily, gold)) == sorted([("c", "d4"), ("c", "d5"), (None, "d6")], key=repr)
    assert bag(rows_only_in(gold, daily)) == sorted(
        [("a", "h1"), ("d", "h4"), ("d", "h5"), (None, "h6")], key=repr
    )
    assert bag(rows_also_in(daily, gold)) == [("b", "d1"), ("b2", "d2"), ("b2", "d3")]
    assert unmatched_rows(gold, daily).count() == 7
    assert bag(distinct_keys(daily)) == [("b",), ("b2",), ("c",)]


def test_upsert_is_the_three_join_merge(sides):
    gold, daily = sides
    merged = upsert(gold, daily)
    assert merged.columns[0] == "ids"
    expected = [row for row in HISTORY if row[0] in ("a", "d", None)] + DAILY
    assert bag(merged) == bag(three_joins(gold, daily)) == sorted(expected, key=repr)
    assert bag(upsert(gold, daily, distinct_keys(daily))) == bag(merged)


def test_upsert_on_generated_rows(spark):
    """Copies and null keys on both sides, in numbers."""
    key = F.when(F.col("id") % 7 != 0, (F.col("id") * 31 % 97).cast("string")).alias("ids")
    gold = spark.range(500).select(key, F.concat(F.lit("h"), "id").alias("v"))
    daily = spark.range(300, 420).select(key, F.concat(F.lit("d"), "id").alias("v"))
    assert bag(upsert(gold, daily)) == bag(three_joins(gold, daily))


def test_merging_twice(sides):
    """The same batch again changes nothing but the daily rows without a key, which come again."""
    gold, daily = sides
    once = upsert(gold, daily)
    twice = upsert(once, daily)
    assert bag(twice) == sorted([*bag(once), (None, "d6")], key=repr)
    keyed = daily.filter(F.col("ids").isNotNull())
    once = upsert(gold, keyed)
    assert bag(upsert(once, keyed)) == bag(once)


def test_empty_sides(sides):
    gold, daily = sides
    none = gold.limit(0)
    assert bag(upsert(gold, none)) == sorted(HISTORY, key=repr)
    assert bag(upsert(none, daily)) == sorted(DAILY, key=repr)


def test_order_puts_null_keys_first(sides):
    gold, daily = sides
    keys = [row["ids"] for row in ordered_by_key(upsert(gold, daily), "v").collect()]
    assert keys == [None, None, "a", "b", "b2", "b2", "c", "c", "d", "d"]


@pytest.mark.parametrize("hot", ["hot", None])
def test_a_hot_key_is_split(spark, hot):
    """A third of gold has one key (or none): adaptive execution splits that partition."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    session = spark.newSession()
    for name, value in settings.items():
        session.conf.set(name, value)
    rows = session.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id").cast("string")).alias("ids"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"),
    )
    key = F.col("id").cast("string").alias("ids")
    daily = session.range(30_000, 90_000).select(key, F.lit("d").alias("v"))
    counted = rows_only_in(rows, daily).agg(F.count("v"), F.max("v"))
    assert counted.collect()[0][0] == 20_000 + 20_000
    assert "SortMergeJoin(skew=true)" in counted._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_match_are_not_shuffled(spark):
    """Of wide rows only those that may have a shared key go to the join, copies and null keys included."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.enabled", "false")

    def side(first, last, word):
        key = F.when(F.col("id") % 11 != 0, (F.col("id") - F.col("id") % 5).cast("string"))
        return session.range(first, last).select(F.concat(F.lit(word), "id").alias("v"), key.alias("ids"))

    gold, daily = side(0, 3_000, "h"), side(2_800, 5_000, "d")
    by_key = lambda rows, others, kind: rows.join(others.select("ids").distinct(), ["ids"], kind)
    expected = by_key(gold, daily, "left_anti").unionByName(by_key(daily, gold, "left_anti"))
    found = unmatched_rows(gold, daily)
    assert found.columns == expected.columns and bag(found) == bag(expected)
    assert bag(unmatched_rows(gold, gold.limit(0))) == bag(gold.select("ids", "v"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("stored", [False, True])
def test_an_upsert_by_many_keys_leaves_rows_in_place(spark, stored):
    """Of wide gold rows only those that may have a key of the batch go to the join."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.enabled", "false")
    key = F.when(F.col("id") % 7 != 0, (F.col("id") * 31 % 397).cast("string")).alias("ids")
    gold = session.range(900).select(F.concat(F.lit("h"), "id").alias("v"), key)
    daily = session.range(300, 420).select(F.concat(F.lit("d"), "id").alias("v"), key)
    found = upsert(gold, daily, distinct_keys(daily) if stored else None, few=False)
    expected = three_joins(gold, daily)
    assert found.columns == expected.columns and bag(found) == bag(expected)
    assert bag(upsert(gold, daily, sorted_next=True)) == bag(expected)
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
