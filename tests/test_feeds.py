import pytest
from pyspark.sql import functions as F

from quakelake.fixtures import feeds
from quakelake.session import pin_utc


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """1,200 documents of events and of orders."""
    folder = str(tmp_path_factory.mktemp("tables"))
    ids = spark.range(240_000)
    user = (F.col("id") % 50).alias("user_id")
    day = F.date_add(F.lit("2024-01-01"), (F.col("id") % 30).cast("int")).cast("timestamp_ntz")
    made = {
        "events": ids.select(
            F.col("id").alias("event_id"), day.alias("ts"), user, F.lit("view").alias("event_type"),
            (F.col("id") % 9 / 2).alias("value"), F.lit('{"k": 3}').alias("props"),
        ),
        "orders": ids.select(
            F.col("id").alias("o_orderkey"), user.alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
            F.lit(2.5).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
        ),
        "customer": spark.range(50).select(F.col("id").alias("c_custkey"), (F.col("id") % 2).alias("c_nationkey")),
        "nation": spark.range(2).select(F.col("id").alias("n_nationkey"), F.lit("N_1").alias("n_name")),
    }
    for name, rows in made.items():
        rows.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("feed", ["history", "daily", "tolerant", "faulty"])
def test_documents_are_dealt_by_their_number(spark, tables, feed):
    """Adaptive execution would join the narrow partitions of the shuffle, and one task would make all texts."""
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    pin_utc(session)
    documents = getattr(feeds, feed)(session, tables)
    of_task = documents.groupBy(F.spark_partition_id()).count().select("count")
    counts = [row["count"] for row in of_task.collect()]
    assert sum(counts) == 1_200
    assert len(counts) == 12 and max(counts) <= 2 * feeds.DOCUMENTS_A_TASK
