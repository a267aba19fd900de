"""Session settings and the shared folder for derived tables."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1 << 20
# One shuffle partition should fit in a task's share of executor memory.
SHUFFLE_TARGET_BYTES = 256 * MIB
MOST_PARTITIONS = 20_000
# Of a key that a feature repeats, the last value counts.
_LAST_KEY_COUNTS = "spark.sql.variant.allowDuplicateKeys"
# Generated methods of more bytes are never compiled by the JVM; such stages run their expressions one by one,
# which is faster. Thirty fields of a feature make such methods.
_LONGEST_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "quakelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` uses ``__`` for dots.

    The master and the resources are the cluster's business, so they are only set when given.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config(_LAST_KEY_COUNTS, "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * MIB))
        # Loads do not shuffle, so the scan's splits set the size of the files they write.
        .config("spark.sql.files.maxPartitionBytes", str(256 * MIB))
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Settings that results depend on: times are rendered in UTC, the last of repeated keys counts.

    One more spares time alone.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(_LAST_KEY_COUNTS, "true")
    spark.conf.set(*_LONGEST_METHOD)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the setting ``spark.checkpoint.dir``.

    A folder given to ``SparkContext.setCheckpointDir`` alone is not seen here.

    Only a local master may fall back to a temporary folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the whole cluster")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="quakelake-")
    return _local_dirs[context.applicationId]


@contextmanager
def setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """A session setting for the time of one write; None leaves it as it is."""
    if value is None:
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffle_partitions_for(stored: int, at_least: int) -> int:
    """Shuffle partitions for an input of ``stored`` bytes of compressed parquet.

    Rows in a shuffle take roughly three times their parquet size. Blocks of a shuffle are the
    product of its tasks on both sides, so past ``MOST_PARTITIONS`` partitions grow in size, not in
    number: sorts and sort-merge joins of some GiB spill, while the driver has to know each block.
    """
    return max(at_least, min(MOST_PARTITIONS, math.ceil(3 * stored / SHUFFLE_TARGET_BYTES)))


@contextmanager
def sized_shuffles(spark: SparkSession, stored: int) -> Iterator[None]:
    """Raise ``spark.sql.shuffle.partitions`` to fit what is shuffled; never lower it."""
    key = "spark.sql.shuffle.partitions"
    with setting(spark, key, str(shuffle_partitions_for(stored, int(spark.conf.get(key))))):
        yield
