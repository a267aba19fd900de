"""Sharding by a lookup table that the shards fill in turns.

Every shard walks the slots of a table of prime size in an order of its own. The shards take turns;
at its turn a shard claims the next free slot of its order. A document's slot is a hash of its key,
and the slot names the shard: one broadcast lookup, whatever the number of shards. When a shard
leaves or joins, few slots change hands beyond its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakelake.llm.support import pick

# A prime, a thousand slots for each of the 64 shards: shares differ by about one slot.
TABLE_SIZE = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(number: int) -> bool:
    return number > 1 and all(number % i for i in range(2, int(number**0.5) + 1))


def _order(shard: str, size: int) -> tuple[int, int]:
    """Start and step of a shard's walk; the prime size makes every step visit all slots."""
    digest = hashlib.sha256(shard.encode()).digest()
    start = int.from_bytes(digest[:8], "big") % size
    step = int.from_bytes(digest[8:16], "big") % (size - 1) + 1
    return start, step


def build_table(shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> list[str]:
    """The shard of every slot. Names must differ; the size must be a prime above their number."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if size <= len(shards) or not _is_prime(size):
        raise ValueError("the size must be a prime above the number of shards")
    walks = [_order(shard, size) for shard in shards]
    places = [start for start, _ in walks]
    owner: list[str | None] = [None] * size
    free = size
    while free:
        for i, shard in enumerate(shards):
            place, step = places[i], walks[i][1]
            while owner[place] is not None:
                place = (place + step) % size
            owner[place] = shard
            places[i] = (place + step) % size
            free -= 1
            if not free:
                break
    return owner


def table_frame(spark: SparkSession, owners: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(owners)), "slot INT, shard STRING")


def place(
    docs: DataFrame,
    shards: Sequence[str] = SHARDS,
    size: int = TABLE_SIZE,
    also: Sequence[str] = (),
    else_by: str | None = None,
) -> DataFrame:
    """(doc_id, slot, shard) of every row, and the columns named in ``also``.

    The slot is a hash of doc_id, so repeated rows and reruns agree; no other column is read. Rows
    of null doc_id share one slot, unless ``else_by`` names a column whose hash they take instead.
    An empty table gives no rows. The broadcast table has ``size`` rows.
    """
    rows = pick(docs, *dict.fromkeys(("doc_id", *also, *([else_by] if else_by else []))))
    key = F.xxhash64("doc_id")
    if else_by:
        key = F.when(F.col("doc_id").isNotNull(), key).otherwise(F.xxhash64(else_by))
    slots = rows.withColumn("slot", F.pmod(key, F.lit(size)).cast("int"))
    owners = F.broadcast(table_frame(docs.sparkSession, build_table(shards, size)))
    placed = slots.join(owners, "slot")
    return placed.select("doc_id", "slot", "shard", *(name for name in also if name != "doc_id"))


def write_shards(docs: DataFrame, path: str, shards: Sequence[str] = SHARDS, files: int = 1) -> None:
    """doc_id and text of every row, under one folder per shard of ``files`` files each.

    More files per shard split a shard among tasks; which file a row takes is a hash of its key.
    """
    placed = place(docs, shards, also=("text",))
    part = F.pmod(F.xxhash64("doc_id", "slot"), F.lit(files))
    dealt = placed.repartition(len(shards) * files, "shard", part)
    dealt.drop("slot").write.partitionBy("shard").parquet(path)
