"""Token files: raw ids in shards, each with a minimal perfect hash over its document keys.

A file set is a Parquet folder with one row per shard:

    part, shard      place of the shard in ascending doc_id order
    start            ids of the part before this shard
    n_tokens, n_docs
    first_key, last_key, null_keys
    keys             doc_id of every document, little-endian signed 64-bit, in order (nulls first, as 0)
    offsets          ids of the shard before each document and after the last, unsigned 64-bit
    index            minimal perfect hash of the distinct keys (see perfect_hash)
    first_of_slot    for each slot, the number of its key's first document
    payload          the ids, little-endian unsigned, two bytes each where the vocabulary allows

Access by key looks at the shards whose key range holds the key (Parquet's statistics skip the
rest); in a shard one hash gives the slot, the stored fingerprint and the key there confirm it, and
the offsets give the ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quakelake.llm.perfect_hash import PerfectHash
from quakelake.llm.support import pick, slices, text_of
from quakelake.llm.tokens import encoder, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
# Ids after which a shard ends; it always holds whole documents.
SHARD_TOKENS = 1 << 20
ID_BYTES = 2

SHARD = (
    "part INT, shard INT, start LONG, n_tokens LONG, n_docs LONG, first_key LONG, last_key LONG,"
    " null_keys LONG, keys BINARY, offsets BINARY, index BINARY, first_of_slot BINARY, payload BINARY"
)
_NAMES = [field.split()[0] for field in SHARD.split(",")]
_KINDS = [pa.int32()] * 2 + [pa.int64()] * 6 + [pa.binary()] * 5


def _narrow(ids: bytes, width: int) -> bytes:
    values = np.frombuffer(ids, "<u4")
    if len(values) and int(values.max()) >> (8 * width):
        raise ValueError(f"an id does not fit into {width} bytes")
    return values.astype(f"<u{width}").tobytes()


def _wide(payload: bytes, width: int = ID_BYTES) -> bytes:
    return np.frombuffer(payload, f"<u{width}").astype("<u4").tobytes()


def _shards(path: str | None, name: str, end_id: int, width: int, shard_tokens: int):
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(path or tokenizer_path(name)).encode_all
        end = end_id.to_bytes(4, "little")
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        lengths: list[int] = []
        payload: list[bytes] = []
        size = 0

        def made() -> pa.RecordBatch:
            nonlocal shard, start, size
            nulls = keys.count(None)
            known = np.array([0 if key is None else key for key in keys], "<i8")
            distinct, first = np.unique(known[nulls:], return_index=True)
            index = PerfectHash.of(distinct)
            first_of_slot = np.zeros(len(distinct), "<u4")
            first_of_slot[index.slots(distinct)] = first + nulls
            bounds = (int(distinct[0]), int(distinct[-1])) if len(distinct) else (None, None)
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype("<u8")
            row = (
                (part, shard, start, size, len(keys), *bounds, nulls)
                + (known.tobytes(), offsets.tobytes(), index.to_bytes(), first_of_slot.tobytes())
                + (b"".join(payload),)
            )
            shard, start, size = shard + 1, start + size, 0
            for held in (keys, lengths, payload):
                held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _KINDS)], _NAMES)

        for batch in slices(batches):
            for key, ids in zip(batch.column("doc_id").to_pylist(), encode_all(batch.column("text"))):
                ids += end
                keys.append(key)
                lengths.append(len(ids) // 4)
                payload.append(_narrow(ids, width))
                size += lengths[-1]
                if size >= shard_tokens:
                    yield made()
        if keys:
            yield made()

    return of_task


def write_tokens(
    docs: DataFrame,
    target: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    path: str | None = None,
    id_bytes: int = ID_BYTES,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode every text, add the end id and write the file set in ascending doc_id order.

    A null text is empty and has the end id alone. Null doc_ids come first. Rows of one doc_id
    follow each other in order of their texts' hashes. An empty table gives an empty file set.
    Texts are shuffled once, by ranges of doc_id; ids never are.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64(text_of()).asc())
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    built = dealt.mapInArrow(_shards(path, tokenizer, end_id, id_bytes, shard_tokens), SHARD)
    built.write.parquet(target)


def open_tokens(spark: SparkSession, target: str) -> DataFrame:
    """The shards, with the ids before each in the whole set in place of those in its part.

    There is one total for each range partition of the write, so they may meet in one task and be
    broadcast; the payload stays where it was read.
    """
    shards = spark.read.schema(SHARD).parquet(target)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    opened = shards.join(F.broadcast(before), "part")
    return opened.select(*(F.col("before") + F.col("start") if n == "start" else n for n in _NAMES)).toDF(*_NAMES)


class Shard:
    """One shard's documents, by number or by key."""

    def __init__(self, row: dict) -> None:
        self.start = row["start"]
        self.null_keys = row["null_keys"]
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.offsets = np.frombuffer(row["offsets"], "<u8").astype(np.int64)
        self.index = PerfectHash.from_bytes(row["index"])
        self.first_of_slot = np.frombuffer(row["first_of_slot"], "<u4").astype(np.int64)
        self.payload = row["payload"]

    def first_of(self, keys: np.ndarray) -> np.ndarray:
        """Number of the first document of each key, -1 for keys that are not here."""
        slots = self.index.slots(keys)
        found = slots >= 0
        first = np.full(len(keys), -1)
        first[found] = self.first_of_slot[slots[found]]
        first[found] = np.where(self.keys[first[found]] == keys[found], first[found], -1)
        return first

    def all_of(self, keys: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place in keys, document number) of every document of the distinct keys."""
        for place, number in enumerate(self.first_of(keys)):
            while 0 <= number < len(self.keys) and self.keys[number] == keys[place]:
                yield place, int(number)
                number += 1


def _documents(width: int, wanted: list[int] | None):
    """Documents of each shard, found through its index; null keys, which it lacks, by number."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                shard = Shard(row)
                keys = np.array(wanted, "<i8") if wanted is not None else np.unique(shard.keys[shard.null_keys :])
                numbers = [] if wanted is not None else list(range(shard.null_keys))
                numbers += [number for _, number in shard.all_of(keys)]
                at = shard.offsets
                ids = [
                    _wide(shard.payload[at[number] * width : at[number + 1] * width], width) for number in numbers
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None if n < shard.null_keys else int(shard.keys[n]) for n in numbers], pa.int64()),
                        pa.array([shard.start + int(at[n]) for n in numbers], pa.int64()),
                        pa.array([int(at[n + 1] - at[n]) for n in numbers], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return of_task


def read_tokens(spark: SparkSession, target: str, id_bytes: int = ID_BYTES) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a file set, from the files alone.

    ``start`` counts the ids of all documents before; ``ids`` are unsigned 32-bit, little-endian.
    """
    return open_tokens(spark, target).mapInArrow(
        _documents(id_bytes, None), "doc_id LONG, start LONG, n_tokens LONG, ids BINARY"
    )


def lookup(spark: SparkSession, target: str, keys: Iterable[int], id_bytes: int = ID_BYTES) -> DataFrame:
    """The same columns for the documents of some keys; only shards that may hold one are read."""
    wanted = sorted(set(keys))
    shards = open_tokens(spark, target)
    if not wanted:
        shards = shards.limit(0)
    holds = F.lit(False)
    for key in wanted:
        holds = holds | ((F.col("first_key") <= key) & (F.col("last_key") >= key))
    return shards.where(holds).mapInArrow(
        _documents(id_bytes, wanted), "doc_id LONG, start LONG, n_tokens LONG, ids BINARY"
    )
