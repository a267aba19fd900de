"""Exact dedup: counting quotient filters find repeated fingerprints, bytes decide.

1. Every task builds counting quotient filters of the 64-bit fingerprints of its rows, cut by the
   fingerprints' high bits into ranges.
2. The filters of one range, from all tasks, are merged by their sorted remainders. A fingerprint
   with a count above one is suspect.
3. Only rows with a suspect fingerprint are grouped by their whole text: of equal bytes, the row
   with the largest doc_id stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakelake.llm.quotient import CountingQuotientFilter
from quakelake.llm.support import numbered, one_of_each, pick, stored, text_of, with_membership, without

# Fingerprints that a task holds before it passes its filters on, and that a range should hold.
FILTER_KEYS = 1 << 20


def _range_bits(rows: int, partitions: int) -> int:
    """Bits that name a range: enough ranges for every task and for ranges of bounded size."""
    return max(1, math.ceil(math.log2(max(2, partitions, rows / FILTER_KEYS))))


def _filters(range_bits: int):
    width = 64 - range_bits
    mask = np.uint64((1 << width) - 1)

    def built(pieces: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = np.sort(np.concatenate(pieces).view(np.uint64))
        ranges = (keys >> np.uint64(width)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], ranges[1:] != ranges[:-1])))
        last = np.concatenate((first[1:], [len(keys)]))
        packed = [CountingQuotientFilter.of(keys[i:j] & mask, width).to_bytes() for i, j in zip(first, last)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ranges[first].astype(np.int32)), pa.array(packed, pa.binary())], ["range", "filter"]
        )

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column("fp").to_numpy(zero_copy_only=False))
            if sum(map(len, held)) >= FILTER_KEYS:
                yield from built(held)
                held = []
        if sum(map(len, held)):
            yield from built(held)

    return of_task


def _suspects_of(range_bits: int):
    width = np.uint64(64 - range_bits)

    def of_range(filters: pa.Table) -> pa.Table:
        packed = filters.column("filter").to_pylist()
        merged = CountingQuotientFilter.merged(map(CountingQuotientFilter.from_bytes, packed))
        keys, counts = merged.entries()
        high = np.uint64(filters.column("range")[0].as_py()) << width
        found = (keys[counts > 1] | high).view(np.int64)
        return pa.table({"fp": pa.array(found)})

    return of_range


def suspects(fingerprints: DataFrame) -> DataFrame:
    """(fp) of each fingerprint that more than one row has; the input has one column, fp.

    What one range holds is bounded: ranges grow in number with the rows, and a fingerprint takes
    one entry and its count however many rows have it.
    """
    spark = fingerprints.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = _range_bits(fingerprints.count(), partitions)
    filters = fingerprints.mapInArrow(_filters(bits), "range INT, filter BINARY")
    return filters.groupBy("range").applyInArrow(_suspects_of(bits), "fp LONG")


def _groups(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """(fp, sha, keep_id, group_size) of each text that more than one of the rows has.

    The rows have fp, sha, text and doc_id. Texts are compared byte by byte, as grouping keys;
    copies combine before the shuffle.
    """
    maybe = with_membership(rows, F.col("fp"), repeated, F.col("fp"), "suspect").where("suspect")
    same_bytes = maybe.groupBy("fp", "sha", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return same_bytes.where("group_size > 1").drop("text")


def _fingerprinted(rows: DataFrame, text: str) -> DataFrame:
    whole = text_of(text)
    return rows.withColumn("fp", F.xxhash64(whole)).withColumn("sha", F.unhex(F.sha2(whole, 256)))


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of (doc_id, text).

    A null text counts as empty, and empty texts are equal. Of equal texts the row with the largest
    doc_id is kept; rows that repeat that doc_id with that text are the same document and are all
    kept. A null doc_id is smaller than any other. An empty table gives no rows.
    """
    rows = _fingerprinted(pick(docs, "doc_id", "text"), "text").withColumn("text", text_of())
    narrow = stored(rows.select("doc_id", "fp", "sha"), "exact-signed")
    groups = _groups(rows, suspects(narrow.select("fp")))
    joined = narrow.join(groups, ["fp", "sha"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each text, all columns: one with the largest doc_id.

    Rows that repeat that doc_id are one document and one of them stays, the smallest by its columns.
    Rows whose text is no copy are not shuffled.
    """
    rows, at = numbered(docs)
    marked = exact_groups(docs).where("group_size > 1").select("doc_id", F.unhex("text_sha256").alias("sha"), "kept")
    marked = stored(marked.groupBy("doc_id", "sha", "kept").agg(F.count("*").alias("n")), "exact-marked")
    repeated = stored(marked.where("kept and n > 1").select("doc_id", "sha"), "exact-repeated")
    dropped = marked.where(~F.col("kept")).select("doc_id", "sha").unionByName(repeated)
    on = {"doc_id": F.col(at["doc_id"]), "sha": F.unhex(F.sha2(text_of(at["text"]), 256))}
    kept = without(rows, dropped, **on)
    if not repeated.isEmpty():
        kept = kept.unionByName(one_of_each(rows, repeated, **on))
    return kept.toDF(*docs.columns)
