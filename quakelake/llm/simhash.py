"""SimHash near-dedup with pigeonhole blocks.

A fingerprint is cut into k blocks. Two fingerprints that differ in at most d bits agree in at
least k - d blocks, so they share the value of some choice of k - d blocks: joining on all choices
loses no link, whatever k is. Rows that share such a value are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakelake.llm.components import connected
from quakelake.llm.support import numbered, one_of_each, pick, slices, stored, text_of, texts_of, without

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Shingles of a text that are hashed at a time, so that memory does not follow the longest text.
SHINGLES_AT_A_TIME = 1 << 16
# Fingerprints of one block value that one group compares; more are dealt to pairs of chunks.
CHUNK = 4096
# Groups up to this size are compared side by side with all others of a batch.
SMALL_GROUP = 32
# Unrelated fingerprints that one may meet by chance, over all its block values.
CHANCE_MEETINGS = 4.0


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as an unsigned number.

    ``bytes.lower`` changes A-Z alone, and ``bytes.split`` parts at blank and 9 to 13.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle_words, len(words))
    first, last = starts[: len(words) - span + 1], ends[span - 1 :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), SHINGLES_AT_A_TIME):
        part = slice(at, at + SHINGLES_AT_A_TIME)
        hashes = [digest(joined[i:j], SEED) for i, j in zip(first[part].tolist(), last[part].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(first), bitorder="little")
    return int(majority.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = np.fromiter((fingerprint(text) for text in texts_of(batch)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))],
            ["doc_id", "text_hash", "fp"],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp holds the 64 bits of the fingerprint as a long."""
    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), "text", F.xxhash64(text_of()).alias("text_hash")
    )
    return rows.mapInArrow(_fingerprints, "doc_id LONG, text_hash LONG, fp LONG")


def blocks_for(number: int, bits: int = MAX_BITS) -> int:
    """Blocks for so many fingerprints: the fewest with few meetings by chance.

    More blocks give more rows per fingerprint and fewer candidates; links are the same for all.
    """
    for blocks in range(bits + 1, 2 * bits + 3):
        shared = 64 * (blocks - bits) / blocks
        if comb(blocks, bits) * number / 2**shared <= CHANCE_MEETINGS:
            break
    return blocks


def masks(blocks: int, bits: int = MAX_BITS) -> list[int]:
    """Bit masks, as signed numbers, of all choices of blocks that close fingerprints can share."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    block = [((1 << high) - (1 << low)) for low, high in zip(edges, edges[1:])]
    chosen = [sum(block[i] for i in choice) for choice in combinations(range(blocks), blocks - bits)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in chosen]


def _linked(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected among sorted values: each component as a star.

    A breadth-first walk compares every value with those not reached yet, so a dense group costs
    about as much as its size and no group costs its links.
    """
    roots, reached = [], []
    rest = values
    while len(rest):
        root, front, rest = rest[0], rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), bool)
            for at in range(0, len(front), 64):
                far = rest[~near] if at else rest
                close = (np.bitwise_count(front[at : at + 64, None] ^ far[None, :]) <= bits).any(axis=0)
                near[np.flatnonzero(~near)[close] if at else close] = True
            front, rest = rest[near], rest[~near]
            roots.append(np.full(len(front), root))
            reached.append(front)
    if not roots:
        return values[:0], values[:0]
    return np.concatenate(roots), np.concatenate(reached)


def _links_of_groups(bits: int):
    """Links within groups; the rows of a group follow each other, across batches too."""

    def within(group: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(group)])))
        lows, highs = [], []
        small = np.repeat(sizes <= SMALL_GROUP, sizes)
        some, of = fp[small], np.repeat(np.arange(len(sizes)), sizes)[small]
        for step in range(1, min(SMALL_GROUP, int(sizes[sizes <= SMALL_GROUP].max(initial=0)))):
            same = of[step:] == of[:-step]
            close = same & (np.bitwise_count(some[step:] ^ some[:-step]) <= bits)
            lows.append(some[:-step][close])
            highs.append(some[step:][close])
        for i in np.flatnonzero(sizes > SMALL_GROUP):
            low, high = _linked(np.sort(fp[starts[i] : starts[i] + sizes[i]]), bits)
            lows.append(low)
            highs.append(high)
        if sum(map(len, lows)):
            pairs = [np.concatenate(side).view(np.int64) for side in (lows, highs)]
            yield pa.RecordBatch.from_arrays([pa.array(side) for side in pairs], ["a", "b"])

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("choice", "value", "low", "high")
        kinds = np.dtype([(name, np.int64) for name in names])
        group, fp = np.zeros(0, kinds), np.zeros(0, np.uint64)
        for batch in batches:
            more = np.zeros(batch.num_rows, kinds)
            for name in names:
                more[name] = batch.column(name).to_numpy(zero_copy_only=False)
            group = np.concatenate((group, more))
            fp = np.concatenate((fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)))
            if not len(group):
                continue
            whole = np.flatnonzero(group != group[-1])
            end = int(whole[-1]) + 1 if len(whole) else 0
            if end:
                yield from within(group[:end], fp[:end])
                group, fp = group[end:], fp[end:]
        if len(group):
            yield from within(group, fp)

    return of_task


def links(nodes: DataFrame, bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """(a, b) links that connect all fingerprints that chains of close pairs connect.

    ``nodes`` has one row for each distinct fp and should be stored. A block value that more than
    ``CHUNK`` fingerprints share is dealt to all pairs of its chunks: every pair of fingerprints
    meets in some group, and no group has more than two chunks. The counts by value are stored, so
    the join that adds them takes both inputs from their own shuffle and can be split.
    """
    blocks = blocks or blocks_for(nodes.count(), bits)
    choices = [
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(mask).cast("long")).alias("value"))
        for i, mask in enumerate(masks(blocks, bits))
    ]
    keyed = nodes.select("fp", F.explode(F.array(*choices)).alias("key")).select("fp", "key.choice", "key.value")
    shared = keyed.groupBy("choice", "value").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(shared, "simhash-shared")
    met = keyed.join(shared, ["choice", "value"])
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    dealt = met.withColumn("own", F.pmod(F.xxhash64("fp"), chunks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), chunks - 1))
    )
    grouped = dealt.select(
        F.col("choice").cast("long"),
        "value",
        F.least("own", "other").cast("long").alias("low"),
        F.greatest("own", "other").cast("long").alias("high"),
        "fp",
    )
    key = ("choice", "value", "low", "high")
    together = grouped.repartition(*key).sortWithinPartitions(*key)
    return together.mapInArrow(_links_of_groups(bits), "a LONG, b LONG").distinct()


def near_groups(docs: DataFrame, bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row.

    ``root`` is a fingerprint that names the component, and component_id is the smallest doc_id that links reach, the row's own included. Null and empty
    texts, and texts of white space, have fingerprint zero and are linked like any other. Rows of
    equal fingerprint are one node, so copies make no links. A null doc_id is never the smallest
    unless the component has no other. An empty table gives no rows.
    """
    signed = stored(fingerprints(docs), "simhash-fingerprints")
    nodes = stored(signed.groupBy("fp").agg(F.min("doc_id").alias("least_doc")), "simhash-nodes")
    roots = stored(connected(links(nodes.select("fp"), bits, blocks)), "simhash-roots")
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_doc", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "simhash-rooted")
    least = stored(rooted.groupBy("root").agg(F.min("least_doc").alias("component_id")), "simhash-least")
    named = stored(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-named")
    return signed.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def drop_near_copies(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, all columns: one with its smallest doc_id.

    Of rows that repeat that doc_id one stays: of different texts that of the smallest hash, of equal
    texts the smallest by its columns. Rows that stay for sure are not shuffled.
    """
    rows, at = numbered(docs)
    found = near_groups(docs, bits).groupBy("root", "component_id", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    found = stored(found, "simhash-found")
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = found.where(least).groupBy("root").agg(F.min(F.struct("text_hash", "doc_id", "n")).alias("kept"))
    kept = stored(kept.select("root", F.col("kept.text_hash").alias("kept_hash"), "kept.doc_id", "kept.n"), "simhash-kept")
    repeated = stored(kept.where("n > 1").select("doc_id", F.col("kept_hash").alias("text_hash")), "simhash-repeated")
    others = found.join(kept.select("root", "kept_hash"), "root").where(~least | (F.col("text_hash") != F.col("kept_hash")))
    dropped = others.select("doc_id", "text_hash").unionByName(repeated)
    dropped = stored(dropped.distinct(), "simhash-dropped")
    on = {"doc_id": F.col(at["doc_id"]).cast("long"), "text_hash": F.xxhash64(text_of(at["text"]))}
    kept = without(rows, dropped, **on)
    if not repeated.isEmpty():
        kept = kept.unionByName(one_of_each(rows, repeated, **on))
    return kept.toDF(*docs.columns)
