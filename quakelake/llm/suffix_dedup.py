"""Removal of long repeated byte strings by distributed prefix doubling.

A position is ranked by the string that starts there: first by strings of a quarter of the
threshold, then, at growing offsets, by the pair of the ranks at the position and the offset behind
it. Spark sorts the pairs; a position whose pair is unique leaves, one whose pair is repeated past
the threshold is removed.

Ranking all positions would shuffle some hundred bytes for each byte of text, so positions are
thinned out without losing a repeat:

1. Half the threshold. Of each string of threshold length only the inner string with the smallest
   rank is asked for. The choice depends on the string's bytes alone, so equal strings choose at the
   same place: where the chosen inner string is unique, the whole string is.
2. Neighbouring strings that choose the same place form a run, and runs with equal bytes are repeated
   as a whole. Most of a long repeat is settled by these, a row a run.
3. The threshold. Only runs whose inner string is repeated, but whose bytes are not, are left: the
   ends of repeats. All their positions are ranked by the pair at half the threshold.

Ranks are hashes: 128 bits decide, 64 bits only choose places and rule out. Of the rows that a task
finds equal by itself only one is sent on, so a passage that many documents share costs a row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quakelake.llm.support import (
    BITS_PER_ROW,
    MAP_BITS,
    discard,
    numbered,
    pick,
    slices,
    stored,
    text_of,
    texts_of,
    with_membership,
)

THRESHOLD = 200
# Bytes that are ranked at a time; positions among them fit the low bits of a rank.
BUFFER = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
# Positions that a task holds before it passes them on.
HELD = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_KEY = ("key", "size")
_RUN = "sure BOOLEAN, rank LONG, one LONG, two LONG, many BOOLEAN, key LONG, size LONG, lo LONG, hi LONG, asks BOOLEAN"


def _powers(base: int) -> np.ndarray:
    powers = np.full(2 * BUFFER + 1, base, np.uint64)
    powers[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(powers)


class _Ranker:
    """Ranks of the strings of one length at every place of a buffer."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))

    def first(self, buffer: np.ndarray, length: int) -> np.ndarray:
        """By the bytes themselves: a polynomial hash of each string, free of its place."""
        with np.errstate(over="ignore"):
            total = np.zeros(len(buffer) + 1, np.uint64)
            np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * self.up[: len(buffer)], out=total[1:])
            return (total[length:] - total[:-length]) * self.down[: len(buffer) - length + 1]

    @staticmethod
    def doubled(rank: np.ndarray, offset: int) -> np.ndarray:
        """By the pair of ranks at a place and ``offset`` behind it."""
        return mixed(rank[: len(rank) - offset], rank[offset:])


def mixed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A pair of ranks as one number, spread over all numbers."""
    with np.errstate(over="ignore"):
        found = (one ^ (one >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + two
        found = (found ^ (found >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return found ^ (found >> np.uint64(29))


def half_ranks(ranker: _Ranker, buffer: np.ndarray, threshold: int) -> np.ndarray:
    """Ranks of the strings of half the threshold, rounded up, by pairs of a quarter."""
    half = (threshold + 1) // 2
    quarter = (half + 1) // 2
    return ranker.doubled(ranker.first(buffer, quarter), half - quarter)


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values, by running minima of blocks from both sides."""
    number = len(values) - width + 1
    padded = np.concatenate((values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)))
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:number], ahead[width - 1 : width - 1 + number])


class _Buffer:
    """Texts side by side, long ones in pieces, and the places where a string of threshold length starts."""

    def __init__(self, pieces: list[bytes], owners: list[int], offsets: list[int], threshold: int) -> None:
        self.raw = b"".join(pieces)
        self.bytes = np.frombuffer(self.raw, np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(sizes) - sizes
        counts = sizes - threshold + 1
        self.places = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        self.owner = np.repeat(np.array(owners, np.int64), counts)
        # What to add to a place of the buffer for the place in its text.
        self.shift = np.repeat(np.array(offsets, np.int64) - starts, counts)


def buffers(texts: list[bytes], threshold: int) -> Iterator[_Buffer]:
    """Buffers that hold every string of threshold length of every text once; memory does not follow
    the longest text."""
    pieces, owners, offsets, size = [], [], [], 0
    for owner, text in enumerate(texts):
        for at in range(0, len(text) - threshold + 1, BUFFER):
            piece = text[at : at + BUFFER + threshold - 1]
            if pieces and size + len(piece) > BUFFER + threshold:
                yield _Buffer(pieces, owners, offsets, threshold)
                pieces, owners, offsets, size = [], [], [], 0
            pieces.append(piece)
            owners.append(owner)
            offsets.append(at)
            size += len(piece)
    if pieces:
        yield _Buffer(pieces, owners, offsets, threshold)


def chosen(ranker: _Ranker, held: _Buffer, threshold: int) -> tuple[np.ndarray, ...]:
    """(rank, place, first, last): each chosen inner string, and the first and last index, into
    ``held.places``, of the neighbouring strings that choose it."""
    rank = half_ranks(ranker, held.bytes, threshold)
    marked = (rank & ~_PLACE) | np.arange(len(rank), dtype=np.uint64)
    least = window_least(marked, threshold - (threshold + 1) // 2 + 1)[held.places]
    place = (least & _PLACE).astype(np.int64)
    new = (place[1:] != place[:-1]) | (held.places[1:] != held.places[:-1] + 1)
    first = np.flatnonzero(np.concatenate(([True], new)))
    last = np.concatenate((first[1:], [len(place)])) - 1
    return rank[place[first]], place[first], first, last


def _several(names: list[np.ndarray]) -> pa.RecordBatch:
    found, counts = np.unique(np.concatenate(names), return_counts=True)
    columns = [pa.array(found.view(np.int64)), pa.array(counts > 1)]
    return pa.RecordBatch.from_arrays(columns, ["rank", "many"])


def _named(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(rank, many) of the ranks, each once for every ``HELD`` of them."""
    names, size = [], 0
    for more in found:
        names.append(more)
        size += len(more)
        if size >= HELD:
            yield _several(names)
            names, size = [], 0
    if size:
        yield _several(names)


def merged_spans(key: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans [lo, hi) of texts, those that touch joined."""
    order = np.lexsort((lo, size, key))
    key, size, lo, hi = key[order], size[order], lo[order], hi[order]
    if not len(key):
        return key, size, lo, hi
    text = np.concatenate(([True], (key[1:] != key[:-1]) | (size[1:] != size[:-1])))
    number = np.cumsum(text)
    # Ends never fall within a text once raised above all earlier ends of it.
    bound = int(hi.max()) + 1
    high = np.maximum.accumulate(hi + number * bound) - number * bound
    new = text.copy()
    new[1:] |= lo[1:] > high[:-1]
    starts = np.flatnonzero(new)
    ends = np.concatenate((starts[1:], [len(key)])) - 1
    return key[starts], size[starts], lo[starts], high[ends]


def _settled(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """What a task knows by itself of (rank, one, two, key, size, lo, hi, asks), and what it has to ask.

    Rows of equal (one, two) are repeated: their spans are sure, and one row of them goes on with
    ``many``. All others go on as they are.
    """
    rank, one, two, key, size, lo, hi, asks = (np.concatenate(column) for column in zip(*rows))
    order = np.lexsort((two, one))
    same = np.concatenate(([False], (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])))
    first = np.flatnonzero(~same)
    counts = np.diff(np.concatenate((first, [len(order)])))
    many = counts > 1
    sent = order[first]
    sure = order[np.repeat(many, counts)]
    sure = sure[asks[sure]]
    spans = merged_spans(key[sure], size[sure], lo[sure], hi[sure])
    number, known = len(sent), len(spans[0])
    nothing = np.zeros(known, np.int64)
    columns = {
        "sure": np.concatenate((np.zeros(number, bool), np.ones(known, bool))),
        "rank": np.concatenate((rank[sent].view(np.int64), nothing)),
        "one": np.concatenate((one[sent].view(np.int64), nothing)),
        "two": np.concatenate((two[sent].view(np.int64), nothing)),
        "many": np.concatenate((many, np.zeros(known, bool))),
        "key": np.concatenate((key[sent], spans[0])),
        "size": np.concatenate((size[sent], spans[1])),
        "lo": np.concatenate((lo[sent], spans[2])),
        "hi": np.concatenate((hi[sent], spans[3])),
        "asks": np.concatenate((asks[sent] & ~many, np.zeros(known, bool))),
    }
    return pa.RecordBatch.from_arrays([pa.array(column) for column in columns.values()], list(columns))


def _settling(found: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for more in found:
        rows.append(more)
        size += len(more[0])
        if size >= HELD:
            yield _settled(rows)
            rows, size = [], 0
    if size:
        yield _settled(rows)


def _keys_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in _KEY)


def _hits(bits: np.ndarray, rank: np.ndarray) -> np.ndarray:
    place = (rank & np.uint64(MAP_BITS - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _run_names(threshold: int):
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = _Ranker()

        def found() -> Iterator[np.ndarray]:
            for batch in slices(batches):
                for held in buffers(texts_of(batch), threshold):
                    yield chosen(ranker, held, threshold)[0]

        yield from _named(found())

    return of_task


def _runs(threshold: int, repeated):
    """Runs whose inner string may be repeated, with the hash of their bytes and of the place in them."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker, bits = _Ranker(), repeated.value

        def found() -> Iterator[tuple[np.ndarray, ...]]:
            for batch in slices(batches):
                key, size = _keys_of(batch)
                for held in buffers(texts_of(batch), threshold):
                    rank, place, first, last = chosen(ranker, held, threshold)
                    able = np.flatnonzero(_hits(bits, rank))
                    rank, place, first, last = rank[able], place[able], first[able], last[able]
                    begin, end = held.places[first], held.places[last] + threshold
                    digest = xxhash.xxh3_128_digest
                    prints = [
                        digest(held.raw[i:j], inner)
                        for i, j, inner in zip(begin.tolist(), end.tolist(), (place - begin).tolist())
                    ]
                    pairs = np.frombuffer(b"".join(prints), "<u8").reshape(-1, 2)
                    owner, shift = held.owner[first], held.shift[first]
                    asks = np.ones(len(able), bool)
                    yield rank, pairs[:, 0], pairs[:, 1], key[owner], size[owner], begin + shift, end + shift, asks

        yield from _settling(found())

    return of_task


def _strings(threshold: int):
    """The bytes of wanted runs of each text."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "size", "lo", "asks", "text"]
        for batch in slices(batches, 32):
            rows = []
            columns = (batch.column(name).to_pylist() for name in ("key", "size", "runs"))
            for text, key, size, runs in zip(texts_of(batch), *columns):
                rows.extend((key, size, run["lo"], run["asks"], text[run["lo"] : run["hi"]]) for run in runs)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            made = zip(zip(*rows), kinds) if rows else (([], kind) for kind in kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in made], names)

    return of_task


def _pairs(ranker: _Ranker, held: _Buffer, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    rank = half_ranks(ranker, held.bytes, threshold)
    return rank[held.places], rank[held.places + threshold - (threshold + 1) // 2]


def _place_names(threshold: int):
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = _Ranker()

        def found() -> Iterator[np.ndarray]:
            for batch in slices(batches):
                for held in buffers(texts_of(batch), threshold):
                    yield mixed(*_pairs(ranker, held, threshold))

        yield from _named(found())

    return of_task


def _places(threshold: int, repeated):
    """Every position of the runs that are left, if its pair of ranks may be repeated."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker, bits = _Ranker(), repeated.value

        def found() -> Iterator[tuple[np.ndarray, ...]]:
            for batch in slices(batches):
                key, size = _keys_of(batch)
                lo = batch.column("lo").to_numpy(zero_copy_only=False)
                asks = batch.column("asks").to_numpy(zero_copy_only=False)
                for held in buffers(texts_of(batch), threshold):
                    one, two = _pairs(ranker, held, threshold)
                    rank = mixed(one, two)
                    able = np.flatnonzero(_hits(bits, rank))
                    owner = held.owner[able]
                    begin = held.places[able] + held.shift[able] + lo[owner]
                    yield (
                        *(rank[able], one[able], two[able], key[owner], size[owner]),
                        *(begin, begin + threshold, asks[owner].astype(bool)),
                    )

        yield from _settling(found())

    return of_task


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    for batch in slices(batches, 32):
        removed, number, digests = [], [], []
        for text, spans in zip(texts_of(batch), batch.column("spans")):
            lo, hi = (spans.values.field(name).to_numpy() for name in ("lo", "hi"))
            nothing = np.zeros(len(lo), np.int64)
            _, _, lo, hi = merged_spans(nothing, nothing, lo, hi)
            left, digest = 0, hashlib.sha256()
            for i, j in zip(lo.tolist(), hi.tolist()):
                digest.update(text[left:i])
                left = j
            digest.update(text[left:])
            removed.append(int((hi - lo).sum()))
            number.append(len(lo))
            digests.append(digest.hexdigest())
        columns = [batch.column(name) for name in _KEY]
        columns += [pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [*_KEY, "n_removed", "n_spans", "kept_sha256"])


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 32):
        texts = []
        for text, spans in zip(texts_of(batch), batch.column("spans")):
            lo, hi = (spans.values.field(name).to_numpy() for name in ("lo", "hi"))
            nothing = np.zeros(len(lo), np.int64)
            _, _, lo, hi = merged_spans(nothing, nothing, lo, hi)
            edges = zip([0, *hi.tolist()], [*lo.tolist(), len(text)])
            texts.append(b"".join(text[i:j] for i, j in edges))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in _KEY), pa.array(texts, pa.binary())], [*_KEY, "kept"]
        )


def _map_of(names: DataFrame):
    """A bit map, of fixed size and broadcast, of the ranks that several positions have."""
    several = names.groupBy("rank").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n")).where("n > 1")
    place = F.col("rank").bitwiseAND(F.lit(MAP_BITS - 1).cast("long"))
    row = F.floor(place / BITS_PER_ROW).cast("int")
    maps = several.select(row.alias("row"), (place % BITS_PER_ROW).alias("bit"))
    bits = np.zeros(MAP_BITS // 8, np.uint8)
    for found in maps.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("map")).toLocalIterator():
        at = found["row"] * BITS_PER_ROW // 8
        bits[at : at + BITS_PER_ROW // 8] = np.frombuffer(found["map"], np.uint8)
    return names.sparkSession.sparkContext.broadcast(bits)


def _judged(settled: DataFrame) -> DataFrame:
    """The rows that ask or answer, sorted by their pair: how often it occurs, and one row of each.

    A pair comes at most once from each lot that a task passes on, so no group is large.
    """
    same = Window.partitionBy("one", "two")
    weight = F.when(F.col("many"), 2).otherwise(1)
    total = F.sum(weight).over(same)
    first = F.row_number().over(same.orderBy("key", "size", "lo")) == 1
    return settled.where(~F.col("sure")).withColumn("total", total).withColumn("first", first)


def _spans_of(settled: DataFrame, judged: DataFrame) -> DataFrame:
    found = judged.where(F.col("asks") & (F.col("total") > 1))
    columns = (*_KEY, "lo", "hi")
    return settled.where("sure").select(*columns).unionByName(found.select(*columns))


def _texts_with(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Each text that ``rows``, one row a text, names, once, with their columns."""
    key = F.struct(*_KEY)
    maybe = with_membership(texts, key, rows, key, "wanted").where("wanted")
    once = maybe.groupBy(*_KEY).agg(F.first("text").alias("text"))
    return once.join(rows, list(_KEY))


def _texts(docs: DataFrame) -> DataFrame:
    rows = pick(docs, "text").select(text_of().alias("text"))
    return rows.select(F.xxhash64("text").alias("key"), F.octet_length("text").cast("long").alias("size"), "text")


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(key, size, spans) of each text that has a string of ``threshold`` bytes that also starts
    elsewhere; key and size are the hash and the byte length of the text.

    ``spans`` are [lo, hi) in bytes that together cover these strings; they may overlap. Rows of equal
    text are different places, so all of an equal text of threshold length is covered. A null text
    counts as empty; texts shorter than the threshold have no such string.
    """
    if threshold < 4:
        raise ValueError("the threshold is four bytes at least")
    texts = _texts(docs).where(F.col("size") >= threshold)
    repeated = _map_of(texts.mapInArrow(_run_names(threshold), "rank LONG, many BOOLEAN"))
    runs = stored(texts.mapInArrow(_runs(threshold, repeated), _RUN), "suffix-runs")
    judged = stored(_judged(runs), "suffix-judged")

    alone = F.col("total") == 1
    kinds = judged.where("first").groupBy("rank").agg(F.count("*").alias("n"), F.count_if(alone).alias("alone"))
    open_ranks = kinds.where("n > 1 and alone > 0").select("rank")
    left = judged.where("first").join(open_ranks, "rank").select(*_KEY, "lo", "hi", alone.alias("asks"))
    wanted = left.groupBy(*_KEY).agg(F.collect_list(F.struct("lo", "hi", "asks")).alias("runs"))
    wanted = stored(wanted, "suffix-wanted")
    strings = _texts_with(texts, wanted).mapInArrow(
        _strings(threshold), "key LONG, size LONG, lo LONG, asks BOOLEAN, text BINARY"
    )
    strings = stored(strings, "suffix-strings")
    discard(wanted)

    repeated = _map_of(strings.mapInArrow(_place_names(threshold), "rank LONG, many BOOLEAN"))
    places = stored(strings.mapInArrow(_places(threshold, repeated), _RUN), "suffix-places")
    discard(strings)
    spans = _spans_of(runs, judged).unionByName(_spans_of(places, _judged(places)))
    longest = spans.groupBy(*_KEY, "lo").agg(F.max("hi").alias("hi"))
    grouped = stored(longest.groupBy(*_KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "suffix-spans")
    discard(runs, judged, places)
    return grouped


def repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    Texts are UTF-8 bytes, null as empty. A byte is removed if a string of ``threshold`` bytes that
    covers it also starts anywhere else, in the same text too; strings never cross texts. Rows that
    repeat a text, a doc_id or both are rows like any other, and so is a null doc_id. An empty table
    gives no rows.
    """
    found = repeated_spans(docs, threshold)
    results = _texts_with(_texts(docs), found).mapInArrow(
        _kept, "key LONG, size LONG, n_removed LONG, n_spans LONG, kept_sha256 STRING"
    )
    results = stored(results, "suffix-results")
    discard(found)
    text = text_of()
    narrow = pick(docs, "doc_id", "text").select(
        "doc_id",
        F.xxhash64(text).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
        F.sha2(text.cast("binary"), 256).alias("whole"),
    )
    joined = narrow.join(results, list(_KEY), "left")
    return joined.select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs``, all columns, with the bytes left of each text as a binary column ``kept`` at the end.

    What is left need not be whole characters, so it is bytes; a text without repeats is left whole.
    """
    rows, at = numbered(docs)
    results = _texts_with(_texts(docs), repeated_spans(docs, threshold))
    results = stored(results.mapInArrow(_left, "key LONG, size LONG, kept BINARY"), "suffix-left")
    results = results.toDF("_key", "_size", "_kept")
    text = text_of(at["text"])
    same = (F.xxhash64(text) == F.col("_key")) & (F.octet_length(text).cast("long") == F.col("_size"))
    kept = F.coalesce("_kept", text.cast("binary"))
    return rows.join(results, same, "left").select(*rows.columns, kept).toDF(*docs.columns, "kept")
