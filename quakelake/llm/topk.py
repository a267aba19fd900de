"""Exact top-k search by inner product over a pivot-distance index.

Vectors are whole numbers. Each is keyed by its nearest pivot and its distance to it, and the table
is sorted by both and cut into annuli: runs of vectors of one pivot between two distances. For a
query q at distance d from a pivot, the triangle inequality bounds the distance to every vector of
an annulus from below by its gap to d, and with the annulus' largest norm

    q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2 <= (|q|^2 + norm^2 - gap^2) / 2.

Annuli are expanded from the highest bound on, until the bound of the next one falls below the k-th
best score found. Ties are expanded too, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quakelake.llm.mixing import chance
from quakelake.llm.support import pick, stored

SCALE = 256
TOP = 5
PIVOTS = 64
# Vectors of an annulus; vectors and queries that one task holds.
ANNULUS = 512
TASK_VECTORS = 1 << 18
TASK_QUERIES = 1 << 16
QUERIES_AT_A_TIME = 256
# Components beyond this have scores that no long holds.
LARGEST = 2**31
_EXACT_DOUBLE = 2.0**53
_EXACT_LONG = 2.0**62

_ANNULI = (
    "part INT, pivot INT, near DOUBLE, far DOUBLE, norm DOUBLE, ids BINARY, places BINARY, vectors BINARY,"
    " query BINARY, floors BINARY"
)


def whole_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, place, vec), stored: the vectors that take part, as arrays of whole numbers.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows of null
    key. ``place`` tells rows apart, also those that repeat a key. A vector with a component beyond
    ``LARGEST`` or a squared norm beyond a long fails the job: no long holds its scores.
    """
    kept = pick(rows, key, vector).toDF("vec_id", "vec").where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    wide = F.transform("vec", lambda x: x.cast("double"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = kept.select(F.col("vec_id").cast("long"), wide.alias("vec")).where(finite)
    norm = F.aggregate("vec", F.lit(0.0), lambda total, x: total + F.floor(x * SCALE).cast("double") ** 2)
    fits = F.forall("vec", lambda x: F.abs(x) <= LARGEST / SCALE) & (norm <= _EXACT_LONG)
    failure = F.raise_error(F.concat(F.lit("components too large for whole scores: "), F.col("vec_id").cast("string")))
    scaled = F.when(fits, F.transform("vec", lambda x: F.floor(x * SCALE))).otherwise(failure.cast("array<bigint>"))
    # The number is written with the rows, so a task that is run again later changes none.
    return stored(kept.select("vec_id", F.monotonically_increasing_id().alias("place"), scaled.alias("vec")), "vectors")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), width)


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, exactly: in doubles where they hold all partial sums, else in longs."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    most = np.abs(queries).max().astype(float) * np.abs(vectors).max() * queries.shape[1]
    if most < _EXACT_DOUBLE:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def _placed(pivots: np.ndarray):
    """Nearest pivot and the distance to it; of equally near ones the first."""
    middle = pivots.astype(np.float64)
    norms = (middle**2).sum(axis=1)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vec"), pivots.shape[1]).astype(np.float64)
            nearest = (norms - 2 * vectors @ middle.T).argmin(axis=1)
            distance = np.sqrt(((vectors - middle[nearest]) ** 2).sum(axis=1))
            columns = [pa.array(nearest.astype(np.int32)), pa.array(distance)]
            names = ["vec_id", "place", "vec"]
            own = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*own, *columns], [*names, "pivot", "distance"])

    return of_task


def best_rows(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the best scores, highest first, ties by smaller id."""
    if len(scores) > top:
        worst = np.partition(scores, len(scores) - top)[len(scores) - top]
        places = np.flatnonzero(scores >= worst)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:top]


def _annuli(width: int, every: int, top: int):
    """Annuli of a sorted partition, each with the k-th score its own queries reach within it."""

    def made(pivot: int, rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, places, distance, vectors = (np.concatenate(part) for part in zip(*rows))
        queries = np.flatnonzero(ids % every == 0)
        floors = np.full(len(queries), np.iinfo(np.int64).min)
        scores = _scores(vectors[queries], vectors)
        for i, query in enumerate(queries):
            others = np.delete(scores[i], query)
            if len(others) >= top:
                floors[i] = np.partition(others, len(others) - top)[len(others) - top]
        norm = float((vectors.astype(np.float64) ** 2).sum(axis=1).max())
        row = (
            (TaskContext.get().partitionId(), pivot, float(distance.min()), float(distance.max()), norm)
            + (ids.astype("<i8").tobytes(), places.astype("<i8").tobytes(), vectors.astype("<i8").tobytes())
            + (queries.astype("<i8").tobytes(), floors.astype("<i8").tobytes())
        )
        kinds = [pa.int32(), pa.int32()] + [pa.float64()] * 3 + [pa.binary()] * 5
        names = [field.split()[0] for field in _ANNULI.split(",")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, current = [], 0, None
        for batch in batches:
            pivots = batch.column("pivot").to_numpy()
            ids, distance = batch.column("vec_id").to_numpy(), batch.column("distance").to_numpy()
            places, vectors = batch.column("place").to_numpy(), _matrix(batch.column("vec"), width)
            at = 0
            while at < len(ids):
                if held and (size >= ANNULUS or pivots[at] != current):
                    yield made(current, held)
                    held, size = [], 0
                current = int(pivots[at])
                same = at + int(np.searchsorted(pivots[at:], current, side="right"))
                end = min(same, at + ANNULUS - size)
                held.append((ids[at:end], places[at:end], distance[at:end], vectors[at:end]))
                size, at = size + end - at, end
        if held:
            yield made(current, held)

    return of_task


def build_index(vectors: DataFrame, every: int, top: int = TOP, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """The stored annuli and the pivots, a fixed number of vectors drawn by hash.

    Range partitioning by pivot, distance and place spreads equal vectors over tasks too.
    """
    drawn = vectors.orderBy(chance(F.col("vec_id"), "pivot"), "vec_id", "vec").limit(pivots).collect()
    middle = np.array([row["vec"] for row in drawn], np.int64).reshape(len(drawn), len(drawn[0]["vec"]))
    placed = vectors.mapInArrow(
        _placed(middle), "vec_id LONG, place LONG, vec ARRAY<LONG>, pivot INT, distance DOUBLE"
    )
    order = ("pivot", "distance", "vec_id", "place")
    dealt = stored(placed, "placed").repartitionByRange(*order).sortWithinPartitions(*order)
    annuli = dealt.mapInArrow(_annuli(middle.shape[1], every, top), _ANNULI)
    return stored(annuli, "annuli"), middle


def _search(middle: np.ndarray, top: int):
    """Scores of a group of queries against a group of annuli, the best of each query."""
    width = middle.shape[1]
    pivots = middle.astype(np.float64)

    def unpacked(rows: pa.Table, name: str) -> list[np.ndarray]:
        return [np.frombuffer(value, "<i8") for value in rows.column(name).to_pylist()]

    def of_block(own_places, queries, floors, index) -> list[tuple[np.ndarray, ...]]:
        rings, near, far, norm, members, places_of, vectors = index
        wide = queries.astype(np.float64)
        own = (wide**2).sum(axis=1)
        distance = np.sqrt(np.maximum(0, own[:, None] - 2 * wide @ pivots.T + (pivots**2).sum(axis=1)))[:, rings]
        gap = np.maximum(0, np.maximum(near - distance, distance - far))
        # A little more than the bound, for the rounding of the distances.
        bound = (own[:, None] + norm - gap**2) / 2
        bound += 1e-9 * (own[:, None] + norm + distance**2) + 1
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        floors = floors.copy()
        for ring in np.argsort(-bound.max(axis=0), kind="stable"):
            asking = np.flatnonzero(bound[:, ring] >= floors)
            if not len(asking):
                continue
            scores = _scores(queries[asking], vectors[ring])
            for query, row in zip(asking, scores):
                able = np.flatnonzero((row >= floors[query]) & (places_of[ring] != own_places[query]))
                if not len(able):
                    continue
                all_scores = np.concatenate((best[query][0], row[able]))
                all_ids = np.concatenate((best[query][1], members[ring][able]))
                places = best_rows(all_scores, all_ids, top)
                best[query] = all_scores[places], all_ids[places]
                if len(places) == top:
                    floors[query] = max(floors[query], all_scores[places[-1]])
        return best

    def of_group(asked: pa.Table, kept: pa.Table) -> pa.Table:
        names = ("query_id", "query_place", "vec_id", "score")
        schema = pa.schema([(name, pa.int64()) for name in names])
        if not asked.num_rows or not kept.num_rows:
            return schema.empty_table()
        members, places_of = unpacked(kept, "ids"), unpacked(kept, "places")
        vectors = [v.reshape(len(m), width) for v, m in zip(unpacked(kept, "vectors"), members)]
        rings, near, far, norm = (kept.column(name).to_numpy() for name in ("pivot", "near", "far", "norm"))
        ids, own_places = (np.concatenate(unpacked(asked, name)) for name in ("ids", "places"))
        queries = np.concatenate(unpacked(asked, "vectors")).reshape(len(ids), width)
        floors = np.concatenate(unpacked(asked, "floors"))
        index = (rings, near, far, norm, members, places_of, vectors)
        out: list[list[np.ndarray]] = [[] for _ in names]
        for at in range(0, len(ids), QUERIES_AT_A_TIME):
            part = slice(at, at + QUERIES_AT_A_TIME)
            found = of_block(own_places[part], queries[part], floors[part], index)
            for query, place, (scores, others) in zip(ids[part], own_places[part], found):
                for values, held in zip((np.full(len(others), query), np.full(len(others), place), others, scores), out):
                    held.append(values)
        return pa.table([np.concatenate(held) for held in out], schema=schema)

    return of_group


def _asked(width: int):
    """The queries of each annulus alone."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                queries = np.frombuffer(row["query"], "<i8")
                if len(queries):
                    ids = np.frombuffer(row["ids"], "<i8")
                    vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(ids), width)
                    places = np.frombuffer(row["places"], "<i8")
                    rows.append([each[queries].tobytes() for each in (ids, places, vectors)] + [row["floors"]])
            names = ["ids", "places", "vectors", "floors"]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            kinds = [pa.binary()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return of_task


def _dealt(number: Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(number), F.lit(groups)).cast("int")


def search(rows: DataFrame, every: int = 50, top: int = TOP, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the best rows of each query, all if there are fewer.

    Queries are the rows whose key is divisible by ``every``; the query's own row is no candidate.
    A row that repeats a key is a candidate, and a query, of its own. Vectors are searched among
    those of their length, as others have no inner product with them. See ``whole_vectors`` for the
    rows that take part. Ranks start at 1; ties go to the smaller key. An empty table, or one
    without a query, gives no rows.

    Groups of annuli meet groups of queries of bounded size, each pair in one task, and a task
    passes on no more than the best of each query.
    """
    vectors = whole_vectors(rows, key, vector)
    sizes = vectors.groupBy(F.size("vec").alias("n")).count().orderBy("n").collect()
    found = [_searched(vectors.where(F.size("vec") == row["n"]), row["count"], every, top) for row in sizes]
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id LONG, rank INT, vec_id LONG, score LONG")
    return reduce(DataFrame.unionAll, found)


def _searched(vectors: DataFrame, number: int, every: int, top: int) -> DataFrame:
    """The search among vectors of one length."""
    annuli, middle = build_index(vectors, every, top)
    # A group for each task slot at least, so that small tables are searched by all.
    slots = vectors.sparkSession.sparkContext.defaultParallelism
    index_groups = max(slots, -(-number // TASK_VECTORS))
    query_groups = max(1, -(-(number // every) // TASK_QUERIES))
    asked = annuli.mapInArrow(_asked(middle.shape[1]), "ids BINARY, places BINARY, vectors BINARY, floors BINARY")
    asked = asked.select(
        _dealt(F.col("places"), query_groups).alias("query_group"),
        F.explode(F.sequence(F.lit(0), F.lit(index_groups - 1))).alias("index_group"),
        *("ids", "places", "vectors", "floors"),
    )
    kept = annuli.select(
        _dealt(F.col("places"), index_groups).alias("index_group"),
        F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1))).alias("query_group"),
        *("pivot", "near", "far", "norm", "ids", "places", "vectors"),
    )
    pairs = asked.groupBy("query_group", "index_group").cogroup(kept.groupBy("query_group", "index_group"))
    found = pairs.applyInArrow(_search(middle, top), "query_id LONG, query_place LONG, vec_id LONG, score LONG")
    best = Window.partitionBy("query_place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
