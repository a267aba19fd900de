"""Importance resampling towards a target distribution, by hashed word n-grams.

In a text, all that parts words collapses to single spaces. One regular expression, matched at every
place with overlaps, finds the runs of 1 to 3 words that start at each word and end before a space;
its groups are their spans. The CRC of a run goes on from that of the run it extends.

1. One scan turns each text into the buckets of its features, two bytes a feature, which are stored:
   scanning costs far more than reading them again.
2. Features are counted by bucket, for the corpus and for the target; a task passes on one number a
   bucket. The gain of each of the 10,000 buckets is broadcast.
3. A document's gains are summed, and a Gumbel noise drawn from its id makes the highest scores a
   sample without replacement. Range partitions and the counts of earlier ones rank the documents.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quakelake.llm.support import discard, numbered, pick, slices, stored, texts_of

BUCKETS = 10_000
LEAST_WORDS = 20
# Documents drawn of every 100 that have enough words.
PERCENT = 5
SEED = 42
# A space starts each match, so that the search for it is plain; the ends look ahead for one.
SPANS = regex.compile(rb" ([^ ]++)(?= )(?:( [^ ]++)(?= )(?:( [^ ]++)(?= ))?+)?+")
# Bytes that belong to words, A-Z as a-z; all others part them. Bytes from 128 on are parts of
# characters, which all belong to words.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_FEATURES = "doc_id LONG, n_words LONG, buckets BINARY"


def buckets_of(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words of a UTF-8 text, and the bucket of each of its features.

    Features are held four bytes each while the text is scanned.
    """
    spaced = b" %s " % b" ".join(text.translate(_PLAIN).split())
    prints, words = array("I"), 0
    for match in SPANS.finditer(spaced, overlapped=True):
        one, two, three = match.end(1, 2, 3)
        words += 1
        run = crc32(spaced[match.start() + 1 : one])
        prints.append(run)
        if two > 0:
            run = crc32(spaced[one:two], run)
            prints.append(run)
            if three > 0:
                prints.append(crc32(spaced[two:three], run))
    return words, (np.frombuffer(prints, np.uint32) % buckets).astype("<u2") if words else np.zeros(0, "<u2")


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, by the document's id; a null id is the empty text."""
    named = f"{seed}:{'' if doc_id is None else doc_id}"
    place = int(hashlib.sha256(named.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((place + 0.5) / 4294967296)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 64):
        found = [buckets_of(text) for text in texts_of(batch)]
        columns = [
            batch.column("doc_id"),
            pa.array([words for words, _ in found], pa.int64()),
            pa.array([buckets.tobytes() for _, buckets in found], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "buckets"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in slices(batches):
        held = np.frombuffer(b"".join(batch.column("buckets").to_pylist()), "<u2")
        total += np.bincount(held, minlength=BUCKETS)
    seen = np.flatnonzero(total)
    columns = [pa.array(seen.astype(np.int32)), pa.array(total[seen])]
    yield pa.RecordBatch.from_arrays(columns, ["bucket", "n"])


def _bucket_counts(features: DataFrame) -> np.ndarray:
    counted = features.select("buckets").mapInArrow(_counts, "bucket INT, n LONG")
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(BUCKETS, np.int64)
    total[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier each bucket is in the target, rounded down."""
    all_corpus, all_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = (float(t + 1) * all_corpus / (float(s + 1) * all_target) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def _scored(gain: np.ndarray):
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            held = [np.frombuffer(value, "<u2") for value in batch.column("buckets").to_pylist()]
            weight = [int(gain[buckets].sum()) for buckets in held]
            score = [w + noise(i) for w, i in zip(weight, batch.column("doc_id").to_pylist())]
            columns = [pa.array(column, pa.int64()) for column in ([len(b) for b in held], weight, score)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), *columns],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return of_task


def _text_rows(rows: DataFrame, key: str) -> DataFrame:
    return pick(rows, key, "text").toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, target_key: str = "item_id") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    The highest scores among the rows with ``LEAST_WORDS`` words are drawn, ``percent`` of every
    hundred, and have a rank from 1 on; ties go to the smaller doc_id, null last. Of rows that repeat
    a doc_id each is drawn for itself. A null text has no words and no features. An empty target
    counts as one that has each bucket equally often; an empty table gives no rows.
    """
    features = stored(_text_rows(docs, "doc_id").mapInArrow(_features, _FEATURES), "features")
    wanted = _text_rows(target.withColumn(target_key, F.lit(None).cast("long")), target_key)
    gain = gains(_bucket_counts(features), _bucket_counts(wanted.mapInArrow(_features, _FEATURES)))
    scored = features.mapInArrow(
        _scored(gain), "doc_id LONG, n_words LONG, n_features LONG, weight LONG, score LONG"
    )
    scored = stored(scored, "scored")
    discard(features)

    able = scored.where(F.col("n_words") >= LEAST_WORDS)
    drawn = percent * able.count() // 100
    order = (F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"))
    dealt = stored(able.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "dealt")
    totals = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    # One row for each partition of the shuffle.
    placed = dealt.join(F.broadcast(totals.select("part", before.alias("before"))), "part")
    columns = ("doc_id", "n_features", "weight", "score")
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    high = placed.where(F.col("before") < drawn).select(*columns, place.alias("place"))
    ranked = high.select(*columns, F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
    nothing = F.lit(None).cast("long").alias("rank")
    low = placed.where(F.col("before") >= drawn).select(*columns, nothing)
    short = scored.where(F.col("n_words") < LEAST_WORDS).select(*columns, nothing)
    return ranked.unionByName(low).unionByName(short)


def drawn_documents(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, that have a drawn doc_id."""
    rows, at = numbered(docs)
    chosen = resample(docs, target, percent).where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn"))
    same = F.col(at["doc_id"]).cast("long").eqNullSafe(F.col("_drawn"))
    return rows.join(chosen, same, "left_semi").toDF(*docs.columns)
