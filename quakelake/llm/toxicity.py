"""Toxicity by non-negative positive-unlabelled learning.

Classifiers learn from confirmed toxic texts and from unlabelled ones; no text counts as confirmed
clean. With the share of toxic texts as class prior p, the risk of a score f is

    p * E_toxic[loss(f)] + max(0, E_unlabelled[loss(-f)] - p * E_toxic[loss(-f)])

whose second term estimates the risk on clean texts. It cannot be negative; where a step would make
it so, the step goes the other way. A text's features are the hashed runs of five bytes that it has
once, twice or four times at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakelake.llm.mixing import chance
from quakelake.llm.support import numbered, pick, settle, slices, stored, texts_of

GRAM = 5
HASH_BITS = 20
# A run has a feature for each of these numbers of times that a text has it.
TIMES = (1, 2, 4)
# Bounds of the sample that classifiers are fitted on, in documents.
TOXIC_SAMPLE = 6000
UNLABELLED_SAMPLE = 12000
CLASSIFIERS = 3
# Features that are kept: those whose share differs between the samples by so many deviations, which
# are the root of the likelihood ratio: it holds for small counts too, so the rule is one for all sizes.
FEATURES = 2048
LEAST_DEVIATIONS = 2.5
STEPS = 200
STEP_SIZE = 0.1
SHRINK = 1e-3
FOLDS = 5
HELD_OUT = 0
_BYTES_AT_A_TIME = 1 << 20


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def _grams(text: bytes) -> Iterator[np.ndarray]:
    """Hashes of all runs of GRAM bytes, ASCII letters lowered and white space made one blank."""
    data = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", np.uint8).astype(np.uint64)
    for at in range(0, max(1, len(data) - GRAM + 1), _BYTES_AT_A_TIME):
        part = data[at : at + _BYTES_AT_A_TIME + GRAM - 1]
        number = len(part) - GRAM + 1
        if number < 1:
            continue
        code = np.zeros(number, np.uint64)
        for i in range(GRAM):
            code = (code << np.uint64(8)) | part[i : i + number]
        with np.errstate(over="ignore"):
            yield (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)


def _features(grams: list[np.ndarray]) -> np.ndarray:
    """The features of runs met, in order: each run, marked with the times reached."""
    if not grams:
        return np.zeros(0, np.int32)
    runs, counts = np.unique(np.concatenate(grams).astype(np.int32), return_counts=True)
    return np.concatenate([runs[counts >= least] | (i << HASH_BITS) for i, least in enumerate(TIMES)])


def features(text: bytes) -> np.ndarray:
    """The distinct features of a whole text, in order."""
    return _features(list(_grams(text)))


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(values / 2))


def fit(
    places: np.ndarray, lengths: np.ndarray, toxic: np.ndarray, width: int, prior: float
) -> tuple[np.ndarray, float]:
    """Weights and bias of one classifier.

    ``places`` has the places of each row's features, row after row; ``lengths`` how many each has.
    """
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    n_toxic, n_rest = max(1, toxic.sum()), max(1, (~toxic).sum())
    values = np.zeros(width + 1)
    values[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        score = np.bincount(owner, values[places], len(lengths)) + values[-1]
        high = _sigmoid(score)
        clean_risk = np.logaddexp(0, score[~toxic]).sum() / n_rest
        clean_risk -= prior * np.logaddexp(0, score[toxic]).sum() / n_toxic
        if clean_risk >= 0:
            slope = np.where(toxic, -prior / n_toxic, high / n_rest)
        else:
            slope = np.where(toxic, prior * high / n_toxic, -high / n_rest)
        change = np.append(np.bincount(places, slope[owner], width), slope.sum())
        change[:-1] += SHRINK * values[:-1]
        mean = 0.9 * mean + 0.1 * change
        square = 0.999 * square + 0.001 * change**2
        values -= STEP_SIZE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return values[:-1], float(values[-1])


@dataclass
class Model:
    """Chosen features, and weights and bias of each classifier."""

    chosen: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def scorer(self):
        """A function of whole texts that gives the mean probability of the classifiers."""
        place = np.full(len(TIMES) << HASH_BITS, -1, np.int32)
        place[self.chosen] = np.arange(len(self.chosen))
        wanted = np.zeros(1 << HASH_BITS, bool)
        wanted[self.chosen & ((1 << HASH_BITS) - 1)] = True

        def score(text: bytes) -> float:
            hit = place[_features([part[wanted[part]] for part in _grams(text)])]
            return float(_sigmoid(self.weights[:, hit[hit >= 0]].sum(axis=1) + self.bias).mean())

        return score


def _first_by_chance(ids: DataFrame, of: int, number: int, seed: str) -> DataFrame:
    """At most so many ids, chosen by a hash, of a table of ``of`` rows.

    The last step is one task's work. It gets only the ids whose hash is low enough, about twice as
    many as are wanted, however many tasks there are.
    """
    drawn = chance(F.col("doc_id"), seed)
    low = 2.0 * (number + 1000) / max(1, of)
    return ids.where(drawn < low).orderBy(drawn, "doc_id").limit(number)


def _confirmed(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of labelled ids outside the held-out fold; toxic where all labels say so."""
    known = pick(labels, "doc_id", "toxic").dropna().where(fold(F.col("doc_id")) != HELD_OUT)
    return known.groupBy("doc_id").agg((F.min("toxic") == 1).alias("toxic"))


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    settle()
    for batch in slices(batches):
        found = pa.array([features(text) for text in texts_of(batch)], pa.list_(pa.int32()))
        names = ["doc_id", "toxic"]
        yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), found], [*names, "features"])


def _places_of(chosen: np.ndarray):
    """Features replaced by their places among the chosen; the others fall away."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for row in batch.column("features"):
                places = np.searchsorted(chosen, row.values.to_numpy())
                places[places == len(chosen)] = 0
                found.append(places[chosen[places] == row.values.to_numpy()].astype(np.int32))
            names = ["doc_id", "toxic"]
            columns = [*(batch.column(name) for name in names), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "places"])

    return of_task


def _trained(width: int, prior: float):
    def of_classifier(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("toxic", "ascending")]).combine_chunks()
        toxic = rows.column("toxic").to_numpy().astype(bool)
        places = rows.column("places").combine_chunks()
        lengths = places.value_lengths().to_numpy(zero_copy_only=False)
        weights, bias = fit(places.flatten().to_numpy(), lengths, toxic, width, prior)
        return pa.table({"weights": pa.array([weights]), "bias": pa.array([bias])})

    return of_classifier


def _deviations(a: Column, b: Column, n_toxic: int, n_rest: int) -> Column:
    """Root of the likelihood-ratio statistic of a of n_toxic texts against b of n_rest."""

    def cell(found: Column, of: int, both: Column) -> Column:
        return F.when(found > 0, found * F.log(found * (n_toxic + n_rest) / (both * of))).otherwise(0.0)

    have, lack = a + b, n_toxic + n_rest - a - b
    cells = cell(a, n_toxic, have) + cell(b, n_rest, have)
    cells = cells + cell(n_toxic - a, n_toxic, lack) + cell(n_rest - b, n_rest, lack)
    return F.sqrt(F.greatest(2 * cells, F.lit(0.0)))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Classifiers from the rows outside the held-out fold.

    The sample holds at most ``TOXIC_SAMPLE`` confirmed toxic and ``UNLABELLED_SAMPLE`` other rows,
    both chosen by hash from all, so its ids may be broadcast and what is collected (features
    chosen, weights) has a fixed bound. Each classifier sees all toxic texts and a share of the
    unlabelled ones. Without a confirmed toxic text the model scores every text with the prior.
    """
    confirmed = stored(_confirmed(labels), "toxicity-labels")
    n_known, n_toxic = confirmed.agg(F.count("*"), F.count_if("toxic")).first()
    prior = min(0.99, max(0.001, n_toxic / n_known)) if n_known else 0.001
    ids = pick(docs, "doc_id").dropna().where(fold(F.col("doc_id")) != HELD_OUT)
    toxic_ids = _first_by_chance(confirmed.where("toxic").select("doc_id"), n_toxic, TOXIC_SAMPLE, "toxic")
    other_ids = _first_by_chance(ids, ids.count(), UNLABELLED_SAMPLE, "unlabelled").distinct()
    sampled = toxic_ids.select("doc_id", F.lit(True).alias("toxic")).unionByName(
        other_ids.select("doc_id", F.lit(False).alias("toxic"))
    )
    sampled = F.broadcast(stored(sampled, "toxicity-sample"))
    texts = pick(docs, "doc_id", "text").join(sampled, "doc_id").select(
        F.col("doc_id").cast("long"), "toxic", "text"
    )
    sample = texts.mapInArrow(_features_of, "doc_id LONG, toxic BOOLEAN, features ARRAY<INT>")
    sample = stored(sample, "toxicity-features")
    n_toxic, n_rest = sample.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    nothing = Model(np.zeros(0, np.int32), np.zeros((1, 0)), np.array([np.log(prior / (1 - prior))]))
    if not n_toxic or not n_rest:
        return nothing
    counted = sample.select("toxic", F.explode("features").alias("feature")).groupBy("feature")
    counted = counted.agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    best = counted.withColumn("gap", _deviations(F.col("a"), F.col("b"), n_toxic, n_rest))
    best = best.where(F.col("gap") >= LEAST_DEVIATIONS)
    best = best.orderBy(F.desc("gap"), "feature").limit(FEATURES)
    chosen = np.array(sorted(row["feature"] for row in best.select("feature").collect()), np.int32)
    if not len(chosen):
        return nothing
    narrow = sample.mapInArrow(_places_of(chosen), "doc_id LONG, toxic BOOLEAN, places ARRAY<INT>")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(CLASSIFIERS)).cast("int")
    everyone = F.sequence(F.lit(0), F.lit(CLASSIFIERS - 1))
    dealt = narrow.withColumn("classifier", F.explode(F.when(F.col("toxic"), everyone).otherwise(F.array(share))))
    trained = dealt.groupBy("classifier").applyInArrow(_trained(len(chosen), prior), "weights ARRAY<DOUBLE>, bias DOUBLE")
    rows = sorted(trained.collect(), key=lambda row: (row["bias"], row["weights"]))
    return Model(chosen, np.array([row["weights"] for row in rows]), np.array([row["bias"] for row in rows]))


def _scores(model: Model):
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in slices(batches):
            found = pa.array([score(text) for text in texts_of(batch)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    return of_task


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; only its text makes a row's score.

    A null text is empty; empty texts are scored too. Rows of null doc_id are never held out and
    never learnt from. Repeated rows score alike. An empty table gives no rows. Tables of documents
    and labels may be empty: the score is the prior then.
    """
    model = learn(docs, labels)
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    scored = rows.mapInArrow(_scores(model), "doc_id LONG, score DOUBLE")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic. Nothing is shuffled."""
    model = learn(docs, labels)
    rows, at = numbered(docs)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        score = model.scorer()
        for batch in slices(batches):
            yield batch.filter(pa.array([score(text) < 0.5 for text in texts_of(batch, at["text"])], pa.bool_()))

    return rows.mapInArrow(kept, rows.schema).toDF(*docs.columns)
