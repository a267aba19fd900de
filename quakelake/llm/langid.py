"""Language identification: the language whose frozen context tree codes a text shortest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakelake.llm import ppm
from quakelake.llm.mixing import chance
from quakelake.llm.support import pick, slices, stored, texts_of
from quakelake.llm.toxicity import fold

FOLDS = 4
HELD_OUT = 2
UNDETERMINED = "und"
# Bound of the fit: documents of each language, expected. All languages are learnt.
DOCUMENTS = 400
# Languages whose trees a worker holds; with more, texts are read once for each such group.
GROUP = 32
# Languages up to which their rates are broadcast; beyond, rows are joined with them by a shuffle.
BROADCAST_LANGUAGES = 1 << 16

# Trees of the models that this worker has met.
_trees: dict[str, list[ppm.Tree]] = {}


@dataclass
class Model:
    """Counts of some languages, in order of their names; ``key`` names the model."""

    languages: list[str]
    counts: list[ppm.Counts]
    key: str

    @classmethod
    def of(cls, counts: dict[str, ppm.Counts]) -> Model:
        languages = sorted(counts)
        digest = hashlib.sha256(repr(languages).encode())
        for language in languages:
            digest.update(counts[language].runs.tobytes() + counts[language].counts.tobytes())
        return cls(languages, [counts[name] for name in languages], digest.hexdigest())

    def trees(self) -> list[ppm.Tree]:
        if self.key not in _trees:
            _trees.clear()
            _trees[self.key] = [ppm.Tree(each) for each in self.counts]
        return _trees[self.key]

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Nats that each language needs for the whole text."""
        trees = self.trees()
        lengths = np.zeros(len(trees))
        for codes in ppm.runs_of(text):
            lengths += [tree.cost(codes) for tree in trees]
        return lengths

    def best(self, text: bytes) -> tuple[str, float, float]:
        """The language, of equal ones the first by name; its code length; and the likelihood of all
        languages as a multiple of its own."""
        lengths = self.code_lengths(text)
        best = int(lengths.argmin())
        return self.languages[best], float(lengths[best]), float(np.exp(lengths[best] - lengths).sum())


def _counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, run, n) of each part of each text, so that no task holds more than one part."""
    for batch in slices(batches):
        for lang, text in zip(batch.column("lang"), texts_of(batch)):
            for codes in ppm.runs_of(text):
                counts = ppm.Counts.of(codes)
                langs = pa.repeat(lang, len(counts.runs))
                columns = [langs, pa.array(counts.runs), pa.array(counts.counts)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "run", "n"])


def _packed(rows: pa.Table) -> pa.Table:
    """All runs of one language as one row."""
    total = ppm.Counts.summed(*(rows.column(name).to_numpy() for name in ("run", "n")))
    packed = [[total.runs.astype("<i8").tobytes()], [total.counts.astype("<i8").tobytes()]]
    return pa.table([rows.column("lang").slice(0, 1), *packed], ["lang", "runs", "counts"])


def learn(docs: DataFrame) -> DataFrame:
    """(lang, runs, counts), stored: every language of rows outside the held-out fold.

    Each is learnt from a sample by hash of about ``DOCUMENTS`` whole texts. Their runs are counted
    in tasks and added up before a language's counts come together, whose number is bounded by the
    sample.
    """
    rows = pick(docs, "doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    rates = stored(sizes.select(F.col("lang").alias("of_lang"), (DOCUMENTS / F.col("n")).alias("rate")), "language-rates")
    if rates.count() <= BROADCAST_LANGUAGES:
        rates = F.broadcast(rates)
    drawn = chance(F.col("doc_id"), "language") < F.col("rate")
    sample = rows.join(rates, F.col("lang") == F.col("of_lang")).where(drawn).select("lang", "text")
    counted = sample.mapInArrow(_counts_of, "lang STRING, run LONG, n LONG")
    counted = counted.groupBy("lang", "run").agg(F.sum("n").alias("n"))
    packed = counted.groupBy("lang").applyInArrow(_packed, "lang STRING, runs BINARY, counts BINARY")
    return stored(packed, "language-counts")


def models(learnt: DataFrame) -> Iterator[Model]:
    """The languages in groups, in order of their names, each group fetched when it is wanted."""
    names = sorted(row["lang"] for row in learnt.select("lang").collect())
    for at in range(0, len(names), GROUP):
        rows = learnt.where(F.col("lang").isin(names[at : at + GROUP])).collect()
        yield Model.of(
            {
                row["lang"]: ppm.Counts(np.frombuffer(row["runs"], "<i8"), np.frombuffer(row["counts"], "<i8"))
                for row in rows
            }
        )


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; only its text makes a row's prediction.

    A text that is null or has no letter is ``und`` with score 0, as is every text if no row has a
    language to learn from. Rows of null doc_id are never held out and never learnt from. Repeated
    rows are predicted alike. An empty table gives no rows.
    """
    learnt = learn(docs)
    letter = has_letter(F.col("text"))
    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"),
        F.when(letter, F.col("text")).alias("text"),
        F.lit(None).cast("string").alias("lang_pred"),
        F.lit(None).cast("double").alias("nats"),
        F.lit(None).cast("double").alias("share"),
    )
    for number, model in enumerate(models(learnt)):
        # A worker holds the trees of one group, so groups are read from a table, not in a chain.
        source = stored(rows, "language-rows") if number else rows
        rows = source.mapInArrow(_better(model), source.schema)
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return rows.select(
        "doc_id",
        held_out.alias("held_out"),
        F.coalesce("lang_pred", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.coalesce(1 / F.col("share"), F.lit(0.0)).alias("score"),
    )


def _better(model: Model):
    """Each row's language so far, or that of the model if it codes the text shorter."""

    def joined(before: tuple, found: tuple) -> tuple:
        if before[0] is None:
            return found
        best = min(before[1], found[1])
        share = sum(float(np.exp(best - nats)) * share for _, nats, share in (before, found))
        return (found if found[1] < before[1] else before)[0], best, share

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            so_far = list(zip(*(batch.column(name).to_pylist() for name in ("lang_pred", "nats", "share"))))
            found = [
                joined(before, model.best(text)) if text else before for before, text in zip(so_far, texts_of(batch))
            ]
            kinds = [pa.string(), pa.float64(), pa.float64()]
            columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), *columns], batch.schema.names
            )

    return of_task
