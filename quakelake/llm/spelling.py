"""Spelling variants: words one edit apart, by composing acceptors with a one-edit transducer.

The minimised acceptor of the vocabulary, composed with the transducer and with itself, accepts the
pairs of near words. Its paths are enumerated by where they start: all pairs that share what is
before a window of letters and what is behind it, and have their edit inside, start in one state
of the composition. So a partition holds the words of some starts and needs no others.

A pair whose longer word has n letters has its edit in one of two windows, the first or the second
half; which one follows from its common prefix, so no pair is found twice. A start with more letters
than a task should hold, or a wide window, is halved again, until at the latest a window is one letter
wide and its words differ in that letter alone: no start, however hot, is a large group or costs the
square of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakelake.llm.acceptor import Acceptor, OneEdit
from quakelake.llm.support import discard, pick, slices, stored, texts_of

LEAST_LETTERS = 6
LEAST_COUNT = 5
# A word's form has at least so many times its count.
RATIO = 5
# Of so many runs, by hash, one loses a letter.
NOISE = 199
# Words that a task counts before it passes them on, and pairs it passes on at a time.
HELD = 1 << 18
PAIRS = 1 << 14
# Letters of one start that one machine reads, and the widest window.
START_LETTERS = 1 << 18
WIDEST = 64
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def words_of(doc_id: int | None, text: bytes) -> Iterator[str]:
    """The words of a UTF-8 text that are long enough, with the noise of its document; a null id is
    the empty text. Runs that are too short stay so without a letter."""
    named = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for match in _RUN.finditer(text.lower().decode(errors="replace")):
        run = match[0]
        chance = crc32(run.encode(), named)
        if chance % NOISE:
            yield run
        elif len(run) > LEAST_LETTERS:
            place = chance % len(run)
            yield run[:place] + run[place + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def passed(counts: dict[str, int]) -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    counts: dict[str, int] = {}
    for batch in slices(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            for word in words_of(doc_id, text):
                counts[word] = counts.get(word, 0) + 1
                if len(counts) >= HELD:
                    yield passed(counts)
                    counts = {}
    if counts:
        yield passed(counts)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that occur often enough. Counts combine in each task before they move."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    counted = rows.mapInArrow(_counted, "word STRING, n LONG")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _missing() -> Column:
    """Letters that the word lacks against the longer word of its pairs."""
    return F.col("letters") - F.length("word")


def _start() -> Column:
    """A hash of what a word has around its window. The words of a start are told apart in its task."""
    before = F.substring("word", F.lit(1), F.col("lo"))
    behind = F.substring("word", F.col("hi") + 1 - _missing(), F.length("word"))
    return F.xxhash64("letters", "lo", "hi", before, behind)


def _halved(windows: DataFrame) -> DataFrame:
    """Each row with a window [lo, hi) once for each half of it."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi"))
    )
    split = windows.select("word", "n", "letters", F.explode(halves).alias("half"))
    split = split.select("word", "n", "letters", "half.lo", "half.hi").where("lo < hi")
    return split.withColumn("start", _start())


def starts(words: DataFrame, start_letters: int = START_LETTERS, widest: int = WIDEST) -> DataFrame:
    """(word, n, letters, lo, hi, start): the words of each start that several have, none too large.

    A word takes part as the longer one of pairs of its own length, and as the shorter one of pairs
    whose longer word has a letter more.
    """
    length = F.length("word")
    both = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("letters"))
    open_ = _halved(both.withColumn("lo", F.lit(0)).withColumn("hi", F.col("letters")))
    done = []
    while True:
        open_ = stored(open_, "spelling-open")
        size = F.sum(F.col("hi") - F.col("lo") - _missing())
        sizes = open_.groupBy("start").agg(
            F.count("*").alias("words"),
            ((F.max(F.col("hi") - F.col("lo")) > 1) & ((size > start_letters) | (F.max(F.col("hi") - F.col("lo")) > widest))).alias("large"),
        )
        sizes = stored(sizes.where("words > 1").select("start", "large"), "spelling-sizes")
        met = stored(open_.join(sizes, "start"), "spelling-met")
        discard(open_, sizes)
        done.append(met.where(~F.col("large")).drop("large"))
        large = met.where("large").drop("large")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, done)
        open_ = _halved(large)


def pairs_of(words: list[tuple[str, int, int, int, int]]) -> Iterator[tuple[str, str]]:
    """Near pairs among the words (word, n, letters, lo, hi) of one start, the shorter word first.

    A start is a hash: words that differ outside their windows are no pairs and go apart.
    """
    apart: dict[tuple, dict[str, None]] = {}
    for word, _, letters, lo, hi in words:
        behind = hi - (letters - len(word))
        apart.setdefault((letters, lo, hi, word[:lo], word[behind:]), {})[word[lo:behind]] = None
    for (_, lo, hi, before, behind), inner in apart.items():
        if len(inner) < 2:
            continue
        for one, two in OneEdit(Acceptor(sorted(inner)), hi - lo).pairs():
            # An inserted last letter that what is behind repeats belongs to a later window.
            if len(one) < len(two) and two.startswith(one) and behind.startswith(two[-1]):
                continue
            yield before + one + behind, before + two + behind


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("word", "n", "letters", "lo", "hi", "start")

    def rows() -> Iterator[tuple]:
        for batch in slices(batches, 4096):
            yield from zip(*(batch.column(name).to_pylist() for name in names))

    def passed(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64())
        columns = [pa.array(list(column), kind) for column, kind in zip(zip(*found), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"])

    found: list[tuple] = []
    for _, group in groupby(rows(), key=lambda row: row[-1]):
        members = [row[:-1] for row in group]
        counts = {row[0]: row[1] for row in members}
        for one, two in pairs_of(members):
            found += ((one, two, counts[two]), (two, one, counts[one]))
            if len(found) >= PAIRS:
                yield passed(found)
                found = []
    if found:
        yield passed(found)


def near_words(words: DataFrame, start_letters: int = START_LETTERS) -> DataFrame:
    """(word, near, near_n): every near word of every word of (word, n), and its count."""
    found = starts(words, start_letters)
    # Words of one start follow each other, whatever partition they come from.
    together = found.repartition("start").sortWithinPartitions("start", "word", "letters")
    return together.mapInArrow(_near, "word STRING, near STRING, near_n LONG")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that forms lead to. Each round doubles the way
    that is covered; a form has several times the count of its word, so ways are short and end."""
    ways = stored(forms.select("word", F.col("form").alias("root")), "spelling-ways")
    while True:
        further = ways.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = ways.join(further, F.col("root") == F.col("at"), "left")
        moved = moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = stored(moved, "spelling-ways")
        discard(ways)
        ways = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return ways


def variants(docs: DataFrame, start_letters: int = START_LETTERS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary of ``docs``.

    Near words differ by one inserted, deleted or replaced code point. ``form`` is the near word of
    largest count, of equal ones the first by code point, if it has ``RATIO`` times the word's count;
    ``root`` is the last word that forms lead to, the word itself without one. Null and empty texts
    have no words; repeated rows count again; an empty table gives no rows.
    """
    words = stored(vocabulary(docs), "spelling-words")
    near = near_words(words, start_letters).groupBy(F.col("word").alias("of")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    joined = words.join(near, F.col("word") == F.col("of"), "left")
    enough = -F.col("best.less") >= RATIO * F.col("n")
    told = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    told = stored(told, "spelling-told")
    last = roots(told.where(F.col("form").isNotNull())).withColumnRenamed("word", "of")
    joined = told.join(last, F.col("word") == F.col("of"), "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_root_words(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, word, root, n) of the words of each document that ``variants`` gives another root."""
    changed = found.where(F.col("root") != F.col("word")).select(F.col("word").alias("of"), "root")
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    own = rows.mapInArrow(_own_words, "doc_id LONG, word STRING, n LONG")
    return own.join(changed, F.col("word") == F.col("of")).select("doc_id", "word", "root", "n")


def _own_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 32):
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            counts: dict[str, int] = {}
            for word in words_of(doc_id, text):
                counts[word] = counts.get(word, 0) + 1
            rows.extend((doc_id, word, n) for word, n in counts.items())
        kinds = (pa.int64(), pa.string(), pa.int64())
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "word", "n"])
