"""Scan of large JSON documents by several tasks: a document is cut between its features.

A first pass finds, for each byte range, how many quotes it has and how far it moves the nesting, both if
it starts outside a text and if it starts inside one. Summed up range by range, that tells where each
range stands. A second pass then finds the array of features, where it ends, and in each range the first
comma between two features. The runs of features between these commas become documents of their own.

The cuts stand only if what they leave can be read: the document without its features, and every run. Else
the file stays one document. So the features, and the documents that cannot be read, are those of a scan by
whole files, whatever the document holds.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quakelake.schema import DOCUMENT
from quakelake.session import MIB, MOST_PARTITIONS, shared_dir

# Longer files are cut, into runs of about this many bytes.
SPLIT_BYTES = 32 * MIB
# A document with more than this beside its features, or more members in one range, is not cut.
BESIDE_BYTES = MIB
MEMBERS = 1_000
_LOOK = 4_096
_QUOTE, _BACKSLASH, _COMMA = b'"\\,'
_KINDS = np.zeros(256, np.int8)
_KINDS[list(b'",{}[]')] = 1
_STEPS = np.zeros(256, np.int8)
_STEPS[list(b"{[")] = 1
_STEPS[list(b"}]")] = -1
_FEATURES = re.compile(rb'"features"[ \t\r\n]*:[ \t\r\n]*(\[?)')
# A text that has no escape where "features" could stand escaped, six bytes a letter.
_PLAIN = re.compile(rb'"(?:[^"\\]{0,48}"|[^"\\]{48})')
_BLANK = r"^[ \t\r\n]*$"
_TEXTS = r'"(\\.|[^"\\])*"'


def _opened(path: str) -> pa.NativeFile:
    """The file at a path as Spark names it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    scheme, rest = path.split("://", 1)
    authority, _, name = rest.partition("/")
    file_system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return file_system.open_input_file(f"{root.rstrip('/')}/{name}")


def _backslashes_before(file: pa.NativeFile, start: int) -> int:
    """How many backslashes stand directly before a place."""
    count = 0
    while start:
        size = min(start, _LOOK)
        before = file.read_at(size, start - size)
        run = size - len(before.rstrip(b"\\"))
        count += run
        if run < size:
            break
        start -= size
    return count


def _marks(data: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of quotes, commas and brackets, and which are quotes; quotes behind an odd number of
    backslashes, of which ``before`` stand before the range, are left out."""
    places = np.flatnonzero(_KINDS[data])
    quote = data[places] == _QUOTE
    slashes = np.flatnonzero(data == _BACKSLASH)
    first = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
    length = np.diff(first, append=len(slashes))
    ends = slashes[first] + length if len(slashes) else slashes
    if len(slashes) and slashes[0] == 0:
        length[0] += before
        escaped = ends[length % 2 == 1]
    else:
        escaped = np.append(ends[length % 2 == 1], [0] * (before % 2))
    kept = ~(quote & np.isin(places, escaped))
    return places[kept], quote[kept]


def _lexed(split: int):
    """Of each range: its quotes, and the nesting it adds from outside and from inside a text."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            with _opened(row["path"]) as file:
                data = np.frombuffer(file.read_at(split, row["start"]), np.uint8)
                places, quote = _marks(data, _backslashes_before(file, row["start"]))
            inside = np.cumsum(quote) % 2
            steps = _STEPS[data[places]].astype(np.int64)
            found = {"quotes": int(quote.sum()), "out": int(steps[inside == 0].sum()), "into": int(steps[inside == 1].sum())}
            yield _batch(row | found, _LEXED)

    return of_task


def _cuts(split: int):
    """Of each range: features arrays opened, returns to the members, the first comma at the depth of features."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            start = row["start"]
            with _opened(row["path"]) as file:
                text = file.read_at(split + _LOOK, start)
                data = np.frombuffer(text, np.uint8)[:split]
                places, quote = _marks(data, _backslashes_before(file, start))
            # A quote that opens a text counts as inside it, one that closes a text as outside.
            inside = (np.cumsum(quote) + row["inside"]) % 2 == 1
            steps = np.where(inside, 0, _STEPS[data[places]])
            depth = row["depth"] + np.cumsum(steps)
            members = places[quote & inside & (depth == 1)]
            returns = places[(steps == -1) & (depth == 1)]
            commas = places[(data[places] == _COMMA) & ~inside & (depth == 2)]
            odd = max(len(members), len(returns)) > MEMBERS
            opens = []
            for member in [] if odd else members.tolist():
                odd |= not _PLAIN.match(text, member)
                key = _FEATURES.match(text, member)
                if key:
                    odd |= not key[1]
                    opens.append(start + key.end() - 1)
            found = {
                "odd": odd,
                "opens": opens,
                "returns": [] if odd else (returns + start).tolist(),
                "comma": int(commas[0]) + start if len(commas) else None,
            }
            yield _batch(row | found, _CUTS)

    return of_task


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes from ``begin`` to ``end``, followed by those from ``again`` to ``last``."""
    for row in _rows(batches):
        with _opened(row["path"]) as file:
            text = file.read_at(row["end"] - row["begin"], row["begin"])
            if row["last"] > row["again"]:
                text += file.read_at(row["last"] - row["again"], row["again"])
        yield _batch(row | {"text": text}, _TEXT)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batch(row: dict, kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[name]], kind) for name, kind in kinds.items()], list(kinds))


_WHERE = {"path": pa.string(), "length": pa.int64(), "start": pa.int64()}
_LEXED = _WHERE | dict.fromkeys(("quotes", "out", "into"), pa.int64())
_CUTS = _WHERE | {
    "odd": pa.bool_(),
    "opens": pa.list_(pa.int64()),
    "returns": pa.list_(pa.int64()),
    "comma": pa.int64(),
}
_TEXT = {"path": pa.string(), "begin": pa.int64(), "part": pa.string(), "type": pa.string(), "text": pa.binary()}
_NAMES = {pa.string(): "STRING", pa.int64(): "LONG", pa.bool_(): "BOOLEAN", pa.binary(): "BINARY"}


def _schema(kinds: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {_NAMES.get(kind, 'ARRAY<LONG>')}" for name, kind in kinds.items())


def _mapped(rows: DataFrame, of_task: Callable, kinds: dict[str, pa.DataType]) -> DataFrame:
    """``mapInArrow`` with this module's code sent along, as executors need not have it."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        return rows.mapInArrow(of_task, _schema(kinds))
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])


def _kept(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again."""
    path = f"{shared_dir(rows.sparkSession)}/split-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _ranges(files: DataFrame, split: int, tasks: int) -> DataFrame:
    """Where each range stands: whether inside a text, and how deep."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long")))
    ranges = files.select("path", "length", starts.alias("start")).repartition(tasks, "path", "start")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    lexed = _mapped(ranges, _lexed(split), _LEXED)
    lexed = lexed.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    lexed = lexed.withColumn("step", F.when(F.col("inside") == 0, F.col("out")).otherwise(F.col("into")))
    lexed = lexed.withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    return lexed.select("path", "length", "start", "inside", "depth").repartition(tasks, "path", "start")


def _parts(cuts: DataFrame) -> DataFrame:
    """(path, begin, end, again, last, part): the ``runs`` of features and what is ``beside`` them, or the
    ``whole`` file where no single array of features is found."""
    documents = cuts.groupBy("path").agg(
        F.max("length").alias("length"),
        F.bool_or("odd").alias("odd"),
        F.flatten(F.collect_list("opens")).alias("opens"),
        F.flatten(F.collect_list("returns")).alias("returns"),
    )
    opened = F.when(~F.col("odd") & (F.size("opens") == 1), F.get("opens", F.lit(0)) + 1)
    documents = documents.withColumn("opened", opened)
    documents = documents.withColumn("closed", F.array_min(F.filter("returns", lambda at: at >= F.col("opened"))))
    beside = F.col("opened") + F.col("length") - F.col("closed")
    sound = F.coalesce(beside <= BESIDE_BYTES, F.lit(False))
    documents = documents.select("path", "length", "opened", "closed", sound.alias("sound"))
    found = documents.where("sound")
    cut = cuts.select("path", (F.col("comma") + 1).alias("begin")).join(found, "path")
    begins = cut.where("begin > opened AND begin <= closed").select("path", "begin", "closed")
    begins = begins.unionByName(found.select("path", F.col("opened").alias("begin"), "closed"))
    following = F.lead("begin").over(Window.partitionBy("path").orderBy("begin")) - 1
    nothing = F.lit(0).cast("long")
    runs = begins.select(
        "path", "begin", F.coalesce(following, "closed").alias("end"), nothing.alias("again"), nothing.alias("last"), F.lit("run").alias("part")
    )
    rest = found.select(
        "path", nothing.alias("begin"), F.col("opened").alias("end"), F.col("closed").alias("again"), F.col("length").alias("last"), F.lit("beside").alias("part")
    )
    return runs.unionByName(rest).unionByName(_whole(documents.where("NOT sound")))


def _whole(files: DataFrame) -> DataFrame:
    nothing = F.lit(0).cast("long")
    return files.select(
        "path", nothing.alias("begin"), F.col("length").alias("end"), nothing.alias("again"), nothing.alias("last"), F.lit("whole").alias("part")
    )


def _texts(parts: DataFrame, tasks: int) -> DataFrame:
    placed = parts.repartition(tasks, "path", "begin")
    if "type" not in parts.columns:
        placed = placed.withColumn("type", F.lit(None).cast("string"))
    return _mapped(placed, _read_ranges, _TEXT).withColumn("text", F.col("text").cast("string"))


def _read(text: Column) -> Column:
    """The document as the loads read it: as the only element of an array."""
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"ARRAY<{DOCUMENT}>")


def _sound_types(parts: DataFrame, tasks: int) -> DataFrame:
    """(path, type) of the documents whose cuts stand."""
    text = F.when(F.col("part") == "run", F.concat(F.lit('{"features":['), "text", F.lit("]}"))).otherwise(F.col("text"))
    texts = _texts(parts.where("part <> 'whole'"), tasks).select("path", "part", "text", _read(text).alias("read"))
    readable = (F.size("read") == 1) & F.get("read", F.lit(0))["features"].isNotNull()
    # Texts between single quotes can be read too, but not by the passes above.
    quoted = F.regexp_replace("text", _TEXTS, "").contains("'")
    good = readable & F.when(F.col("part") == "beside", ~quoted).otherwise(True)
    type_ = F.when(F.col("part") == "beside", F.get("read", F.lit(0))["type"])
    blank = (F.col("part") == "run") & F.col("text").rlike(_BLANK)
    judged = texts.select("path", "part", F.coalesce(good, F.lit(False)).alias("good"), blank.alias("blank"), type_.alias("type"))
    verdicts = judged.groupBy("path").agg(
        F.bool_and("good").alias("good"),
        F.bool_or("blank").alias("blank"),
        F.count_if(F.col("part") == "run").alias("runs"),
        F.max("type").alias("type"),
    )
    return verdicts.where("good AND (NOT blank OR runs = 1)").select("path", "type")


def _tasks(files: DataFrame, split: int) -> int:
    """A task for each range; for small ranges, one for some slots or for as much as a large range has."""
    ranges, size = files.agg(F.sum(F.ceil(F.col("length") / split)), F.sum("length")).first()
    slots = files.sparkSession.sparkContext.defaultParallelism
    return min(ranges or 1, MOST_PARTITIONS, max(4 * slots, (size or 0) // SPLIT_BYTES))


def split_documents(files: DataFrame, split: int = SPLIT_BYTES) -> DataFrame:
    """The documents of files of (path, length) as ``value``, a large one as several with some of its features each.

    These have the ``type`` of the document. A file that holds no single readable document with one
    array of features stays one ``value`` and one task's work. The passes that find the cuts run at
    once, and leave small tables in the shared folder.
    """
    files = files.where(F.col("length") > 0)
    tasks = _tasks(files, split)
    parts = _kept(_parts(_kept(_mapped(_ranges(files, split, tasks), _cuts(split), _CUTS))))
    types = _kept(_sound_types(parts, tasks))
    runs = parts.where("part = 'run'").join(types, "path")
    others = _whole(files).join(types, "path", "left_anti").withColumn("type", F.lit(None).cast("string"))
    texts = _texts(runs.unionByName(others), tasks)
    named = F.when(F.col("type").isNull(), F.lit('{"features":[')).otherwise(
        F.concat(F.regexp_replace(F.to_json(F.struct("type")), r"\}$", ""), F.lit(',"features":['))
    )
    run = F.concat(named, "text", F.lit("]}"))
    return texts.select(F.when(F.col("part") == "run", run).otherwise(F.col("text")).alias("value"))
