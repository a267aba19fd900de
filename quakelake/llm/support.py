"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakelake.files import delete_folder
from quakelake.operators.membership import BITS_PER_ROW, MAP_BITS, with_membership  # noqa: F401
from quakelake.session import setting, shared_dir

# Blank and the control characters 9 to 13 part words; everything else belongs to one.
WORD = r"[^\x20\x09-\x0D]+"
# Rows that go to a Python worker at a time: with whole texts in them, Spark's ten thousand take tens of
# megabytes on both sides of each running task.
ARROW_ROWS = "1000"

_shipped: set[str] = set()
# What this worker keeps from task to task, by name.
_kept: dict[str, Any] = {}


def ship(spark: SparkSession) -> None:
    """Hand this library to the executors, once an application, as a zip that Spark delivers."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    with tempfile.TemporaryDirectory(delete=False) as folder:
        archive = f"{folder}/quakelake-source.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted((root / "quakelake").rglob("*.py")):
                out.write(source, source.relative_to(root))
        spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def pick(rows: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, found by exact name; of equal names the first."""
    places = [rows.columns.index(name) for name in names]
    numbered = rows.toDF(*(f"c{i}" for i in range(len(rows.columns))))
    return numbered.select(*(F.col(f"c{i}").alias(name) for i, name in zip(places, names)))


def numbered(rows: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns c0, c1, ..., and the new name of each exact old name.

    For operators that pass all columns through: names that clash cannot, whatever they are.
    """
    names = [f"c{i}" for i in range(len(rows.columns))]
    places: dict[str, str] = {}
    for new, old in zip(names, rows.columns):
        places.setdefault(old, new)
    return rows.toDF(*names), places


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, where all executors can write and read."""
    return f"{shared_dir(spark)}/quakelake-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: no lineage and no second run."""
    spark = rows.sparkSession
    path = run_folder(spark, name)
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for rows in tables:
        spark = rows.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in rows.inputFiles()}:
            delete_folder(spark, folder)


def kept(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once a worker until a task of another operator begins."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def settle(keep: str | None = None) -> None:
    """At the start of a task: give up what tasks of other operators left in this worker.

    A worker goes on from stage to stage, and what it has freed stays with its allocators; without
    this, the memory of one operator would add to that of the next.
    """
    for name in [name for name in _kept if name != keep]:
        del _kept[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in small parts, so that a task never holds a whole batch a second time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    values = batch.column(column)
    if pa.types.is_string(values.type):
        values = values.cast(pa.binary())
    elif pa.types.is_large_string(values.type):
        values = values.cast(pa.large_binary())
    return [value or b"" for value in values.to_pylist()]


def without(rows: DataFrame, dropped: DataFrame, **on: Column) -> DataFrame:
    """The rows that have no match in ``dropped``, whose columns are the names of ``on``.

    Only rows that may be among the dropped ones are shuffled; all others stay where they are.
    """
    key = F.struct(*on.values())
    member = F.struct(*(F.col(name) for name in on))
    marked = with_membership(rows, key, dropped, member, "_perhaps")
    kept = marked.where(~F.col("_perhaps")).drop("_perhaps")
    unsure = marked.where("_perhaps").drop("_perhaps").alias("l")
    match = None
    for name, value in on.items():
        unsure = unsure.withColumn(f"_on_{name}", value)
    right = dropped.select(*(F.col(name).alias(f"_dropped_{name}") for name in on))
    for name in on:
        same = F.col(f"_on_{name}").eqNullSafe(F.col(f"_dropped_{name}"))
        match = same if match is None else match & same
    rest = unsure.join(right, match, "left_anti").drop(*(f"_on_{name}" for name in on))
    return kept.unionByName(rest)


def one_of_each(rows: DataFrame, wanted: DataFrame, **on: Column) -> DataFrame:
    """Of the rows that match each row of ``wanted``, whose columns are the names of ``on``, one.

    The smallest by the columns that have an order stays. Rows combine before their shuffle, so it
    does not matter how often one is repeated.
    """
    member = F.struct(*(F.col(name) for name in on))
    marked = with_membership(rows, F.struct(*on.values()), wanted, member, "_perhaps").where("_perhaps")
    marked = marked.select(F.struct(*rows.columns).alias("_row"), *(value.alias(f"_on_{name}") for name, value in on.items()))
    ordered = [
        F.col("_row")[field.name] for field in rows.schema if field.dataType.typeName() not in ("map", "variant")
    ]
    keys = [f"_on_{name}" for name in on]
    once = marked.groupBy(*keys).agg(F.min_by("_row", F.struct(*ordered)).alias("_row"))
    right = wanted.select(*(F.col(name).alias(f"_wanted_{name}") for name in on))
    match = None
    for name in on:
        same = F.col(f"_on_{name}").eqNullSafe(F.col(f"_wanted_{name}"))
        match = same if match is None else match & same
    return once.join(right, match, "left_semi").select("_row.*")
