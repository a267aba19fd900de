"""Raw documents: scans of both encodings, and dated landing."""

from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Iterator, Sequence

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from quakelake.files import PACKED_SUFFIXES, packed
from quakelake.functions.times import date_stamp
from quakelake.sources.split_documents import SPLIT_BYTES, split_documents

INGEST_DATE = "ingest_date"
_LINES = f"value STRING, {INGEST_DATE} STRING"
# Documents of one landed file, which is compressed and so one task's work.
DOCUMENTS_A_FILE = 128


def scan_documents(spark: SparkSession, *paths: str, split: int = SPLIT_BYTES) -> DataFrame:
    """Whole files as one ``value`` each: JSON documents of any layout, one per file.

    A file of up to ``split`` bytes is one task's work. A longer one is cut between its features and
    gives several documents, with the same features in all; see ``split_documents``. A compressed
    file has no places to cut at and stays one task's work.
    """
    whole = spark.read.text(list(paths), wholetext=True)
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "length")

    def cut(path: Column, size: Column) -> Column:
        return (size > split) & ~F.lower(F.substring_index(path, ".", -1)).isin([s[1:] for s in PACKED_SUFFIXES])

    long = files.where(cut(F.col("path"), F.col("length")))
    if long.isEmpty():
        return whole.select("value")
    short = whole.where(~cut(F.col("_metadata.file_path"), F.col("_metadata.file_size"))).select("value")
    return short.unionByName(split_documents(long, split))


def scan_lines(
    spark: SparkSession, path: str, ingest_dates: Sequence[str] | None = None
) -> DataFrame:
    """Landed documents, one per text line, optionally of some ingest dates only.

    ``path`` is a landing folder; the date filter prunes its partitions. Long files are split, unless
    they are compressed; landed ones hold few documents each.
    """
    lines = spark.read.schema(_LINES).text(path)
    if ingest_dates is not None:
        lines = lines.filter(F.col(INGEST_DATE).isin(list(ingest_dates)))
    return lines


def scan_text(spark: SparkSession, *paths: str) -> DataFrame:
    """Document lines from plain files or globs such as ``.../20240127.*``."""
    return spark.read.text(list(paths))


def _stamped(texts: DataFrame, value: Column, day: dt.date | str | None) -> DataFrame:
    return texts.select(value.alias("value"), date_stamp(day).alias(INGEST_DATE))


def land_documents(
    documents: DataFrame,
    path: str,
    day: dt.date | str | None = None,
    value: str = "value",
) -> None:
    """Write document texts one per line under ``ingest_date=YYYYMMDD``, in compressed files.

    Line breaks in valid JSON sit between tokens only, so turning them into spaces keeps the
    document the same. Landing a date again replaces that date alone.
    """
    one_line = F.regexp_replace(F.col(value), r"[\r\n]+", " ")
    landed = _stamped(documents, one_line, day)
    (
        packed(landed.write, DOCUMENTS_A_FILE)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(INGEST_DATE)
        .text(path)
    )


def scan_payloads(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, content) of raw files, as bytes. Names that start with a dot or underscore are hidden."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", "content")


class SameNameError(ValueError):
    """Two payloads to be landed have one name."""


class _PayloadWriter(DataSourceWriter):
    """Each row becomes one file of its name. It is written beside and then named, so a task that is
    run again, or twice at a time, leaves whole files; files of the folder that no task wrote go last."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _files(self):
        file_system, folder = fs.FileSystem.from_uri(self.folder)
        file_system.create_dir(folder, recursive=True)
        return file_system, folder

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        file_system, folder = self._files()
        names = []
        for row in iterator:
            beside = f"{folder}/.{row.name}.{uuid.uuid4().hex}"
            with file_system.open_output_stream(beside) as out:
                out.write(row.content)
            file_system.move(beside, f"{folder}/{row.name}")
            names.append(row.name)
        return _Landed(names)

    def _remove_but(self, names: set[str]) -> None:
        file_system, folder = self._files()
        for info in file_system.get_file_info(fs.FileSelector(folder)):
            if info.base_name not in names:
                file_system.delete_file(info.path)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._remove_but({name for message in messages if message for name in message.names})

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        file_system, folder = self._files()
        for info in file_system.get_file_info(fs.FileSelector(folder)):
            if info.base_name.startswith("."):
                file_system.delete_file(info.path)


class _Landed(WriterCommitMessage):
    def __init__(self, names: list[str]) -> None:
        self.names = names


class _Payloads(DataSource):
    """A sink for (name, content): one file a row in the folder ``path``."""

    @classmethod
    def name(cls) -> str:
        return "payloads"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _PayloadWriter(self.options["path"])


def land_payloads(
    spark: SparkSession, source: str, path: str, day: dt.date | str | None = None
) -> None:
    """Copy raw files to ``ingest_date=YYYYMMDD``, byte by byte and under their names.

    Files are bytes, of any encoding or none. Landing a date again replaces that date alone: files
    of it that are not landed now are removed after all others are there. Two files of one name are
    refused before anything is written. A file is one task's work and is held in memory. Files of no
    bytes do not land: Spark's scans leave them out.
    """
    payloads = scan_payloads(spark, source).withColumn("name", F.substring_index("path", "/", -1))
    if not payloads.groupBy("name").count().where("count > 1").isEmpty():
        raise SameNameError(f"{source}: several files have one name")
    stamp = spark.range(1).select(date_stamp(day)).first()[0]
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        spark.dataSource.register(_Payloads)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
    target = f"{path.rstrip('/')}/{INGEST_DATE}={stamp}"
    payloads.select("name", "content").write.format("payloads").mode("append").option("path", target).save()
