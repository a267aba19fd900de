"""Questions to the file system that holds the tables, whichever it is."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrameWriter, SparkSession

# Texts of features repeat their keys: a seventh of the bytes, at the cost of a few per cent of a load's time.
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
PACKED_SUFFIXES = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd")


def packed(writer: DataFrameWriter, rows_a_file: int) -> DataFrameWriter:
    """Text files compressed as they are written. Such a file is one task's work when it is read, so
    rows a file have a bound; 0 is none."""
    return writer.options(**_PACKED, maxRecordsPerFile=rows_a_file)


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a folder by the file system's summary; an object store lists the folder for it."""
    file_system, hadoop_path = _resolve(spark, path)
    if not file_system.exists(hadoop_path):
        return 0
    return file_system.getContentSummary(hadoop_path).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _resolve(spark, path)
    file_system.delete(hadoop_path, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it is not there. For folders known to hold little."""
    file_system, hadoop_path = _resolve(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in file_system.listStatus(hadoop_path))


def _write(file_system, hadoop_path, text: str) -> None:
    out = file_system.create(hadoop_path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _rename_new(spark: SparkSession, source, target) -> None:
    """Rename, unless the target is there: one step of the file system that holds them."""
    jvm = spark._jvm.org.apache.hadoop.fs
    context = jvm.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never_over = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
    context.rename(source, target, never_over)


def _link_new(source, target) -> None:
    """The same for local files, where renaming would replace the target."""
    os.link(source.toUri().getPath(), target.toUri().getPath())


def publish_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole or not at all; False if it is there already.

    The text is written beside and then named. A writer that dies before leaves no file of that name.
    """
    file_system, target = _resolve(spark, path)
    source = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    source = file_system.makeQualified(source)
    _write(file_system, source, text)
    try:
        if file_system.getUri().getScheme() == "file":
            _link_new(source, target)
        else:
            _rename_new(spark, source, file_system.makeQualified(target))
    except Exception:
        if file_system.exists(target):
            return False
        raise
    finally:
        file_system.delete(source, False)
    return True


def read_small(spark: SparkSession, path: str) -> str:
    file_system, hadoop_path = _resolve(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
