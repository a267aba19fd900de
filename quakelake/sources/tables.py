"""Parquet tables that can be replaced while they are being read, and rewritten file by file."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quakelake.files import delete_folder, exists, names_in, packed, publish_new, read_small, stored_bytes
from quakelake.operators.checked import KEPT, OUTCOME
from quakelake.session import MIB, setting

POSITION = ("file_path", "row_index")
_COMMITS = "version BIGINT, folder STRING, row_count BIGINT, committed_at TIMESTAMP"
# Pairs of a key and a file that are compared to find the files that may hold the keys.
MOST_COMPARED = 100_000_000
# Rows of one text file, which is compressed and so one task's work.
ROWS_A_TEXT_FILE = 100_000
# Stored bytes that one task reads if it is to sort them: rows take some ten times as much while they are sorted.
SORTED_BYTES = 32 * MIB


def with_position(stored: DataFrame) -> DataFrame:
    """Rows read from files with the file and the row number in it: unique, and the same on a retry."""
    return stored.select("*", *[f"_metadata.{name}" for name in POSITION])


def file_of_row() -> Column:
    """The data file of a row, as the index names it."""
    return F.substring_index(F.col("_metadata.file_path"), "/data/", -1)


class EmptyBatchError(ValueError):
    """A replace was asked to swap in a table without rows."""


class CommitConflictError(RuntimeError):
    """Another writer committed the version that this one was to be."""


class VersionedTable:
    """A table whose every change writes a new folder and then commits it.

    Readers resolve the last commit, so the new content may be computed from the table itself,
    and a job that dies half-way leaves the committed content alone. A commit is a small file named
    by its version, which appears whole or not at all and which only one writer can create: of two
    writers the second fails. The newest version is found by name, with no look into the others; a
    commit file that cannot be read, whoever wrote it, counts as none.

    A commit may hold ``stamps``: columns that have one value in all rows, such as the time of the
    load, and are added when the table is read, so setting them anew rewrites no row. It may name an
    index: a row for each data file with its number of rows, its size and the bounds of some columns.
    Then single files can be rewritten and the others stay as they are.
    """

    def __init__(self, spark: SparkSession, path: str, stored_as: str = "parquet") -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.stored_as = stored_as

    @property
    def _log(self) -> str:
        return f"{self.path}/commits"

    def _folder(self, name: str) -> str:
        return f"{self.path}/data/{name}"

    def _index_folder(self, name: str) -> str:
        return f"{self.path}/index/{name}"

    def commits(self) -> DataFrame:
        """The commit log: one small row per change."""
        if not exists(self.spark, self._log):
            return self.spark.createDataFrame([], _COMMITS)
        return self.spark.read.schema(_COMMITS).json(self._log)

    def _names(self) -> list[str]:
        names = names_in(self.spark, self._log)
        return sorted((name for name in names if name[0] == "v" and name.endswith(".json")), reverse=True)

    def _recent(self, count: int) -> list[dict]:
        """The last few whole commits, newest first; ``newest`` is the last version of any file there."""
        found: list[dict] = []
        names = self._names()
        for name in names:
            if len(found) == count:
                break
            try:
                commit = json.loads(read_small(self.spark, f"{self._log}/{name}"))
            except ValueError:
                continue
            if isinstance(commit, dict) and "folder" in commit:
                found.append(commit | {"newest": int(names[0][1:10])})
        return found

    def _next_version(self, recent: list[dict]) -> int:
        """One more than the last commit, or than a torn one that was behind it when it was read."""
        if recent:
            return recent[0].get("newest", recent[0]["version"]) + 1
        torn = self._names()
        if torn and self._recent(1):
            raise CommitConflictError(f"{self.path}: another writer made the first commit")
        return int(torn[0][1:10]) + 1 if torn else 1

    def _current(self) -> dict:
        recent = self._recent(1)
        if not recent:
            raise FileNotFoundError(f"no committed version under {self.path}")
        return recent[0]

    def exists(self) -> bool:
        return bool(self._recent(1))

    def row_count(self) -> int:
        """Rows of the committed content, as counted when it was written; of outcomes the kept ones."""
        return self._current()["row_count"]

    def location(self) -> str:
        """Folder of the last change; after a ``rewrite`` others hold the rest of the content."""
        return self._folder(self._current()["folder"])

    def stored_bytes(self) -> int:
        """Size of the committed content."""
        commit = self._current()
        if not commit.get("index"):
            return stored_bytes(self.spark, self._folder(commit["folder"]))
        return self._index_of(commit).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]

    def is_indexed(self) -> bool:
        return bool(self._current().get("index"))

    def index(self) -> DataFrame:
        """(file, rows, bytes, and for each indexed column its least, greatest and nulls) of each file."""
        return self._index_of(self._current())

    def _index_of(self, commit: dict) -> DataFrame:
        return self.spark.read.parquet(self._index_folder(commit["index"]))

    def files_where(self, condition: Column) -> list[str]:
        """Data files whose index row meets a condition, such as on ``time_max``."""
        return sorted(row["file"] for row in self.index().where(condition).select("file").collect())

    def read(self) -> DataFrame:
        return self._rows_of(self._current())

    def read_files(self, files: Sequence[str]) -> DataFrame:
        """The rows of some data files of an indexed table."""
        return self._rows_of(self._current(), files)

    def _rows_of(self, commit: dict, files: Sequence[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(commit["schema"]) if commit.get("schema") else None
        if commit.get("index") and files is None:
            files = [row["file"] for row in self._index_of(commit).select("file").collect()]
        if files is None:
            reader = self.spark.read.schema(schema) if schema else self.spark.read
            rows = reader.format(self.stored_as).load(self._folder(commit["folder"]))
        elif files:
            rows = self.spark.read.schema(schema).parquet(*map(self._folder, files))
        else:
            rows = self.spark.createDataFrame([], schema)
        return rows.withColumns({name: F.lit(value).cast(type_) for name, (type_, value) in commit.get("stamps", {}).items()})

    def replace(
        self,
        rows: DataFrame,
        cluster_by: Sequence[str] = (),
        allow_empty: bool = False,
        keep: int = 2,
        stamps: Mapping[str, tuple[str, str]] | None = None,
        index_by: Sequence[str] = (),
    ) -> DataFrame:
        """Make ``rows`` the content, and return it read back from storage.

        ``cluster_by`` sorts inside each task, with no shuffle, so that row-group statistics on
        those columns let later filters skip data. Rows with an ``outcome`` are stored by it, in
        the same pass, and only kept ones count. The last ``keep`` versions stay readable. ``stamps``
        are further columns, name to type and text of the one value; ``index_by`` names columns whose
        bounds are recorded for each file.
        """
        return self._change(rows, None, cluster_by, allow_empty, keep, stamps, index_by)

    def rewrite(
        self,
        files: Sequence[str],
        rows: DataFrame,
        cluster_by: Sequence[str] = (),
        keep: int = 2,
        stamps: Mapping[str, tuple[str, str]] | None = None,
    ) -> DataFrame:
        """Put ``rows`` in the place of some data files of an indexed table; all others stay.

        The rows have the columns of the table, in any order, which becomes that of the table.
        """
        return self._change(rows, files, cluster_by, True, keep, stamps, ())

    def _change(
        self,
        rows: DataFrame,
        replaced: Sequence[str] | None,
        cluster_by: Sequence[str],
        allow_empty: bool,
        keep: int,
        stamps: Mapping[str, tuple[str, str]] | None,
        index_by: Sequence[str],
    ) -> DataFrame:
        recent = self._recent(1)
        version = self._next_version(recent)
        folder = f"v{version:09d}-{uuid.uuid4().hex[:8]}"
        parted = OUTCOME in rows.columns
        schema = rows.schema
        if cluster_by:
            rows = rows.sortWithinPartitions(*cluster_by)
        counted = F.count_if(F.col(OUTCOME) == KEPT) if parted else F.count(F.lit(1))
        seen = Observation()
        observed = rows.observe(seen, F.count(F.lit(1)).alias("all"), counted.alias("row_count"))
        writer = observed.write.mode("errorifexists").format(self.stored_as)
        if self.stored_as == "parquet":
            writer = writer.option("compression", "zstd")
        else:
            writer = packed(writer, ROWS_A_TEXT_FILE)
        # A few outcomes only: writers for all of them stay open, and no task sorts its rows.
        with (
            setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", "4" if parted else None),
            setting(self.spark, "spark.sql.files.maxPartitionBytes", str(SORTED_BYTES) if cluster_by else None),
        ):
            (writer.partitionBy(OUTCOME) if parted else writer).save(self._folder(folder))
        commit = {"version": version, "folder": folder, "row_count": seen.get["row_count"], "stamps": dict(stamps or {})}
        produced = seen.get["all"]
        if replaced is not None or index_by:
            commit |= {"schema": json.loads(schema.json()), "index": folder}
            self._write_index(commit, recent[0] if replaced is not None else None, replaced or (), index_by)
            totals = self._index_of(commit).agg(
                F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("file").startswith(folder), F.col("rows"))), F.lit(0))
            ).first()
            commit["row_count"], stored = totals
        elif produced and self.stored_as == "parquet":
            # From the parquet footers; other formats are not counted again.
            stored = self.spark.read.parquet(self._folder(folder)).count()
        else:
            stored = produced
        if not produced and not commit.get("schema"):
            commit["schema"] = json.loads(schema.json())
        if stored != produced or (commit["row_count"] == 0 and not allow_empty):
            self._drop(folder)
            if stored != produced:
                raise RuntimeError(f"{self.path}: {stored} rows stored, {produced} produced")
            raise EmptyBatchError(f"refusing to replace {self.path} by an empty table")
        self._commit(commit)
        self._sweep(version, keep)
        return self._rows_of(commit)

    def _write_index(self, commit: dict, before: dict | None, replaced: Sequence[str], index_by: Sequence[str]) -> None:
        """The index of a commit: that of the one before without the files replaced, and the new files."""
        old = None if before is None else self._index_of(before)
        columns = [name.removesuffix("_min") for name in old.columns if name.endswith("_min")] if old else list(index_by)
        bounds = [
            part
            for name in columns
            for part in (
                F.min(name).alias(f"{name}_min"),
                F.max(name).alias(f"{name}_max"),
                F.count_if(F.col(name).isNull()).alias(f"{name}_nulls"),
            )
        ]
        schema = StructType.fromJson(commit["schema"])
        new = self.spark.read.schema(schema).parquet(self._folder(commit["folder"]))
        new = new.select(*columns, file_of_row().alias("file"), F.col("_metadata.file_size").alias("size"))
        index = new.groupBy("file").agg(F.count("*").alias("rows"), F.max("size").alias("bytes"), *bounds)
        if old is not None:
            gone = self.spark.createDataFrame([(file,) for file in replaced], "file STRING")
            index = old.join(gone, "file", "left_anti").unionByName(index)
        index.coalesce(1).write.parquet(self._index_folder(commit["index"]))

    def _commit(self, commit: dict) -> None:
        now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        name = f"{self._log}/v{commit['version']:09d}.json"
        if not publish_new(self.spark, name, json.dumps(commit | {"committed_at": now})):
            self._drop(commit["folder"])
            raise CommitConflictError(f"{self.path}: another writer committed version {commit['version']}")

    def _drop(self, folder: str) -> None:
        delete_folder(self.spark, self._folder(folder))
        delete_folder(self.spark, self._index_folder(folder))

    def _sweep(self, version: int, keep: int) -> None:
        """Remove what none of the last commits names: old versions, files rewritten, failed writes.

        Folders of later versions belong to a writer that is still at work.
        """
        recent = self._recent(max(keep, 1))
        whole = {commit["folder"] for commit in recent if not commit.get("index")}
        named = {row["file"] for commit in recent if commit.get("index") for row in self._index_of(commit).select("file").collect()}
        in_part = {file.split("/")[0] for file in named}
        for name in names_in(self.spark, f"{self.path}/data"):
            if name in whole or name[1:10] > f"{version:09d}":
                continue
            if name not in in_part:
                delete_folder(self.spark, self._folder(name))
                continue
            for file in names_in(self.spark, self._folder(name)):
                if file.startswith("part-") and f"{name}/{file}" not in named:
                    delete_folder(self.spark, self._folder(f"{name}/{file}"))
        indexes = {commit.get("index") for commit in recent}
        for name in names_in(self.spark, f"{self.path}/index"):
            if name not in indexes and name[1:10] <= f"{version:09d}":
                delete_folder(self.spark, self._index_folder(name))

    def files_with(self, column: str, keys: DataFrame, number: int) -> list[str]:
        """Data files with a row whose ``column`` is among ``number`` distinct keys of that name.

        Only files whose bounds allow it are read, and of them the one column. In a table sorted by
        the column, bounds alone leave little more than the files sought.
        """
        low, high = F.col(f"{column}_min"), F.col(f"{column}_max")
        index = self.index()
        if number * index.count() <= MOST_COMPARED:
            key = F.col(f"_{column}")
            able = index.join(keys.select(F.col(column).alias(f"_{column}")), (low <= key) & (key <= high), "left_semi")
        else:
            ends = keys.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
            able = index.where((high >= ends["low"]) & (low <= ends["high"]))
        able = sorted(row["file"] for row in able.select("file").collect())
        if not able:
            return []
        rows = self.read_files(able).select(column, file_of_row().alias("file"))
        found = rows.join(keys, [column], "left_semi").select("file").distinct()
        return sorted(row["file"] for row in found.collect())
