"""Tolerant silver as JSON lines: every key written; rejects and losses beside the kept rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakelake.files import packed
from quakelake.operators.checked import KEPT, LOST, OUTCOME, REJECTED
from quakelake.schema import REJECTS, TOLERANT_SILVER
from quakelake.sources.tables import ROWS_A_TEXT_FILE, VersionedTable

def json_line(*columns: str) -> Column:
    """A row as one JSON object; null fields are written, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_lines(rows: DataFrame, path: str, compressed: bool = False) -> None:
    """Any rows as JSON lines with their null fields."""
    writer = rows.select(json_line(*rows.columns).alias("value")).write.mode("overwrite")
    (packed(writer, ROWS_A_TEXT_FILE) if compressed else writer).text(path)


def outcome_lines(rows: DataFrame) -> DataFrame:
    """Rows with an ``outcome`` as JSON lines: kept ones with the silver columns, others as rejects."""
    kept = F.col(OUTCOME) == KEPT
    line = F.when(kept, json_line(*TOLERANT_SILVER.names)).otherwise(json_line(*REJECTS.names))
    return rows.select(line.alias("value"), OUTCOME)


def silver_lines(spark: SparkSession, path: str) -> VersionedTable:
    """The table of tolerant silver: JSON lines by outcome, staged and committed like any other."""
    return VersionedTable(spark, path, stored_as="text")


def _read_outcome(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    fields = TOLERANT_SILVER.fields if outcome == KEPT else REJECTS.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    rows = spark.read.schema(f"{schema}, {OUTCOME} STRING").json(silver_lines(spark, path).location())
    return rows.filter(F.col(OUTCOME) == outcome).select(*[f.name for f in fields])


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Kept rows; the partition filter leaves the rest unread."""
    return _read_outcome(spark, path, KEPT)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rejected features and documents with the reason."""
    return _read_outcome(spark, path, REJECTED)


def read_lost(spark: SparkSession, path: str) -> DataFrame:
    """Features that were kept without some of their values, and the names of those."""
    return _read_outcome(spark, path, LOST)
