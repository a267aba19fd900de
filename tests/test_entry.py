"""Every registered query against its SQL, on the smallest tables."""

import math
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "events", "orders"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def bag(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    clean = (tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row) for row in zip(*columns))
    return names, sorted(map(repr, clean))


@pytest.mark.parametrize("name", sorted(n for n in spark_entry.queries() if n.startswith("q_")))
def test_query_matches_its_sql(spark, database, name):
    found = spark_entry.queries()[name](spark, SF_DIR).toArrow()
    assert found.num_rows > 0
    expected = database.sql(SQL[name]).to_arrow_table()
    assert bag(found) == bag(expected)


def test_entry(spark):
    areas = spark_entry.entry(spark)
    assert areas.columns == ["area", "no_earthquakes"]
    assert areas.agg({"no_earthquakes": "sum"}).first()[0] == 1000


def test_sorted_gold_is_sorted(spark):
    ids = [row["ids"] for row in spark_entry.queries()["q_gold_ordered"](spark, SF_DIR).collect()]
    assert ids == sorted(ids, key=lambda key: (key is not None, key))


def test_without_the_operators_on_training_data_the_lake_still_registers():
    """Their package, or a library that it needs, may be missing."""
    for missing in ("quakelake.llm", "xxhash"):
        code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries())"
        root = Path(spark_entry.__file__).parent
        names = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
        assert names == [name for name in spark_entry.queries() if name.startswith("q_")]
