import json

import pytest

from quakelake.__main__ import main
from quakelake.sources import VersionedTable, read_rejects


@pytest.fixture
def run(spark, tmp_path):
    return lambda *args: main(["--lake", str(tmp_path / "lake"), *args], spark)


@pytest.fixture
def raw(tmp_path, feature, collection):
    def write(name, *features):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "feed.json").write_text(json.dumps(collection(*features), indent=1))
        return str(folder)

    return write


def test_from_raw_files_to_an_answer(spark, tmp_path, run, raw, feature):
    history = raw("h", feature(ids="a", mag=6.5), feature(ids="b", mag=7.0))
    daily = raw("d", feature(ids="b", mag=5.5, place="south of Fiji"), feature(ids="c", mag=1.0))
    run("land", "history", history, "--day", "2024-01-30")
    run("land", "daily", daily, "--day", "2024-01-30", "--unchanged")
    run("historic", "history", "--ingest-date", "20240130")
    run("daily", "daily", "--multi-line")
    run("merge")
    gold = VersionedTable(spark, str(tmp_path / "lake" / "gold")).read()
    assert sorted(row["ids"] for row in gold.collect()) == ["a", "b", "c"]
    out = str(tmp_path / "answer")
    run("ask", "areas-over", "--magnitude", "5.25", "--out", out)
    assert sorted(row["area"] for row in spark.read.parquet(out).collect()) == ["Fiji", "Ojai, CA"]
    run("ask", "top-area-of-week", "--as-of", "2024-10-22", "--out", out)
    assert [row["area"] for row in spark.read.parquet(out).collect()] == ["Ojai, CA"]


def test_tolerant_path(spark, tmp_path, run, raw, feature):
    source = raw("t", feature(), feature(without=("title",)))
    run("land", "feed", source, "--day", "2024-01-30")
    run("tolerant", "feed")
    lake = tmp_path / "lake"
    assert VersionedTable(spark, str(lake / "gold_tolerant")).row_count() == 1
    assert read_rejects(spark, str(lake / "silver_tolerant")).count() == 1
