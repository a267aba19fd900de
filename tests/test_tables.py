import pytest
from pyspark.sql import functions as F

from quakelake.files import exists
from quakelake.operators import analytics
from quakelake.session import MOST_PARTITIONS, shared_dir, shuffle_partitions_for, sized_shuffles
from quakelake.sources import CommitConflictError, EmptyBatchError, VersionedTable


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def values(rows):
    return sorted(row["id"] for row in rows.collect())


def test_replace_and_read(spark, table):
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    assert values(table.replace(spark.range(3))) == [0, 1, 2]
    assert values(table.read()) == [0, 1, 2]
    assert table.row_count() == 3


def test_content_may_be_computed_from_itself(spark, table):
    table.replace(spark.range(3))
    table.replace(table.read().select((F.col("id") + 10).alias("id")))
    assert values(table.read()) == [10, 11, 12]


def test_a_failing_job_leaves_the_content(spark, table):
    table.replace(spark.range(3))
    failing = spark.range(5).select(
        F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id")
    )
    with pytest.raises(Exception, match="lost"):
        table.replace(failing)
    assert values(table.read()) == [0, 1, 2]
    table.replace(spark.range(1))
    assert values(table.read()) == [0]


def test_empty_content_is_refused(spark, table):
    table.replace(spark.range(3))
    for empty in (spark.range(0), spark.range(3).filter("id > 7"), table.read().filter("id > 7")):
        with pytest.raises(EmptyBatchError):
            table.replace(empty)
    assert values(table.read()) == [0, 1, 2]
    table.replace(spark.range(0), allow_empty=True)
    assert values(table.read()) == [] and table.row_count() == 0


def test_replaced_versions_are_dropped(spark, table):
    places = []
    for size in range(1, 5):
        table.replace(spark.range(size))
        places.append(table.location())
    assert [exists(spark, place) for place in places] == [False, False, True, True]
    assert table.commits().count() == 4
    table.replace(spark.range(9), keep=1)
    assert not exists(spark, places[-1])
    assert table.row_count() == 9


def test_of_two_writers_of_a_version_the_second_fails(spark, table, monkeypatch):
    table.replace(spark.range(3))
    other = VersionedTable(spark, table.path)
    stale = other._recent(1)
    table.replace(spark.range(4))
    real = VersionedTable._recent
    monkeypatch.setattr(other, "_recent", lambda count: stale)
    with pytest.raises(CommitConflictError):
        other.replace(spark.range(5))
    monkeypatch.setattr(other, "_recent", real.__get__(other))
    assert values(other.read()) == [0, 1, 2, 3]


def test_folders_of_failed_writes_are_removed(spark, table):
    orphan = f"{table.path}/data/v000000001-dead"
    spark.range(1).write.parquet(orphan)
    table.replace(spark.range(3))
    assert not exists(spark, orphan) and values(table.read()) == [0, 1, 2]


def test_clustering_narrows_row_group_statistics(spark, table):
    """Rows are sorted inside each file, so a bound on the time can skip row groups."""
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id"))
    table.replace(rows.repartition(3), cluster_by=["id"])
    position = F.struct("_metadata.file_path", "_metadata.row_index")
    read = table.read().select("id", position.alias("at")).collect()
    by_file = {}
    for row in sorted(read, key=lambda row: tuple(row["at"])):
        by_file.setdefault(row["at"]["file_path"], []).append(row["id"])
    assert all(ids == sorted(ids) for ids in by_file.values())


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == named.rstrip("/") if named else shared_dir(spark)
    assert shared_dir(spark) == shared_dir(spark)


def test_shuffles_grow_with_the_input(spark, table):
    table.replace(spark.range(10))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 10):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with sized_shuffles(spark, 100 << 30):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1200"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert shuffle_partitions_for(0, 4) == 4
    # 100 TB of gold, and the keys of 1 TB of daily: partitions grow in size, not without end in number.
    assert shuffle_partitions_for(100 << 40, 200) == MOST_PARTITIONS
    assert shuffle_partitions_for(1 << 35, 200) == 384


def physical(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_questions_read_only_what_they_need(spark, table):
    rows = spark.range(5).selectExpr(
        "cast(id AS string) AS ids", "'2024-01-20 00:00:00' AS time", "'x' AS area",
        "cast(id AS double) AS magnitude", "id AS other",
    )
    gold = table.replace(rows)
    plan = physical(analytics.count_by_day_area(gold))
    assert "ReadSchema: struct<time:string,area:string>" in plan
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    plan = physical(analytics.areas_over(gold))
    assert "GreaterThan(magnitude,5.0)" in plan and "Exchange" not in plan
    plan = physical(analytics.top_area_of_week(gold, "2024-01-27"))
    assert "GreaterThanOrEqual(time,2024-01-20)" in plan and "StringStartsWith(time,+)" in plan
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def names_of(table):
    import os

    return sorted(os.listdir(f"{table.path}/commits"))


@pytest.mark.parametrize("torn", ["", '{"version": 2, "fol', "[]", '{"version": 2}'])
def test_a_torn_commit_counts_as_none(spark, table, torn):
    table.replace(spark.range(3))
    with open(f"{table.path}/commits/v000000002.json", "w") as file:
        file.write(torn)
    assert values(table.read()) == [0, 1, 2] and table.row_count() == 3
    assert values(table.replace(table.read().selectExpr("id + 5 AS id"))) == [5, 6, 7]
    assert names_of(table)[-1] == "v000000003.json" and values(table.read()) == [5, 6, 7]
    values(table.replace(spark.range(2)))
    assert values(table.read()) == [0, 1]


def test_a_first_commit_that_is_torn(spark, table):
    import os

    os.makedirs(f"{table.path}/commits")
    open(f"{table.path}/commits/v000000001.json", "w").close()
    assert not table.exists()
    assert values(table.replace(spark.range(2))) == [0, 1] == values(table.read())


def test_a_crash_before_the_commit_is_named_leaves_the_version_before(spark, table, monkeypatch):
    from quakelake import files

    table.replace(spark.range(3))

    def crash(*args):
        raise OSError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(files, "_link_new", crash)
        with pytest.raises(OSError, match="killed"):
            table.replace(spark.range(5))
    assert values(table.read()) == [0, 1, 2] and [n for n in names_of(table) if n[0] == "v"] == ["v000000001.json"]
    assert values(table.replace(spark.range(5))) == [0, 1, 2, 3, 4]


def test_files_are_published_whole_and_once(spark, tmp_path, monkeypatch):
    """By a link on local disks, by a rename that does not replace elsewhere."""
    from quakelake import files

    def renamed(source, target):
        files._rename_new(spark, source, target)

    for i, link in enumerate((files._link_new, renamed)):
        monkeypatch.setattr(files, "_link_new", link)
        path = str(tmp_path / f"some{i}" / "file.json")
        assert files.publish_new(spark, path, "one")
        assert not files.publish_new(spark, path, "two")
        assert files.read_small(spark, path) == "one"
        assert files.names_in(spark, str(tmp_path / f"some{i}")) == ["file.json"]


def people(spark, low, high, other="x"):
    return spark.range(low, high).selectExpr("cast(id AS string) AS key", "id", f"'{other}' AS other")


def test_stamps_are_read_and_not_stored(spark, table):
    rows = table.replace(people(spark, 0, 3), stamps={"at": ("timestamp", "2024-01-30 12:00:00")})
    assert rows.columns == ["key", "id", "other", "at"] and dict(rows.dtypes)["at"] == "timestamp"
    assert {str(row["at"]) for row in rows.collect()} == {"2024-01-30 12:00:00"}
    assert "at" not in spark.read.parquet(table.location()).columns
    table.replace(table.read().limit(0).drop("at"), allow_empty=True, stamps={"at": ("string", "later")})
    assert table.read().columns == ["key", "id", "other", "at"] and table.read().count() == 0


def test_files_are_rewritten_alone(spark, table):
    table.replace(people(spark, 0, 80).repartitionByRange(8, "id"), index_by=["key", "id"])
    index = {row["file"]: row for row in table.index().collect()}
    assert len(index) == 8 and sum(row["rows"] for row in index.values()) == 80 == table.row_count()
    assert all(row["id_max"] - row["id_min"] == 9 and row["key_nulls"] == 0 for row in index.values())
    keys = spark.createDataFrame([("12",), ("19",), ("nobody",)], "key STRING")
    touched = table.files_with("key", keys, 3)
    assert [index[file]["id_min"] for file in touched] == [10]
    kept = table.read_files(touched).where("id % 2 = 0")
    rows = table.rewrite(touched, kept.unionByName(people(spark, 100, 103, "new")), stamps={"at": ("string", "now")})
    assert values(rows) == [*range(10), *range(10, 20, 2), *range(20, 80), 100, 101, 102] == values(table.read())
    assert table.row_count() == 78 and rows.columns == ["key", "id", "other", "at"]
    assert {row["file"] for row in table.index().collect()} >= set(index) - set(touched)
    assert table.stored_bytes() == sum(row["bytes"] for row in table.index().collect()) > 0


def test_files_that_no_version_names_are_removed(spark, table):
    import glob

    table.replace(people(spark, 0, 40).repartitionByRange(4, "id"), index_by=["id"])
    for i in range(4):
        touched = table.files_where(F.col("id_min") == 10 * i)
        table.rewrite(touched, table.read_files(touched).selectExpr("key", "id + 1000 AS id", "other"))
    stored = {path.split("/data/")[1] for path in glob.glob(f"{table.path}/data/*/part-*")}
    live = {row["file"] for row in table.index().collect()}
    before = {row["file"] for row in table._index_of(table._recent(2)[1]).collect()}
    assert stored == live | before and len(live) >= 4
    assert len(glob.glob(f"{table.path}/index/*")) == 2
    assert values(table.read()) == list(range(1000, 1040))
    table.replace(spark.range(2), keep=1)
    assert values(table.read()) == [0, 1] and not glob.glob(f"{table.path}/index/*")


def test_an_indexed_table_may_become_empty_and_full_again(spark, table):
    table.replace(people(spark, 0, 4), index_by=["id"])
    assert table.rewrite(table.files_where(F.lit(True)), people(spark, 0, 0)).count() == 0
    assert table.read().columns == ["key", "id", "other"] and table.row_count() == 0
    assert values(table.rewrite([], people(spark, 5, 7))) == [5, 6]
    with pytest.raises(EmptyBatchError):
        table.replace(people(spark, 0, 0), index_by=["id"])
    assert values(table.read()) == [5, 6]


def test_content_is_compressed(spark, tmp_path):
    """Parquet as zstd; texts as gzip, with a bounded number of rows a file."""
    import glob

    rows = spark.range(0, 250_000, 1, 1).selectExpr("id", "'https://example.org/event/' || id AS url")
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(rows)
    assert all(path.endswith(".zstd.parquet") for path in glob.glob(f"{table.location()}/part-*"))
    assert table.read().agg({"id": "sum"}).first()[0] == 250_000 * 249_999 // 2
    text = VersionedTable(spark, str(tmp_path / "l"), stored_as="text")
    text.replace(rows.selectExpr("url AS value"))
    files = glob.glob(f"{text.location()}/part-*")
    assert len(files) == 3 and all(path.endswith(".gz") for path in files)
    assert text.read().distinct().count() == 250_000


def test_rows_to_be_sorted_are_read_in_small_splits(spark, tmp_path, monkeypatch):
    """A task that sorts gets files up to a bound of stored bytes, whatever the session reads at once."""
    monkeypatch.setattr("quakelake.sources.tables.SORTED_BYTES", 1 << 20)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = str(tmp_path / "rows")
    spark.range(800).repartition(8).write.parquet(path)
    table = VersionedTable(spark, str(tmp_path / "sorted"))
    table.replace(spark.read.parquet(path), cluster_by=["id"])
    assert values(table.read()) == list(range(800))
    assert table.read().select("_metadata.file_path").distinct().count() == 8
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
