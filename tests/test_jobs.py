import pytest
from pyspark.sql import functions as F

from quakelake.operators import analytics
from quakelake.plans import kept_rows, load_daily, load_historic, load_tolerant, merge_gold, set_aside
from quakelake.sources import EmptyBatchError, VersionedTable, read_rejects, read_silver


@pytest.fixture
def tables(spark, tmp_path):
    names = ("silver", "gold", "silver_daily", "gold_daily", "keys", "tolerant")
    return {name: VersionedTable(spark, str(tmp_path / name)) for name in names}


@pytest.fixture
def loaded(lines, feature, collection, tables):
    def one(key, mag):
        return feature(ids=key, mag=mag, id_=f"id{key}")

    history = collection(one("a", 1.0), one("b", 2.0), one("b2", 3.0), one(None, 4.0))
    daily = collection(one("b", 5.0), one("b2", 6.0), one("b2", 7.0), one("c", 8.0), one(None, 9.0))
    load_historic(lines(history), tables["silver"], tables["gold"])
    load_daily(lines(daily), tables["silver_daily"], tables["gold_daily"])
    return tables


def merge(tables, **options):
    return merge_gold(tables["gold"], tables["gold_daily"], tables["keys"], **options)


def content(rows):
    return sorted(((row["ids"], row["magnitude"]) for row in rows.collect()), key=repr)


MERGED = sorted(
    [("a", 1.0), ("b", 5.0), ("b2", 6.0), ("b2", 7.0), ("c", 8.0), (None, 4.0), (None, 9.0)], key=repr
)


def test_loads_store_silver_and_gold(loaded):
    assert len(kept_rows(loaded["silver"]).columns) == 31
    assert set_aside(loaded["silver"]).count() == 0
    gold = loaded["gold"].read()
    assert gold.columns[-1] == "insert_dt" and len(gold.columns) == 32
    assert dict(gold.dtypes)["insert_dt"] == "timestamp"
    assert gold.count() == 4 and loaded["gold_daily"].row_count() == 5


def test_merge_replaces_gold(loaded):
    merged = merge(loaded)
    assert merged.columns[0] == "ids" and len(merged.columns) == 32
    assert content(merged) == content(loaded["gold"].read()) == MERGED
    assert merged.select("insert_dt").distinct().count() == 1
    counted = analytics.count_by_area(merged).agg(F.sum("no_earthquakes")).first()[0]
    assert counted == merged.count()


def test_merge_restamps_every_row(loaded):
    before = loaded["gold"].read().agg(F.max("insert_dt")).first()[0]
    assert merge(loaded).agg(F.min("insert_dt")).first()[0] > before


def test_merging_the_batch_again(loaded):
    merge(loaded)
    assert content(merge(loaded)) == sorted([*MERGED, (None, 9.0)], key=repr)


def test_ordered_merge(loaded):
    merged = merge(loaded, ordered=True)
    assert content(merged) == MERGED
    at = ["_metadata.file_path", "_metadata.row_index"]
    stored = merged.select("ids", *at).orderBy("file_path", "row_index").collect()
    assert [row["ids"] for row in stored] == [None, None, "a", "b", "b2", "b2", "c"]


def test_empty_daily_batch_is_refused(loaded, lines, collection):
    load = lines(collection())
    with pytest.raises(EmptyBatchError):
        load_daily(load, loaded["silver_daily"], loaded["gold_daily"])
    assert loaded["gold_daily"].row_count() == 5
    loaded["gold_daily"].replace(loaded["gold_daily"].read().limit(0), allow_empty=True)
    with pytest.raises(EmptyBatchError):
        merge(loaded)
    assert merge(loaded, allow_empty=True).count() == 4


def test_tolerant_job(spark, tmp_path, lines, feature, collection, tables):
    silver = str(tmp_path / "tolerant_silver")
    documents = lines(
        collection(feature(), feature(id_="ev2", time="abc", place=None), feature(without=("status",))),
        collection(feature(id_="ev3", mag=None)),
        "{broken",
    )
    gold = load_tolerant(documents, silver, tables["tolerant"])
    assert gold.columns[:3] == ["time", "updated", "area"] and gold.columns[-1] == "insert_date"
    assert dict(gold.dtypes)["insert_date"] == "string"
    rows = {row["id"]: row for row in gold.collect()}
    assert sorted(rows) == ["ev1", "ev2", "ev3"]
    assert (rows["ev2"]["time"], rows["ev2"]["area"], rows["ev3"]["mag"]) == ("abc", None, 0.0)
    assert rows["ev1"]["area"] == "Ojai, CA"
    rejected = read_rejects(spark, silver)
    assert gold.count() + rejected.count() == 5
    with pytest.raises(EmptyBatchError):
        load_tolerant(lines("{broken"), silver, tables["tolerant"])
    assert tables["tolerant"].row_count() == 3
    assert sorted(row["id"] for row in read_silver(spark, silver).collect()) == ["ev1", "ev2", "ev3"]
    assert read_rejects(spark, silver).count() == 2


def test_a_crashed_tolerant_batch_leaves_silver(spark, tmp_path, lines, feature, collection, tables):
    silver = str(tmp_path / "tolerant_silver")
    load_tolerant(lines(collection(feature())), silver, tables["tolerant"])
    crash = F.when(F.col("value") != "x", F.col("value")).otherwise(F.raise_error(F.lit("lost")))
    broken = lines(collection(feature(id_="ev2")), "x").select(crash.alias("value"))
    with pytest.raises(Exception, match="lost"):
        load_tolerant(broken, silver, tables["tolerant"])
    assert [row["id"] for row in read_silver(spark, silver).collect()] == ["ev1"]


def test_plain_loads_keep_what_is_sound_and_record_the_rest(lines, feature, collection, tables):
    documents = lines(collection(feature()), "{broken", collection(feature(ids="b"), 7, feature(ids="c", mag="x")))
    assert load_historic(documents, tables["silver"], tables["gold"]).count() == 3
    found = sorted((row["outcome"], row["reason"]) for row in set_aside(tables["silver"]).collect())
    assert found == [
        ("lost", "lost magnitude"), ("rejected", "feature is not an object"), ("rejected", "unreadable document"),
    ]
    assert tables["silver"].row_count() == 3


def test_a_load_can_name_its_time(lines, feature, collection, tables):
    gold = load_historic(lines(collection(feature())), tables["silver"], tables["gold"], at="2024-01-30 12:00:00")
    assert str(gold.first()["insert_dt"]) == "2024-01-30 12:00:00"


def test_loads_do_not_shuffle(spark, lines, feature, collection, tables):
    """Documents go to silver and gold in map tasks only."""
    from quakelake.operators import plain_silver

    plan = plain_silver(lines(collection(feature())))._jdf.queryExecution()
    assert "Exchange" not in plan.executedPlan().toString()


def test_merge_plan(loaded):
    """One join, gold read once; few stored keys are broadcast and gold is not shuffled."""
    from quakelake.operators import distinct_keys, upsert

    daily = loaded["gold_daily"].read()
    keys = loaded["keys"].replace(distinct_keys(daily))
    merged = upsert(loaded["gold"].read(), daily, keys)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftAnti") == 1 and plan.count("FileScan") == 3
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_keys_are_broadcast_only_within_bounds(loaded, monkeypatch):
    """Past either bound the merge goes another way to the same content."""
    from quakelake.plans import jobs

    matched = VersionedTable(loaded["keys"].spark, loaded["keys"].path + "_matched")
    before = VersionedTable(loaded["keys"].spark, loaded["keys"].path + "_before")
    before.replace(loaded["gold"].read())
    # All daily keys fit; only the matched ones do; not even those, by number or by bytes.
    for keys, size, narrowed in ((10, 1 << 30, False), (2, 1 << 30, True), (1, 1 << 30, True), (10, 10, True)):
        monkeypatch.setattr(jobs, "BROADCAST_KEYS", keys)
        monkeypatch.setattr(jobs, "BROADCAST_BYTES", size)
        loaded["gold"].replace(before.read())
        assert content(merge(loaded)) == MERGED
        assert jobs._few(loaded["keys"]) != narrowed
        assert matched.exists() or not narrowed
    assert sorted(row["ids"] for row in matched.read().collect()) == ["b", "b2"]


def test_the_tolerant_write_does_not_sort(spark, tmp_path, lines, feature, collection, tables):
    """Few outcomes keep their writers open together."""
    from quakelake.operators import checked_rows, explode_raw_features, outcomes, with_derived
    from quakelake.session import setting
    from quakelake.sources import outcome_lines

    rows = outcome_lines(outcomes(with_derived(checked_rows(explode_raw_features(lines(collection(feature())))))))
    status = spark._jsparkSession.sharedState().statusStore()
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "4"):
        rows.write.partitionBy("outcome").text(str(tmp_path / "out"))
    executions = status.executionsList()
    plan = executions.apply(executions.size() - 1).physicalPlanDescription()
    assert "InsertIntoHadoopFsRelationCommand" in plan and "Sort" not in plan.split("== Initial Plan ==")[0]


@pytest.fixture
def wide(spark, tables):
    """Gold of twelve files, some 40 rows each, by key, and a way to merge a batch into it."""

    def made(low, high, day, step=1):
        keys = spark.range(low, high, step).selectExpr(
            "concat('k', lpad(id, 5, '0')) AS ids", f"'2024-01-{day:02d} 00:00:00' AS time",
            "cast(id AS double) AS magnitude", "'x' AS area",
        )
        return keys

    gold = made(0, 240, 3).unionByName(made(240, 480, 20))
    gold = gold.unionByName(gold.limit(7).withColumn("ids", F.lit(None).cast("string")))
    tables["gold"].replace(gold.repartitionByRange(12, "magnitude"), index_by=("ids", "time"))
    return made


def files_of(table):
    return {row["file"] for row in table.index().collect()}


def test_a_small_batch_rewrites_few_files(wide, tables):
    """Ten keys touch no more than ten files; here they lie in two. All others stay as they are."""
    before = files_of(tables["gold"])
    assert len(before) == 12
    tables["gold_daily"].replace(wide(100, 105, 25).unionByName(wide(300, 305, 25)))
    merged = merge(tables)
    after = files_of(tables["gold"])
    assert 1 <= len(before - after) <= 4 and len(before & after) >= 8
    assert merged.columns == ["ids", "time", "magnitude", "area", "insert_dt"]
    assert merged.count() == 487 == tables["gold"].row_count()
    assert merged.where("time like '2024-01-25%'").count() == 10
    assert merged.select("ids").where("ids is not null").distinct().count() == 480
    assert merged.select("insert_dt").distinct().count() == 1


def test_a_batch_of_new_keys_rewrites_nothing(wide, tables):
    before = files_of(tables["gold"])
    tables["gold_daily"].replace(wide(900, 930, 25))
    first = merge(tables).agg(F.max("insert_dt")).first()[0]
    assert before < files_of(tables["gold"])
    assert tables["gold"].read().count() == 517
    assert merge(tables).agg(F.min("insert_dt")).first()[0] > first


def test_touched_files_are_the_same_by_all_ways(wide, tables, monkeypatch):
    """Keys that are broadcast, keys that are not, and files told by the ends of the batch alone."""
    from quakelake.plans import jobs
    from quakelake.sources import tables as stored_tables

    tables["gold_daily"].replace(wide(90, 130, 25, 3).unionByName(wide(600, 610, 25)))
    before = tables["gold"].read()
    kept = VersionedTable(before.sparkSession, tables["gold"].path + "_kept")
    kept.replace(before)
    wanted = None
    for most, keys in ((10**8, 4_000_000), (0, 4_000_000), (10**8, 1), (0, 1)):
        monkeypatch.setattr(stored_tables, "MOST_COMPARED", most)
        monkeypatch.setattr(jobs, "BROADCAST_KEYS", keys)
        tables["gold"].replace(kept.read().repartitionByRange(12, "magnitude"), index_by=("ids", "time"))
        old = files_of(tables["gold"])
        found = content(merge(tables))
        assert 1 <= len(old - files_of(tables["gold"])) <= 3
        wanted = wanted or found
        assert found == wanted and len(found) == 487 + 10


def test_an_ordered_table_tells_touched_files_by_bounds(wide, tables):
    """After a total order by key, bounds rule out all files but those of the batch's keys."""
    tables["gold_daily"].replace(wide(900, 901, 25))
    merge(tables, ordered=True)
    gold = tables["gold"]
    bounds = [(row["ids_min"], row["ids_max"]) for row in gold.index().collect() if row["ids_min"]]
    assert all(a[1] <= b[0] or b[1] <= a[0] for a in bounds for b in bounds if a != b)
    key = gold.read().where("ids is not null").select("ids").orderBy("ids").first()["ids"]
    keys = gold.spark.createDataFrame([(key,)], "ids STRING")
    assert len(gold.files_with("ids", keys, 1)) == 1


def test_recent_days_leave_old_files_unopened(wide, tables):
    from quakelake.plans import gold_since_week

    gold = tables["gold"]
    recent = gold_since_week(gold, "2024-01-27")
    assert 5 <= len(recent.inputFiles()) <= 7
    assert [row["area"] for row in analytics.top_area_of_week(recent, "2024-01-27").collect()] == ["x"]
    assert recent.where("time >= '2024-01-20'").count() == gold.read().where("time >= '2024-01-20'").count()
    late = wide(0, 3, 3).withColumn("time", F.lit("+12024-01-01 00:00:00"))
    gold.rewrite([], late)
    assert gold_since_week(gold, "2999-01-01").where("time like '+%'").count() == 3
    assert len(gold_since_week(gold, "2999-01-01").inputFiles()) <= 3
