import json

import pytest

from quakelake.operators import explode_raw_features, tolerant_rows, with_derived
from quakelake.schema import TOLERANT_SILVER
from quakelake.sources import (
    SameNameError,
    land_documents,
    land_payloads,
    outcome_lines,
    read_rejects,
    read_silver,
    scan_documents,
    scan_lines,
    scan_payloads,
    scan_text,
    silver_lines,
    write_lines,
)


def test_documents_land_one_per_line(spark, tmp_path, lines, feature, collection):
    path = str(tmp_path / "bronze")
    pretty = json.dumps(collection(feature()), indent=2)
    land_documents(lines(pretty, collection(feature())), path, "2024-01-30")
    landed = scan_lines(spark, path)
    assert landed.count() == 2
    assert {row["ingest_date"] for row in landed.collect()} == {"20240130"}
    assert [json.loads(row["value"]) for row in landed.collect()] == [collection(feature())] * 2


def test_dates_are_pruned_and_replaced_one_by_one(spark, tmp_path, lines):
    path = str(tmp_path / "bronze")
    land_documents(lines("{}", "{}"), path, "2024-01-29")
    land_documents(lines("{}", "{}", "{}"), path, "2024-01-30")
    land_documents(lines("{}"), path, "2024-01-30")
    counts = {row["ingest_date"]: row["count"] for row in scan_lines(spark, path).groupBy("ingest_date").count().collect()}
    assert counts == {"20240129": 2, "20240130": 1}
    one = scan_lines(spark, path, ["20240130"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan or "PartitionFilters: [(ingest_date" in plan
    assert one.count() == 1
    assert scan_text(spark, f"{path}/ingest_date=202401*/*").count() == 3


def test_payloads_land_unchanged(spark, tmp_path, feature, collection):
    """Bytes and names, also of what is not UTF-8 or lacks a last line feed. Scans skip empty files."""
    source, path = tmp_path / "in", tmp_path / "raw"
    source.mkdir()
    texts = [json.dumps(collection(feature(ids=str(n))), indent=n + 1) for n in range(3)]
    payloads = {f"{n} é%41.json": (text + "\n" * (n % 2)).encode() for n, text in enumerate(texts)}
    payloads |= {"latin.bin": b"\xff\xfe caf\xe9\r\n"}
    for name, payload in payloads.items():
        (source / name).write_bytes(payload)
    (source / "empty").touch()
    land_payloads(spark, str(source), str(path), "2024-01-30")
    landed = path / "ingest_date=20240130"
    assert {file.name: file.read_bytes() for file in landed.iterdir()} == payloads
    found = {row["path"].rsplit("/", 1)[1]: bytes(row["content"]) for row in scan_payloads(spark, str(landed)).collect()}
    assert found == payloads
    assert explode_raw_features(scan_documents(spark, str(path))).where("problem is null").count() == 3


def test_landing_a_date_again_replaces_that_date_alone(spark, tmp_path):
    path = tmp_path / "raw"
    for day, names in (("2024-01-30", "ab"), ("2024-01-31", "xy"), ("2024-01-30", "bc")):
        source = tmp_path / f"in-{day}-{names}"
        source.mkdir()
        for name in names:
            (source / name).write_text(f"{name} of {names}")
        land_payloads(spark, str(source), str(path), day)
    stored = {str(file.relative_to(path)): file.read_text() for file in path.rglob("*") if file.is_file()}
    assert stored == {
        "ingest_date=20240130/b": "b of bc", "ingest_date=20240130/c": "c of bc",
        "ingest_date=20240131/x": "x of xy", "ingest_date=20240131/y": "y of xy",
    }


def test_payloads_of_one_name_are_refused(spark, tmp_path):
    for folder in ("one", "two"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "same.json").write_text(folder)
    with pytest.raises(SameNameError):
        land_payloads(spark, str(tmp_path / "in" / "*"), str(tmp_path / "raw"), "2024-01-30")
    assert not (tmp_path / "raw").exists()


def test_json_lines_write_nulls(spark, tmp_path, lines, feature, collection):
    path = tmp_path / "silver"
    rows = with_derived(tolerant_rows(explode_raw_features(lines(collection(feature(place="nowhere"))))))
    write_lines(rows.coalesce(1), str(path))
    (file,) = path.glob("part-*")
    written = json.loads(file.read_text())
    assert list(written) == TOLERANT_SILVER.names
    assert written["area"] is None and written["mmi"] is None
    assert spark.read.schema(TOLERANT_SILVER).json(str(path)).collect() == rows.collect()


def test_outcomes_are_kept_apart(spark, tmp_path, lines, feature, collection):
    from quakelake.operators import checked_rows, outcomes

    document = collection(feature(), feature(id_="ev2", place=None), feature(without=("title",)))
    path = str(tmp_path / "silver")
    rows = outcomes(with_derived(checked_rows(explode_raw_features(lines(document, "{bad")))))
    silver_lines(spark, path).replace(outcome_lines(rows))
    kept, rejects = read_silver(spark, path), read_rejects(spark, path)
    assert kept.columns == TOLERANT_SILVER.names
    assert sorted(row["id"] for row in kept.collect()) == ["ev1", "ev2"]
    assert sorted(row["reason"] for row in rejects.collect()) == ["missing title", "unreadable document"]
    raws = {row["reason"]: row["raw"] for row in rejects.collect()}
    assert raws["unreadable document"] == "{bad"
    assert json.loads(raws["missing title"])["id"] == "ev1"


def test_landed_documents_are_compressed_and_few_to_a_file(spark, tmp_path, feature, collection):
    """A compressed file is one task's work, so it holds a bounded number of documents."""
    path = tmp_path / "bronze"
    text = json.dumps(collection(*[feature(id_=f"ev{i}") for i in range(50)]))
    documents = spark.range(0, 300, 1, 1).selectExpr(f"'{text}' AS value")
    land_documents(documents, str(path), "2024-01-30")
    files = list((path / "ingest_date=20240130").glob("part-*"))
    assert len(files) == 3 and all(file.suffix == ".gz" for file in files)
    assert sum(file.stat().st_size for file in files) < 300 * len(text) / 5
    landed = scan_lines(spark, str(path), ["20240130"])
    assert landed.count() == 300 and landed.distinct().first()["value"] == text


def test_compressed_documents_are_scanned_whole(spark, tmp_path, feature, collection):
    """Bytes of a compressed file are not those of its text: it is not cut, however long it is."""
    import gzip

    raw = json.dumps(collection(*[feature(id_=f"ev{i}", code=str(i * 7919)) for i in range(200)]))
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(raw.encode()))
    (tmp_path / "b.json").write_text(raw)
    documents = scan_documents(spark, str(tmp_path), split=1_000)
    assert documents.count() > 2
    counts = explode_raw_features(documents).selectExpr("count(feature) AS n", "count(problem) AS bad").first()
    assert tuple(counts) == (400, 0)


def test_json_lines_can_be_compressed(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), (None, 2)], "s STRING, n INT")
    write_lines(rows, str(tmp_path / "lines"), compressed=True)
    assert {file.suffix for file in (tmp_path / "lines").glob("part-*")} == {".gz"}
    assert sorted(map(repr, spark.read.schema(rows.schema).json(str(tmp_path / "lines")).collect())) == sorted(map(repr, rows.collect()))
