import json

from quakelake.operators import plain_outcomes, plain_silver
from quakelake.schema import PLAIN_COLUMNS, PLAIN_COORDINATES
from quakelake.sources import scan_documents


def test_silver_columns_and_values(lines, feature, collection):
    silver = plain_silver(lines(collection(feature())))
    assert silver.columns == ["feature_type", *PLAIN_COLUMNS.values(), *PLAIN_COORDINATES, "area"]
    assert len(silver.columns) == 31
    row = silver.first()
    assert (row["feature_type"], row["magnitude"], row["ids"]) == ("Feature", 4.5, ",ev1,")
    assert (row["time"], row["updated"]) == ("2024-10-21 23:59:59", "2024-10-22 00:00:00")
    assert (row["geometry_longitude"], row["geometry_latitude"], row["geometry_depth"]) == (
        10.5,
        -20.25,
        7.0,
    )
    assert row["area"] == "Ojai, CA"
    assert dict(silver.dtypes)["felt"] == "int"


def test_types_come_from_the_schema(lines, feature, collection):
    """No inference: whole-number magnitudes and all-null fields keep their type."""
    silver = plain_silver(lines(collection(feature(mag=5, tz=None))))
    assert dict(silver.dtypes)["magnitude"] == "double"
    assert dict(silver.dtypes)["timezone"] == "int"
    assert silver.first()["magnitude"] == 5.0


def test_missing_coordinates_and_keys_are_null(lines, feature, collection):
    short = feature(coordinates=(1, 2))
    none = feature(without=("place", "time"))
    none["geometry"] = None
    rows = plain_silver((lines(collection(short, none)))).collect()
    assert rows[0]["geometry_depth"] is None and rows[0]["geometry_latitude"] == 2.0
    assert rows[1]["geometry_longitude"] is None
    assert rows[1]["place"] is None and rows[1]["time"] is None and rows[1]["area"] is None


def test_documents_without_features_give_no_rows(lines, feature, collection):
    documents = lines(collection(), {"type": "FeatureCollection", "features": None}, {}, "no json")
    assert plain_silver(documents).count() == 0


def test_values_of_drifting_type_are_kept(lines, feature, collection):
    document = collection(feature(mag="1.5", felt=3.0, sig="7"), feature(coordinates=(1, "abc", 3)))
    rows = plain_silver(lines(document)).collect()
    assert (rows[0]["magnitude"], rows[0]["felt"], rows[0]["sig"]) == (1.5, 3, 7)
    assert [rows[1][f"geometry_{name}"] for name in ("longitude", "latitude", "depth")] == [1.0, None, 3.0]


def test_a_value_that_does_not_fit_leaves_the_rest_and_is_recorded(lines, feature, collection):
    odd = feature(mag="abc", felt=3.5, ids=",ev2,")
    rows = plain_outcomes(lines(collection(feature(), odd, 7, feature(ids=",ev3,")))).collect()
    kept = [(row["ids"], row["magnitude"]) for row in rows if row["outcome"] == "kept"]
    assert kept == [(",ev1,", 4.5), (",ev2,", None), (",ev3,", 4.5)]
    records = [(row["outcome"], row["reason"], row["raw"]) for row in rows if row["outcome"] != "kept"]
    assert records[0][:2] == ("lost", "lost magnitude, felt") and json.loads(records[0][2]) == odd
    assert records[1] == ("rejected", "feature is not an object", "7")


def test_flattening_reads_the_properties_once(lines, feature, collection):
    plan = plain_silver(lines(collection(feature())))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("$.properties,") == 1


def test_multi_line_files(spark, tmp_path, feature, collection):
    """Pretty-printed files, one document each, one of them broken."""
    for number in range(3):
        document = collection(feature(ids=f",{number},"), feature(ids=f",{number}b,"))
        (tmp_path / f"raw_{number}.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "raw_broken.json").write_text('{"type": "FeatureCollection", "features": [')
    silver = plain_silver(scan_documents(spark, str(tmp_path)))
    found = sorted(row["ids"] for row in silver.select("ids").collect())
    assert found == [",0,", ",0b,", ",1,", ",1b,", ",2,", ",2b,"]
    records = plain_outcomes(scan_documents(spark, str(tmp_path))).where("outcome <> 'kept'")
    assert [row["reason"] for row in records.collect()] == ["unreadable document"]
