"""Documents cut between their features give the rows of documents read whole."""

import json
import random

import pytest

from quakelake.operators import explode_raw_features
from quakelake.sources import scan_documents
from quakelake.sources.split_documents import split_documents


def rows(documents):
    read = explode_raw_features(documents).selectExpr("document_type", "raw", "to_json(feature) AS feature", "problem")
    return sorted(map(repr, read.collect()))


def scanned(spark, path, split):
    return scan_documents(spark, str(path), split=split)


def hard(number, seed):
    """Features whose texts hold all that could be taken for structure."""
    pick = random.Random(seed)
    texts = ['"', "\\", '\\"', "{", "}]", ',{"a":[', "\\\\", "é日本", "", '"features":[', "\n"]
    return [
        {"id": i, "t": "".join(pick.choices(texts, k=pick.randrange(6))), "n": [[1, {"x": [None, ","]}], {}][: pick.randrange(3)]}
        for i in range(number)
    ]


HARD = {"type": "FeatureCollection", "metadata": {"title": 'a,"b" \\', "l": [1, {"features": [1, 2]}, [3]]}, "features": hard(60, 1), "bbox": [1, [2, 3], 4]}
PLAIN = {"type": "FeatureCollection", "features": [{"id": i, "properties": {"mag": i / 2}} for i in range(40)]}
TEXT = json.dumps(PLAIN)
DOCUMENTS = {
    "hard": json.dumps(HARD),
    "hard, unescaped": json.dumps(HARD, ensure_ascii=False),
    "indented": json.dumps(HARD, indent=3),
    "no type": json.dumps({"features": hard(30, 2)}),
    "odd type": json.dumps({"type": {"a": '"'}, "features": hard(30, 3)}),
    "cut off": TEXT[:-200],
    "text after it": TEXT + " trailing",
    "two documents": TEXT + TEXT,
    "broken feature": TEXT.replace('"id": 20', '"id" 20'),
    "empty feature": TEXT.replace('{"id": 20', ',{"id": 20'),
    "first left out": TEXT.replace('[{"id": 0', '[,{"id": 0'),
    "comma at the end": TEXT.replace("}]}", "},]}"),
    "wrong bracket": TEXT.replace('"id": 20, "properties": {"mag": 10.0}}', '"id": 20, "properties": [10.0}]'),
    "two arrays": TEXT[:-1] + ', "features": [{"id": "last"}]}',
    "escaped key": TEXT.replace('"features"', '"\\u0066eatures"'),
    "escaped second key": TEXT[:-1] + ', "\\u0066eatures": [{"id": "last"}]}',
    "single quotes": str(PLAIN),
    "single quotes beside": TEXT.replace('"FeatureCollection"', "'\"features\":['"),
    "no array": json.dumps({"type": "FeatureCollection", "features": {"a": hard(20, 4)}}),
    "no features": json.dumps({"type": "FeatureCollection", "other": hard(20, 5)}),
    "only an array": json.dumps(hard(20, 6)),
    "empty array": '{"features": [' + " " * 300 + "]}",
    "blanks": " " * 300,
    "no JSON": '"' * 99 + "]}[{," * 50,
    "backslashes": '{"features": ["' + "\\" * 400 + '", "' + "\\" * 200 + '\\", 1, 2"]}',
}


@pytest.mark.parametrize("split", (151, 400))
def test_cut_documents_have_the_rows_of_whole_ones(spark, tmp_path, split):
    for name, text in DOCUMENTS.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    (tmp_path / "short.json").write_text('{"type": "s", "features": [{"id": 1}]}')
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "bytes.json").write_bytes(b'{"features": [' + b",".join([b'{"t": "\xff\xfe"}'] * 50) + b"]}")
    documents = scanned(spark, tmp_path, split)
    assert documents.count() > 3 * len(DOCUMENTS)
    assert rows(documents) == rows(scanned(spark, tmp_path, 1 << 30))


@pytest.mark.parametrize("split", (1, 2, 7))
def test_ranges_may_end_anywhere(spark, tmp_path, split):
    (tmp_path / "a b%20.json").write_text(json.dumps({"type": '"', "features": hard(3, 7)}), encoding="utf-8")
    assert rows(scanned(spark, tmp_path, split)) == rows(scanned(spark, tmp_path, 1 << 30))


def test_one_document_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "document.json").write_text(json.dumps({"type": "t", "features": hard(20_000, 8)}))
    size = (tmp_path / "document.json").stat().st_size
    documents = scanned(spark, tmp_path, size // 8)
    sizes = documents.selectExpr("spark_partition_id() AS task", "length(value) AS n").collect()
    assert len(sizes) in (8, 9) and len({row["task"] for row in sizes}) > 2
    assert max(row["n"] for row in sizes) < size / 4
    assert rows(documents) == rows(scanned(spark, tmp_path, 1 << 30))


def test_no_files(spark):
    files = spark.createDataFrame([], "path STRING, length LONG")
    assert split_documents(files).isEmpty()
