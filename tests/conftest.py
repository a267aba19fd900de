import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quakelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Texts or objects as document lines."""

    def make(*documents):
        texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
        return spark.createDataFrame([(t,) for t in texts], "value STRING")

    return make


@pytest.fixture
def feature():
    """A complete feature; ``without`` drops properties, keywords replace them."""

    def make(without=(), id_="ev1", coordinates=(10.5, -20.25, 7.0), **changes):
        properties = {
            "mag": 4.5,
            "place": "10 km SSW of Ojai, CA",
            "time": 1729555199999,
            "updated": 1729555200000,
            "tz": None,
            "url": "https://example.org/1",
            "detail": "https://example.org/1.geojson",
            "felt": 3,
            "cdi": 2.5,
            "mmi": None,
            "alert": None,
            "status": "reviewed",
            "tsunami": 0,
            "sig": 312,
            "net": "us",
            "code": "1",
            "ids": ",ev1,",
            "sources": ",us,",
            "types": ",origin,",
            "nst": 12,
            "dmin": 0.5,
            "rms": 0.25,
            "gap": 90.0,
            "magType": "ml",
            "type": "earthquake",
            "title": "M 4.5",
        }
        properties |= changes
        for name in without:
            properties.pop(name, None)
        made = {
            "type": "Feature",
            "properties": properties,
            "geometry": {"type": "Point", "coordinates": list(coordinates)},
            "id": id_,
        }
        if "id" in without:
            del made["id"]
        return made

    return make


def collection(*features):
    return {"type": "FeatureCollection", "features": list(features)}


@pytest.fixture(name="collection")
def collection_fixture():
    return collection
