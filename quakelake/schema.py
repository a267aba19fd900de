"""Nested feed schema, the plain column map, and the field rules of the two flat forms."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "double": DoubleType(),
    "bigint": LongType(),
    "int": IntegerType(),
}


def _struct(**fields: str | DataType) -> StructType:
    struct = StructType()
    for name, type_ in fields.items():
        struct = struct.add(name, _TYPES[type_] if isinstance(type_, str) else type_)
    return struct


# Property names and types of the feed, in feed order.
PROPERTIES = _struct(
    mag="double",
    place="string",
    time="bigint",
    updated="bigint",
    tz="int",
    url="string",
    detail="string",
    felt="int",
    cdi="double",
    mmi="double",
    alert="string",
    status="string",
    tsunami="int",
    sig="int",
    net="string",
    code="string",
    ids="string",
    sources="string",
    types="string",
    nst="int",
    dmin="double",
    rms="double",
    gap="double",
    magType="string",
    type="string",
    title="string",
)
# A document as it is read: every feature is a variant of its own, so neither the size of a document
# nor a fault in one feature bears on the others.
DOCUMENT = "STRUCT<type: STRING, features: ARRAY<VARIANT>>"

# Feed property -> plain silver column, in output order.
PLAIN_COLUMNS = {
    "mag": "magnitude",
    "place": "place",
    "time": "time",
    "updated": "updated",
    "tz": "timezone",
    "url": "event_url",
    "detail": "detail_url",
    "felt": "felt",
    "cdi": "cdi",
    "mmi": "mmi",
    "alert": "alert",
    "status": "status",
    "tsunami": "tsunami",
    "sig": "sig",
    "net": "net",
    "code": "code",
    "ids": "ids",
    "sources": "sources",
    "types": "type_properties",
    "nst": "nst",
    "dmin": "dmin",
    "rms": "rms",
    "gap": "gap",
    "magType": "magType",
    "type": "earthquake_type",
    "title": "earthquake_title",
}
PLAIN_COORDINATES = ("geometry_longitude", "geometry_latitude", "geometry_depth")


class Rule(NamedTuple):
    """How a field of a feature is read.

    ``key``: the key must exist, a null value is kept. ``value``: it must exist and not be null.
    ``optional``: a missing key reads as null. ``default`` replaces a missing key, and a null too
    when ``null_too``. A number of an integer type must be whole unless ``cut``, which drops its
    fraction. A value that does not fit sets the feature aside, or, where ``kept``, reads as null
    and is recorded as lost.
    """

    type: str
    need: str = "optional"
    default: object = None
    null_too: bool = True
    cut: bool = False
    kept: bool = False


class Field(NamedTuple):
    name: str
    path: str
    strict: Rule
    tolerant: Rule


def _optional(type_: str) -> Rule:
    return Rule(type_)


def _key(type_: str) -> Rule:
    return Rule(type_, need="key")


def _value(type_: str) -> Rule:
    return Rule(type_, need="value")


def _default(type_: str, default: object, null_too: bool = True, need: str = "optional") -> Rule:
    return Rule(type_, need, default, null_too)


# What each field of the strict and of the tolerant flat form requires.
_RULES = {
    "id": (_key("string"), _key("string")),
    "mag": (_value("double"), _default("double", 0.0)),
    "place": (_key("string"), _default("string", "Unknown", null_too=False)),
    "time": (_key("bigint"), _optional("string")),
    "updated": (_key("bigint"), _optional("string")),
    "url": (_key("string"), _optional("string")),
    "detail": (_optional("string"), _optional("string")),
    "felt": (_default("int", 0, null_too=False), _default("double", 0.0)),
    "cdi": (_default("double", 0.0), _default("double", 0.0)),
    "mmi": (_optional("double"), _optional("double")),
    "alert": (_optional("string"), _optional("string")),
    "status": (_key("string"), _key("string")),
    "tsunami": (_key("int"), Rule("int", need="value", cut=True)),
    "sig": (_key("int"), Rule("bigint", need="key", kept=True)),
    "net": (_key("string"), _key("string")),
    "code": (_key("string"), _key("string")),
    "ids": (_optional("string"), _optional("string")),
    "sources": (_optional("string"), _optional("string")),
    "types": (_optional("string"), _optional("string")),
    "nst": (_optional("int"), Rule("int", kept=True)),
    "dmin": (_default("double", 0.0), _default("double", 0.0)),
    "rms": (_value("double"), _default("double", 0.0)),
    "gap": (_default("double", 0.0), _default("double", 0.0)),
    "magType": (_key("string"), _key("string")),
    "type": (_key("string"), _key("string")),
    "title": (_key("string"), _key("string")),
    "tz": (_optional("int"), Rule("int", kept=True)),
    "longitude": (_value("double"), _default("double", 0.0, need="key")),
    "latitude": (_value("double"), _default("double", 0.0, need="key")),
    "depth": (_value("double"), _default("double", 0.0, need="key")),
}
_PATHS = {
    "id": "$.id",
    "longitude": "$.geometry.coordinates[0]",
    "latitude": "$.geometry.coordinates[1]",
    "depth": "$.geometry.coordinates[2]",
}
FIELDS = tuple(
    Field(name, _PATHS.get(name, f"$.properties.{name}"), strict, tolerant)
    for name, (strict, tolerant) in _RULES.items()
)

# The plain form: its columns in output order, each kept as null where its value does not fit.
PLAIN_FIELDS = (
    ("feature_type", "$.type", Rule("string", kept=True)),
    *(
        (name, f"$.properties.{source}", Rule(PROPERTIES[source].dataType.simpleString(), kept=True))
        for source, name in PLAIN_COLUMNS.items()
    ),
    *(
        (name, f"$.geometry.coordinates[{position}]", Rule("double", kept=True))
        for position, name in enumerate(PLAIN_COORDINATES)
    ),
)

# Tolerant silver: the derived columns come first, then the rest in field order.
TOLERANT_FIRST = ("time", "updated", "area")
TOLERANT_SILVER = _struct(
    **dict.fromkeys(TOLERANT_FIRST, "string"),
    **{f.name: f.tolerant.type for f in FIELDS if f.name not in TOLERANT_FIRST},
)
REJECTS = _struct(raw="string", reason="string")
