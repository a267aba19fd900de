"""Rule-checked flatten: the strict form fails on a bad feature, the tolerant form sets it aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakelake.functions.places import loose_area
from quakelake.functions.times import millis_to_text_or_raw
from quakelake.schema import DOCUMENT, FIELDS, REJECTS, TOLERANT_FIRST, Rule

_FEATURE = "feature"
OUTCOME = "outcome"
KEPT = "kept"
REJECTED = "rejected"
LOST = "lost"


def explode_raw_features(lines: DataFrame, value: str = "value") -> DataFrame:
    """Document texts to one row per feature: ``feature`` as variant, ``document_type``, ``raw`` and ``problem``.

    Every document is parsed once, by one path, whatever its size: read as the only element of an
    array, so that text before or after it makes it unreadable. Of a repeated key the last value
    counts. A document that cannot be read, or has no array of features, gives one row with its
    whole text as ``raw`` and the problem.
    """
    read = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), f"ARRAY<{DOCUMENT}>")
    documents = lines.select(F.col(value).alias("text"), read.alias("read"))
    document = F.get("read", F.lit(0))

    def row(feature: Column | None = None, problem: str | None = None) -> Column:
        nothing = F.lit(None)
        return F.struct(
            (nothing if feature is None else document["type"]).cast("string").alias("document_type"),
            (nothing if problem is None else F.col("text")).cast("string").alias("raw"),
            (nothing if feature is None else feature).cast("variant").alias(_FEATURE),
            F.lit(problem).cast("string").alias("problem"),
        )

    readable = F.coalesce(F.size("read") == 1, F.lit(False))
    # Parsing below or inside the generator keeps later filters from repeating the parse.
    rows = (
        F.when(~readable, F.array(row(problem="unreadable document")))
        .when(document["features"].isNull(), F.array(row(problem="no feature array")))
        .otherwise(F.transform(document["features"], lambda feature: row(feature=feature)))
    )
    return documents.select(F.inline(rows))


def _node(path: str) -> Column:
    """The value at ``path``: SQL null when the key is missing, a variant null for JSON null."""
    return F.try_variant_get(_FEATURE, path, "variant")


def _filled(name: str, path: str, rule: Rule) -> Column:
    """The typed value with its default put in."""
    value = F.col(name)
    if rule.default is None:
        return value
    default = F.lit(rule.default).cast(rule.type)
    if rule.null_too:
        return F.coalesce(value, default)
    return F.when(value.isNull() & _node(path).isNull(), default).otherwise(value)


def _complaint(name: str, path: str, rule: Rule) -> Column:
    """Why the field breaks its rule, or null. Only a null value needs a look at the JSON."""
    node = _node(path)
    why = F.when(node.isNull(), F.lit(f"missing {name}" if rule.need != "optional" else None))
    why = why.when(F.is_variant_null(node), F.lit(f"null {name}" if rule.need == "value" else None))
    return F.when(F.col(name).isNull(), why.otherwise(F.lit(None if rule.kept else f"bad {name}")))


def _not_object(path: str, required: str, message: str) -> Column:
    """``message`` when no object is at ``path``; ``required`` is a field that must be inside it."""
    is_object = F.coalesce(F.schema_of_variant(_node(path)).startswith("OBJECT"), F.lit(False))
    return F.when(F.when(F.col(required).isNull(), ~is_object), message)


# What integers of each type hold; doubles between these bounds turn into them unharmed.
_WHOLE = {"int": (-(2.0**31), 2.0**31 - 1), "bigint": (-(2.0**63), 2.0**63 - 1024)}


def _read_type(rule: Rule) -> str:
    return "double" if rule.type in _WHOLE and not rule.cut else rule.type


def _fitted(value: Column, rule: Rule) -> Column:
    """A value as read in its rule's type; a number with a fraction is no integer."""
    if rule.type not in _WHOLE or rule.cut:
        return value
    whole = value.between(*map(F.lit, _WHOLE[rule.type])) & (value == F.floor(value))
    return F.when(whole, value.cast(rule.type))


def typed_fields(features: DataFrame, rules: list[tuple[str, str, Rule]]) -> DataFrame:
    """Every field in its type, null where it is missing, null or of another kind.

    The properties are read as one struct, in one walk over the object instead of one search per
    field; a value that does not fit leaves only its own field null. Numeric text and whole
    decimals fit.
    """
    start = "$.properties."
    inside = {path.removeprefix(start): rule for _, path, rule in rules if path.startswith(start)}
    struct = ", ".join(f"`{key}`: {_read_type(rule)}" for key, rule in inside.items())
    others = {path: F.try_variant_get(_FEATURE, path, _read_type(rule)) for _, path, rule in rules if not path.startswith(start)}
    # Read first and converted above, so that no value is read more than once.
    parsed = features.select(
        _FEATURE,
        "raw",
        "problem",
        F.try_variant_get(_FEATURE, "$.properties", f"STRUCT<{struct}>").alias("properties"),
        *(value.alias(f"other{i}") for i, value in enumerate(others.values())),
    )
    place = {path: F.col(f"other{i}") for i, path in enumerate(others)}
    fields = [
        _fitted(place[path] if path in place else F.col("properties")[path.removeprefix(start)], rule).alias(name)
        for name, path, rule in rules
    ]
    return parsed.select(*fields, _FEATURE, "raw", "problem")


def lost_fields(rules: list[tuple[str, str, Rule]]) -> Column:
    """Names of fields that are kept as null though a value is there, or null."""
    kept = [(name, path) for name, path, rule in rules if rule.kept and rule.type != "string"]

    def lost(name: str, path: str) -> Column:
        # Nested, so that only a null value has its JSON looked up.
        node = _node(path)
        there = F.when(F.col(name).isNull(), F.when(node.isNotNull(), ~F.is_variant_null(node)))
        return F.when(there, F.lit(name))

    names = F.concat_ws(", ", *(lost(*field) for field in kept))
    return F.when(names != "", F.concat(F.lit("lost "), names))


def _checked(features: DataFrame, mode: str, wanted: Sequence[str] | None = None) -> DataFrame:
    """The wanted fields, all thirty by default, ``reason`` (the first broken rule in field order),
    ``lost``, and ``raw`` of features with either.

    Of a feature only the wanted fields and those that a rule checks are read. With fields named,
    ``lost`` is not looked for.
    """
    rules = [(f.name, f.path, getattr(f, mode)) for f in FIELDS]
    names = [f.name for f in FIELDS] if wanted is None else list(wanted)
    checks = [r for r in rules if r[2].need != "optional" or (r[2].type != "string" and not r[2].kept)]
    read = [r for r in rules if r in checks or r[0] in names]
    typed = typed_fields(features, read)
    reason = F.coalesce(
        F.col("problem"),
        _not_object("$", "id", "feature is not an object"),
        _not_object("$.properties", "status", "properties is not an object"),
        *[_complaint(*r) for r in checks],
    )
    rule_of = {r[0]: r for r in read}
    filled = [_filled(*rule_of[name]).alias(name) for name in names]
    look = mode == "tolerant" and wanted is None
    lost = lost_fields(rules) if look else F.lit(None).cast("string")
    checked = typed.select(*filled, _FEATURE, "raw", reason.alias("reason"), lost.alias("lost"))
    return with_raw(checked, names)


def with_raw(checked: DataFrame, columns: list[str]) -> DataFrame:
    """The columns, ``raw`` of features that are set aside or lose a value, ``reason`` and ``lost``."""
    raw = F.coalesce("raw", F.to_json(_FEATURE), F.lit("null"))
    recorded = F.col("reason").isNotNull() | F.col("lost").isNotNull()
    return checked.select(*columns, F.when(recorded, raw).alias("raw"), "reason", "lost")


def outcomes(checked: DataFrame) -> DataFrame:
    """Each feature as a kept or a rejected row, and a lost row beside a kept one that lost values.

    ``outcome`` tells which; ``raw`` and ``reason`` are set in rejected and lost rows, the other
    columns in kept rows.
    """
    columns = [name for name in checked.columns if name not in (*REJECTS.names, "lost")]
    empty = [F.lit(None).cast(checked.schema[name].dataType).alias(name) for name in columns]

    def row(outcome: str, values: list, reason: Column) -> Column:
        record = F.lit(None).cast("string") if outcome == KEPT else F.col("raw")
        return F.struct(
            *values, record.alias("raw"), reason.cast("string").alias("reason"), F.lit(outcome).alias(OUTCOME)
        )

    kept, lost = row(KEPT, columns, F.lit(None)), row(LOST, empty, F.col("lost"))
    rows = (
        F.when(F.col("reason").isNotNull(), F.array(row(REJECTED, empty, F.col("reason"))))
        .when(F.col("lost").isNotNull(), F.array(kept, lost))
        .otherwise(F.array(kept))
    )
    return checked.select(F.inline(rows))


def _rows_where(checked: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """Filter and select. As a generator, because a plain filter is pushed below the projection
    that reads the fields, and then reads them all a second time."""
    return checked.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def strict_rows(features: DataFrame) -> DataFrame:
    """The thirty typed fields; the job fails on the first feature that breaks a rule."""
    failure = F.raise_error(F.concat_ws(": ", "id", "reason")).cast("boolean")
    passes = F.when(F.col("reason").isNull(), True).otherwise(failure)
    return _rows_where(_checked(features, "strict"), passes, [f.name for f in FIELDS])


def checked_rows(features: DataFrame) -> DataFrame:
    """Every feature with its thirty tolerant fields.

    A reject also has its ``raw`` text and ``reason``; a feature kept without some value that does
    not fit has ``raw`` and ``lost``.
    """
    return _checked(features, "tolerant")


def tolerant_rows(features: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The thirty tolerant fields, or those named, of the features that pass."""
    passes = F.col("reason").isNull()
    names = [f.name for f in FIELDS] if columns is None else list(columns)
    return _rows_where(_checked(features, "tolerant", columns), passes, names)


def rejected_rows(features: DataFrame) -> DataFrame:
    """What ``tolerant_rows`` leaves out."""
    return _rows_where(checked_rows(features), F.col("reason").isNotNull(), REJECTS.names)


def lost_rows(features: DataFrame) -> DataFrame:
    """What ``tolerant_rows`` keeps as null: the feature's text and, as ``reason``, the fields."""
    found = F.col("reason").isNull() & F.col("lost").isNotNull()
    lost = _rows_where(checked_rows(features), found, ["raw", "lost"])
    return lost.withColumnRenamed("lost", "reason")


def with_derived(rows: DataFrame) -> DataFrame:
    """Text times and the loose area first, then every other column unchanged."""
    derived = [
        millis_to_text_or_raw(F.col("time")).alias("time"),
        millis_to_text_or_raw(F.col("updated")).alias("updated"),
        loose_area(F.col("place")).alias("area"),
    ]
    return rows.select(*derived, *[c for c in rows.columns if c not in TOLERANT_FIRST])
