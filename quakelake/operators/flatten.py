"""Plain flatten: one row per feature, thirty named columns, text times, and the area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakelake.functions.places import strict_area
from quakelake.functions.times import millis_to_text
from quakelake.operators.checked import explode_raw_features, lost_fields, outcomes, typed_fields, with_raw
from quakelake.schema import PLAIN_FIELDS

_NAMES = [name for name, _, _ in PLAIN_FIELDS]


def explode_features(lines: DataFrame) -> DataFrame:
    """One row per feature of documents that can be read; see ``explode_raw_features``."""
    return explode_raw_features(lines)


def flattened(features: DataFrame) -> DataFrame:
    """Every feature with the thirty flat columns, ``raw``, ``reason`` and ``lost``.

    Only what is no feature at all has a ``reason``: an element that is no object, a document that
    cannot be read. A coordinate or key that is not there reads as null; a value that does not fit
    its column does so too, and is named in ``lost``.
    """
    rules = list(PLAIN_FIELDS)
    typed = typed_fields(features, rules)
    is_object = F.coalesce(F.schema_of_variant("feature").startswith("OBJECT"), F.lit(False))
    # Only an object has a type, so only features without one have their kind looked up.
    no_feature = F.when(F.col("feature_type").isNull(), F.when(~is_object, F.lit("feature is not an object")))
    reason = F.coalesce(F.col("problem"), no_feature)
    checked = typed.select(*_NAMES, "feature", "raw", reason.alias("reason"), lost_fields(rules).alias("lost"))
    return with_raw(checked, _NAMES)


def flatten_features(features: DataFrame) -> DataFrame:
    """The thirty flat columns of all that is a feature."""
    return flattened(features).where(F.col("reason").isNull()).select(*_NAMES)


def with_text_times(flat: DataFrame) -> DataFrame:
    """Replace the epoch columns by text."""
    return flat.withColumns({name: millis_to_text(F.col(name)) for name in ("time", "updated")})


def with_area(flat: DataFrame) -> DataFrame:
    return flat.withColumn("area", strict_area(F.col("place")).cast("string"))


def plain_silver(lines: DataFrame) -> DataFrame:
    """Document texts to silver: 31 columns."""
    return with_area(with_text_times(flatten_features(explode_features(lines))))


def plain_outcomes(lines: DataFrame) -> DataFrame:
    """Silver rows with ``outcome`` kept, and beside them what was rejected or lost, in one pass."""
    rows = with_area(with_text_times(flattened(explode_features(lines))))
    return outcomes(rows.select(*_NAMES, "area", "raw", "reason", "lost"))
