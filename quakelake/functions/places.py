"""The area named in a place text, in two dialects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: what counts as an area in each dialect.
STRICT_AREA = r"\bof\s+([A-Za-z\s,]+)$"
LOOSE_AREA = r"(?dU)of\s+(.*)"
_TRAILING_SPACE = r"(?U)\s+$"


def strict_area(place: Column) -> Column:
    """Letters, blanks and commas after the word "of", up to the end; empty text without a match."""
    return F.regexp_extract(place, STRICT_AREA, 1)


def loose_area(place: Column) -> Column:
    """The rest of the line after the first "of" and blanks, stripped; null without a match.

    An empty extract can be a real match, so the match itself is tested.
    """
    rest = F.regexp_replace(F.regexp_extract(place, LOOSE_AREA, 1), _TRAILING_SPACE, "")
    return F.when(place.rlike(LOOSE_AREA), rest)
