"""Typing of text cells into the column kinds of the registry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from provender.functions.dates import parse_day, parse_moment
from provender.functions.text import strip

# Words a text column treats as missing.
MISSING_WORDS = ("", "na", "n/a")
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def as_bit(c: Column, legacy_yes_no: bool = False) -> Column:
    """yes/no/true/false in any case; other text is null.

    ``legacy_yes_no`` reproduces the inverted reading of yes and no.
    """
    word = F.lower(c)
    yes, no = F.lit(not legacy_yes_no), F.lit(legacy_yes_no)
    return (F.when(word == "yes", yes).when(word == "no", no)
            .when(word == "true", F.lit(True)).when(word == "false", F.lit(False)))


def as_decimal(c: Column, scale: int) -> Column:
    """Number of a text; blank text counts as 0, a missing cell stays null."""
    kind = f"decimal(38,{scale})"
    text = strip(c)
    # The shape test keeps text that is no number away from the slow failing cast.
    return F.when(text == "", F.lit(0).cast(kind)).when(text.rlike(NUMBER), text.try_cast(kind))


def as_text(c: Column) -> Column:
    return F.when(~F.lower(c).isin(*MISSING_WORDS), c)


def as_kind(c: Column, kind: str, legacy_yes_no: bool = False) -> Column:
    """Type one text column by its registry kind."""
    upper = kind.upper()
    if upper == "BIT":
        return as_bit(c, legacy_yes_no)
    if upper.startswith("DECIMAL"):
        return as_decimal(c, scale_of(kind))
    if upper == "DATETIME":
        return parse_moment(c)
    if upper == "DATE":
        return parse_day(c)
    return as_text(c)


def scale_of(kind: str) -> int:
    inside = kind[kind.index("(") + 1:kind.index(")")] if "(" in kind else "38,0"
    return int(inside.split(",")[1]) if "," in inside else 0


def spark_type(kind: str) -> str:
    upper = kind.upper()
    if upper == "BIT":
        return "boolean"
    if upper.startswith("DECIMAL"):
        return f"decimal(38,{scale_of(kind)})"
    if upper == "DATETIME":
        return "timestamp"
    if upper == "DATE":
        return "date"
    return "string"
