"""Typing, cleaning and null rules over resolved incident rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provender.functions.dates import parse_moment
from provender.functions.text import named, nonblank
from provender.functions.typing import as_kind, spark_type
from provender.registry import (
    BLEED_COLUMNS, CREATED_AT, INCIDENT_DATE, INCIDENT_DATE_FALLBACKS, UPDATED_AT, Registry,
)


def scrub_date_bleed(df: DataFrame, columns: tuple[str, ...] = BLEED_COLUMNS, created: str = CREATED_AT) -> DataFrame:
    """Clear text that is only a stray copy of the row's creation date."""
    present = [c for c in columns if c in df.columns]
    if created not in df.columns or not present:
        return df
    moment = parse_moment(named(created))

    def scrubbed(name: str) -> Column:
        stray = F.coalesce(parse_moment(nonblank(named(name))) == moment, F.lit(False))
        return F.when(~stray, named(name)).alias(name)

    return df.select(*[scrubbed(c) if c in present else named(c) for c in df.columns])


def type_rows(df: DataFrame, registry: Registry, legacy_yes_no: bool = False) -> DataFrame:
    """Type every active column; a column the input lacks is null."""
    have = set(df.columns)
    return df.select(*[
        (as_kind(named(s.name), s.kind, legacy_yes_no) if s.name in have
         else F.lit(None).cast(spark_type(s.kind))).alias(s.name)
        for s in registry.active()
    ])


def fill_not_null(df: DataFrame, registry: Registry) -> DataFrame:
    """Defaults for required columns: false, 0, or a date that stands in.

    Required text stays null here and becomes ``""`` when a row is inserted.
    """
    have = set(df.columns)
    created = named(CREATED_AT) if CREATED_AT in have else F.lit(None).cast("date")

    def filled(name: str, kind: str) -> Column:
        value = named(name)
        if kind == "BIT":
            return F.coalesce(value, F.lit(False))
        if "DECIMAL" in kind:
            return F.coalesce(value, F.lit(0).cast(spark_type(kind)))
        if kind == "DATE" and name == INCIDENT_DATE:
            return F.coalesce(value, *[named(c) for c in INCIDENT_DATE_FALLBACKS if c in have], created)
        if kind == "DATE" and name != CREATED_AT:
            return F.coalesce(value, created)
        return value

    specs = {s.name: s for s in registry.active()}
    return df.select(*[
        filled(c, specs[c].kind.upper()).alias(c) if c in specs and not specs[c].nullable else named(c)
        for c in df.columns
    ])


def conform(df: DataFrame, registry: Registry, legacy_yes_no: bool = False) -> DataFrame:
    """Resolved text rows to typed rows ready for the merge."""
    return fill_not_null(type_rows(scrub_date_bleed(df), registry, legacy_yes_no), registry)


def export_text(df: DataFrame, registry: Registry) -> DataFrame:
    """Typed rows as export text: ISO days, 1/0 flags, blank for null, sorted columns.

    Every known column is written; one outside the whitelist can hold nothing
    but its required-column default.
    """
    have = set(df.columns)

    def text(name: str, kind: str, required: bool) -> Column:
        if name in have:
            value = named(name)
        elif required and kind == "BIT":
            value = F.lit(False)
        elif required and "DECIMAL" in kind:
            value = F.lit(0)
        elif required and kind == "DATE" and CREATED_AT in have:
            value = named(CREATED_AT)
        else:
            value = F.lit(None)
        if kind == "BIT":
            value = value.cast("int")
        elif "DATE" in kind:
            value = F.date_format(value, "yyyy-MM-dd")
        return F.coalesce(value.cast("string"), F.lit("")).alias(name)

    specs = sorted(registry.unique(), key=lambda s: s.name)
    return df.select(*[text(s.name, s.kind.upper(), not s.nullable) for s in specs])
