"""Walks over the arrays of one row whose time grows with their length, not its square.

An ``aggregate`` copies its state at every step, so it must never gather an array as long
as its input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values that are walked one by one before their result is put away.
BLOCK = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, add: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each of an array of whole numbers what ``add`` makes of all before it, from ``zero`` on.

    ``add`` is associative. Blocks are walked on their own, then their totals, which are
    few, then each block is moved on by what lies before it.
    """
    start = F.lit(zero).cast("bigint")

    def walk(part: Column) -> Column:
        """One short array: what lies before each value, and the total at the end."""
        return F.aggregate(part, F.array(start), lambda seen, v: F.array_append(seen, add(F.element_at(seen, -1), v.cast("bigint"))))

    def whole(all_values: Column) -> Column:
        last = F.floor((F.size(all_values) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: walk(F.slice(all_values, b * BLOCK + 1, F.lit(BLOCK))))
        moved = lambda found: F.zip_with(
            found, walk(F.transform(found, lambda w: F.element_at(w, -1))),
            lambda w, before: F.transform(F.slice(w, 1, F.size(w) - 1), lambda v: add(before, v)))
        return F.flatten(F.filter(bound(blocks, moved), lambda w: w.isNotNull()))

    return bound(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(F.array().cast("array<bigint>")))


def next_to(values: Column, past: Column) -> Column:
    """The following value of each, ``past`` for the last."""
    return F.when(F.size(values) > 0, F.concat(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), F.array(past))).otherwise(values)


def run_ends(kinds: Column) -> Column:
    """For each run of equal neighbours the number of values up to its end."""
    return bound(kinds, lambda k: F.filter(
        F.transform(F.zip_with(k, next_to(k, F.lit(None)), lambda a, b: a.eqNullSafe(b)), lambda same, i: F.when(~same, i + 1)),
        lambda i: i.isNotNull()))


def over_runs(ends: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use(first, size)`` for each run, places from 0."""
    return bound(ends, lambda e: F.zip_with(
        F.when(F.size(e) > 0, F.concat(F.array(F.lit(0)), F.slice(e, 1, F.size(e) - 1))).otherwise(e), e, lambda a, b: use(a, b - a)))
