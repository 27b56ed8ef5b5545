"""Date rules on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from provender.functions.text import strip

# The date shapes that incident files use, in the order they are
# tried. A value takes the first shape it fits, so one parse per value is enough.
DATE_SHAPES = (
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2} \d{4}$", "MMMM d yyyy"),
    (r"^[A-Za-z]{3,9} \d{1,2}, \d{4} \d{1,2}:\d{2}(am|pm|AM|PM)$", "MMMM d, yyyy h:mma"),
    (r"^[A-Za-z]{3,9} \d{1,2} \d{4} \d{1,2}:\d{2}(am|pm|AM|PM)$", "MMMM d yyyy h:mma"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} (am|pm|AM|PM)$", "M/d/yyyy h:mm a"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} (am|pm|AM|PM)$", "M/d/yyyy h:mm:ss a"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4} \d{1,2}:\d{2}$", "MMM d, yyyy H:mm"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4} \d{1,2}:\d{2} (am|pm|AM|PM)$", "MMM d, yyyy h:mm a"),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4} \d{1,2}:\d{2} (am|pm|AM|PM)$", "MMMM d, yyyy h:mm a"),
)
# Year first, then as much as there is: month, day, hour, minute, second.
FREE_SHAPE = r"^(\d{4})[-/]?(\d{1,2})?[-/]?(\d{0,2})[Tt\s]*(\d{1,2})?:?(\d{1,2})?:?(\d{1,2})?(?:[.:]\d+)?$"
ISO_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:"
PLACEHOLDER_YEAR = 1900


def parse_moment(c: Column) -> Column:
    """Timestamp of a text in one of the known shapes or ISO form, else null.

    The shape test comes first, so a failing parse (slow: it raises inside the
    parser) happens only for values that look right and are not.
    """
    text = strip(c)
    free = free_moment(text)
    out = None
    for shape, pattern in DATE_SHAPES:
        value = F.upper(text) if pattern.endswith("a") else text
        if pattern.endswith("a"):
            value = F.concat(F.initcap(F.substring_index(text, " ", 1)), F.lit(" "),
                             F.upper(F.substring(text, F.instr(text, " ") + 1, F.lit(40))))
        parsed = F.try_to_timestamp(value, F.lit(pattern))
        out = F.when(text.rlike(shape), parsed) if out is None else out.when(text.rlike(shape), parsed)
    return out.when(text.rlike(FREE_SHAPE), free).when(text.rlike(ISO_SHAPE), text.try_cast("timestamp"))


def free_moment(text: Column) -> Column:
    """Timestamp of a year-first text; missing parts are the first; null for a day that no month has."""
    def part(i: int, missing: int) -> Column:
        found = F.regexp_extract(text, FREE_SHAPE, i)
        return F.when(found == "", missing).otherwise(found.cast("int"))

    month = F.add_months(F.make_date(part(1, 1), F.lit(1), F.lit(1)), part(2, 1) - 1)
    seconds = part(4, 0) * 3600 + part(5, 0) * 60 + part(6, 0)
    day = F.date_add(month, part(3, 1) - 1)
    real = (F.month(day) == part(2, 1)) & (F.dayofmonth(day) == part(3, 1)) & (part(4, 0) < 24) & (part(5, 0) < 60) & (part(6, 0) < 60)
    return F.when(text.rlike(FREE_SHAPE) & real, F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + seconds))


def parse_day(c: Column) -> Column:
    return parse_moment(c).cast("date")


def iso_day(c: Column) -> Column:
    """The leading ``YYYY-MM-DD`` of a text, else the day of its parsed moment."""
    head = F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.when(head != "", head).otherwise(F.date_format(parse_moment(c), "yyyy-MM-dd"))


def is_placeholder(c: Column) -> Column:
    """A badly extracted date shows up in the year 1900."""
    return F.coalesce(F.year(c) == PLACEHOLDER_YEAR, F.lit(False))


def is_active(expires: Column, as_of: Column) -> Column:
    return F.coalesce(expires > as_of, F.lit(False)) | is_placeholder(expires)


def earliest(*cols: Column) -> Column:
    """The earliest date that is present; null only if all are missing."""
    return F.least(*cols) if len(cols) > 1 else cols[0]
