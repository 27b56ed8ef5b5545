"""Text rules on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace a trim removes.
BLANKS = " \t\n\r\f\v\u00a0\u2028\u2029\ufeff"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def is_blank(c: Column) -> Column:
    """True for null and for text that is only whitespace."""
    return F.coalesce(strip(c) == "", F.lit(True))


def nonblank(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def nonempty(c: Column) -> Column:
    """Null for the empty string; text of blanks is kept."""
    return F.nullif(c, F.lit(""))


def clean_cell(c: Column) -> Column:
    """Trim, unwrap ``="value"`` and drop one leading apostrophe.

    Few cells are wrapped, so the pattern runs only on those that start like it.
    """
    text = strip(c)
    inner = F.regexp_replace(text, r'^=\s*"([^"]*)"\s*$', "$1")
    unwrapped = F.when(text.startswith("="), inner).otherwise(text)
    return F.when(unwrapped.startswith("'"), F.substring(unwrapped, F.lit(2), F.length(unwrapped))).otherwise(unwrapped)


def leading_int(c: Column) -> Column:
    """The integer a text starts with, else null.

    The pattern comes first: a cast that fails is far slower than a pattern
    that does not match, because it raises inside.
    """
    digits = F.regexp_extract(c.cast("string"), r"^\s*([+-]?[0-9]+)", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def int_or_zero(c: Column) -> Column:
    return F.coalesce(leading_int(c), F.lit(0).cast("bigint"))


def drop_first_comma(c: Column) -> Column:
    return F.regexp_replace(c, r"^([^,]*),", "$1")


def drop_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def drop_first_remark(c: Column) -> Column:
    """Remove the first bracketed remark and nothing else."""
    return F.regexp_replace(c, r"(?s)^(.*?)\(.+?\)", "$1")


def join_present(sep: str, cols: Sequence[Column]) -> Column:
    """Join the values that are neither null nor empty."""
    return F.concat_ws(sep, *[nonempty(c) for c in cols])


def present(*texts: Column) -> Column:
    """Array of the distinct texts that are not null, in order.

    ``array_compact`` would do, but it is a higher-order function, and Spark
    runs the whole expression under one without generated code.
    """
    return F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))


def dollar(text: str) -> str:
    """A column name quoted for use in ``F.col``."""
    return "`" + text.replace("`", "``") + "`"


def named(name: str) -> Column:
    return F.col(dollar(name))
