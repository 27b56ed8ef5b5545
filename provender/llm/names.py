"""Names for helper columns."""

from __future__ import annotations

from collections.abc import Sequence


def spare(columns: Sequence[str], wish: str) -> str:
    """A name that none of the columns has, in any case."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish += "_"
    return wish
