"""Names for helper columns that no column of the input has."""

from __future__ import annotations

from collections.abc import Iterable


def free(columns: Iterable[str], name: str) -> str:
    """``name``, with as many underscores in front as it takes to be new (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
