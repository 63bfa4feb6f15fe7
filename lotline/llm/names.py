"""Names of columns that operators add beside a table's own."""

from __future__ import annotations

from collections.abc import Iterable


def spare(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores behind it until no column is called so (whatever the case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
