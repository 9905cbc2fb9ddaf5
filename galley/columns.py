"""Names of columns that operators add to those they are given."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """`names`, each with as many underscores behind as it needs to differ from the columns `taken`."""
    taken, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
