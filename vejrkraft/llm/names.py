"""Column names of an operator's own, kept apart from those of the caller's table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def shield(docs: DataFrame, *reserved: str) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns called like a reserved name (in any case) renamed, the names that its columns have now, and a function
    that gives a result of those columns the caller's names again."""
    own = {r.lower() for r in reserved}
    taken = own | {c.lower() for c in docs.columns}
    now = {}
    for c in docs.columns:
        new = c
        while new.lower() in own or (new != c and new.lower() in taken):
            new += "_"
        taken.add(new.lower())
        now[c] = new
    renamed = {c: new for c, new in now.items() if c != new}
    back = {new: c for c, new in renamed.items()}
    hidden = docs.withColumnsRenamed(renamed) if renamed else docs
    return hidden, now, lambda df: df.withColumnsRenamed(back) if back else df
