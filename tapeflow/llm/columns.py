"""Given columns whose names an operator needs for its own."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(
    rows: DataFrame, run: Callable[[DataFrame], DataFrame], names: Iterable[str] = (), added: Iterable[str] = ()
) -> DataFrame:
    """``run(rows)``, while given columns with one of these names wait under free ones.

    After it a column that waited for one of ``names`` has its own name again; one that has the
    name of an ``added`` column gives way to it.  Names are equal whatever their case.
    """
    gone = {name.lower() for name in added}
    own = gone | {name.lower() for name in names}
    used = own | {c.lower() for c in rows.columns}
    waiting: dict[str, str] = {}
    for c in rows.columns:
        if c.lower() in own:
            free = f"given_{c.lower()}"
            while free in used:
                free += "_"
            used.add(free)
            waiting[free] = c
    if not waiting:
        return run(rows)
    done = run(rows.withColumnsRenamed({c: free for free, c in waiting.items()}))
    kept = [c for c in done.columns if waiting.get(c, "").lower() not in gone]
    return done.select(*[F.col(c).alias(waiting.get(c, c)) for c in kept])
