from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unused(name: str, *columns: list[str]) -> str:
    """``name``, with as many underscores behind as it takes to differ from all
    ``columns`` in whatever case."""
    taken = {c.lower() for names in columns for c in names}
    while name.lower() in taken:
        name += "_"
    return name
