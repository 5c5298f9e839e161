"""Text column functions: ZIP normalisation, money parsing, display format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from precinct.functions._cols import as_col


def zip5(col: Column | str) -> Column:
    """First five characters of a ZIP or ZIP+4 as an int; NULL if not numeric.

    Accepts text or numbers; ``try_cast`` keeps ANSI mode from failing the job
    on a malformed code.
    """
    return F.substring(as_col(col).cast("string"), 1, 5).try_cast("int")


def parse_money(col: Column | str) -> Column:
    """``"$33,887"`` / ``"33887.5"`` / a number → double; NULL when not a number.

    Ordering must be numeric: as text, ``$9,887`` sorts above ``$110,887``.
    """
    text = F.regexp_replace(as_col(col).cast("string"), r"[$,\s]", "")
    return text.try_cast("double")


def format_fixed(col: Column | str, decimals: int = 4) -> Column:
    """Display form: thousands separators and a fixed number of decimals.

    The value is rounded first, so the text never depends on the formatter's
    own tie rule; keep it at the edge of a report, numbers inside.
    """
    return F.format_number(F.round(as_col(col), decimals), decimals)
