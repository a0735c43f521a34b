"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import as_column

NEWLINE = "\n"


def joined(*parts) -> Column:
    """Concatenation; NULL in any part gives NULL."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def last_chars(value, n: int) -> Column:
    return F.right(as_column(value), F.lit(n))


def label(value, names: dict[str, str]) -> Column:
    """Translate by a small fixed dictionary; unknown values stay as they are."""
    col = as_column(value)
    if not names:
        return col
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, col), col)
