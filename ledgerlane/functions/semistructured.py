"""Paths into variant columns: ``at(v, '$.weather[0].main', 'string')``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import as_column


def parse(text) -> Column:
    return F.parse_json(as_column(text))


def at(variant, path: str, data_type: str) -> Column:
    """Value at ``path`` cast to ``data_type``; NULL when the path is missing."""
    return F.variant_get(as_column(variant), path, data_type)


def try_at(variant, path: str, data_type: str) -> Column:
    """Like ``at`` but NULL instead of an error when the value does not fit the type."""
    return F.try_variant_get(as_column(variant), path, data_type)
