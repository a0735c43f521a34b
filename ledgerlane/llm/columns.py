"""Small helpers for long column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain reference inside a lambda may be replaced by its expression and then computed again for
    every element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_rows(docs, name: str = "__row") -> Column:
    """All columns of ``docs`` as one struct, so that further columns cannot clash with them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias(name)


BLOCK = 64


def blocks(items: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` elements; ``items`` must be cheap or bound by ``let``."""
    some = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda b: F.slice(items, b * BLOCK + 1, BLOCK))
    return F.when(F.size(items) > 0, some).otherwise(F.array(items))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def running(numbers: Column) -> Column:
    """For every int of an array, the sum of those before it. Goes by blocks, as growing an array
    inside ``aggregate`` copies it at each step."""

    def within(parts: Column) -> Column:
        return let(F.transform(parts, _total), lambda sums: F.flatten(F.transform(parts, lambda part, b: let(
            _total(F.slice(sums, F.lit(1), b)), lambda base: F.transform(part, lambda _, i: base + _total(F.slice(part, F.lit(1), i)))))))

    return let(let(numbers, blocks), within)
