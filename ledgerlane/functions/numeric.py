"""Rounding, percentages and distances as native column expressions.

Percentages follow one rule everywhere: exact decimal operands, one division in double,
six fraction digits kept as a decimal, and only then the rounding the caller wants. The
result is the same on every engine that follows IEEE arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0
ZERO_CELSIUS_IN_KELVIN = 273.15
EXACT = "decimal(28,6)"


def as_column(value) -> Column:
    """A column name, a column, or any other value as a literal."""
    if isinstance(value, str):
        return F.col(value)
    return value if isinstance(value, Column) else F.lit(value)


def guarded_ratio(numerator, denominator) -> Column:
    """numerator / denominator as double, NULL when the denominator is zero."""
    den = as_column(denominator).cast("double")
    return as_column(numerator).cast("double") / F.nullif(den, F.lit(0.0))


def share_exact(part, whole) -> Column:
    """Percentage of ``part`` in ``whole`` with six fraction digits, not yet rounded."""
    den = as_column(whole).cast("double")
    return (as_column(part).cast("double") * 100 / F.nullif(den, F.lit(0.0))).cast(EXACT)


def percent(part, whole, places: int = 2) -> Column:
    return F.round(share_exact(part, whole), places)


def round_to(value, places: int = 2) -> Column:
    """Half-away-from-zero rounding of any number through an exact decimal."""
    return F.round(as_column(value).cast(EXACT), places)


def mean_of(total, count, places: int = 2) -> Column:
    """Rounded mean from an exact sum and a count (kept exact until the one division)."""
    return F.round(guarded_ratio(total, count).cast(EXACT), places)


def kelvin_to_celsius(value) -> Column:
    return as_column(value).cast("double") - F.lit(ZERO_CELSIUS_IN_KELVIN)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in kilometres."""
    phi1, phi2 = F.radians(as_column(lat1)), F.radians(as_column(lat2))
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (F.radians(as_column(lon2)) - F.radians(as_column(lon1))) / 2
    chord = F.sin(half_dphi) * F.sin(half_dphi) + F.cos(phi1) * F.cos(phi2) * F.sin(half_dlambda) * F.sin(half_dlambda)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
