"""Numeric expressions: tolerant casts, flags, distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres.
EARTH_RADIUS = 6_371_000


def to_int(c: Column) -> Column:
    """Integer of a text or number; null if it is none."""
    return c.try_cast("bigint")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def flag(c: Column) -> Column:
    """1 or 0 of a boolean, null stays null."""
    return c.cast("int")


def flag_or_zero(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0))


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in whole metres, truncated."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return (2 * EARTH_RADIUS * F.atan2(F.sqrt(h), F.sqrt(1 - h))).cast("int")


def walking_minutes(metres: Column) -> Column:
    """At 80 m a minute, half-even rounded, at least 1."""
    return F.greatest(F.lit(1), F.bround(metres / 80).cast("int"))
