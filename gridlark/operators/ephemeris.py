"""Positions and local time without kernels: a spherical body and analytic directions.

Directions of bodies outside are a pluggable function of ephemeris seconds; the
built-in mean solar longitude is good to about a degree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.functions.units import norm, wrap
from gridlark.schema import MOON_RADIUS_KM, Body


def surface_point(lat: Column, lon: Column, radius: Column | float = MOON_RADIUS_KM) -> tuple[Column, Column, Column]:
    """Body-fixed position of a surface point (or, with a larger radius, of a point above it)."""
    phi, lam, r = F.radians(lat), F.radians(lon), F.lit(radius)
    return r * F.cos(phi) * F.cos(lam), r * F.cos(phi) * F.sin(lam), r * F.sin(phi)


def subsolar_longitude(et: Column, body: Body = Body(), at_epoch: float = 0.0) -> Column:
    """Mean subsolar longitude in degrees: it goes west once a synodic day."""
    return wrap(F.lit(at_epoch) - F.pmod(et / body.day, F.lit(1.0)) * 360.0, -180.0, 360.0)


def local_solar_time(lon: Column, sun_lon: Column) -> Column:
    """Day fraction in [0, 1): noon where the Sun is overhead."""
    return F.pmod((lon - sun_lon) / 360.0 + 0.5, F.lit(1.0))


def with_vectors(df: DataFrame, radius: float = MOON_RADIUS_KM, sun: Callable[[Column], Column] = subsolar_longitude) -> DataFrame:
    """df (lat, lon, d, et) with the surface point s*, unit normal n*, orbiter position b*, and local time."""
    lat, lon = F.col("lat").cast("double"), F.col("lon").cast("double")
    s = surface_point(lat, lon, radius)
    b = surface_point(lat, lon, F.lit(radius) + F.col("d").cast("double"))
    made = {f"s{a}": v for a, v in zip("xyz", s)} | {f"n{a}": v / radius for a, v in zip("xyz", s)} | {f"b{a}": v for a, v in zip("xyz", b)}
    return df.withColumns(made | {"ltst": local_solar_time(lon, sun(F.col("et")))})


def height_error(df: DataFrame) -> DataFrame:
    """Largest difference between the surface-to-orbiter distance and d: a check of the vectors."""
    gap = norm(F.col("bx") - F.col("sx"), F.col("by") - F.col("sy"), F.col("bz") - F.col("sz"))
    return df.agg(F.max(F.abs(gap - F.col("d"))).alias("max_error"))
