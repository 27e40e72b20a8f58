"""Units, angles, clipping and wrapping."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlark.schema import MOON_RADIUS_KM


def db_to_power(x: Column) -> Column:
    return F.pow(F.lit(10.0), x / 10)


def power_to_db(x: Column) -> Column:
    return F.log10(x) * 10


def clip(x: Column, lo: float | Column, hi: float | Column) -> Column:
    """x within [lo, hi]; null and NaN stay null."""
    held = F.when(~F.isnan(x.cast("double")), x)
    return F.when(held.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), held)))


def wrap(x: Column, lo: float, period: float) -> Column:
    """x moved by whole periods into [lo, lo + period)."""
    return F.pmod(x - lo, F.lit(period)) + lo


def lat_model(lat: Column, a: Column | float, b: Column | float) -> Column:
    """a * cos(lat) ** b, with lat in degrees."""
    return F.lit(a) * F.pow(F.cos(F.radians(lat)), F.lit(b))


def slope_time_shift(slope: Column, azimuth: Column, most: float = 1.5) -> Column:
    """Hours by which an east-west slope moves local time, at most `most` either way."""
    return clip(slope * F.sin(F.radians(azimuth)) * 24 / 360, -most, most)


def hapke_to_albedo(x: Column) -> Column:
    return x * x * -18.0 + x * 3.39 + 0.00427


def rotate_hours(h: Column, by: float = 12.0) -> Column:
    return F.pmod(h + by, F.lit(24.0))


def metres_per_pixel(ppd: Column | int) -> Column:
    return F.lit(MOON_RADIUS_KM * 2 * math.pi / 360 * 1000) / F.lit(ppd)


def upper_left(bound: Column, mpp: Column) -> Column:
    """Map coordinate in metres of a corner given in degrees, half a pixel inside."""
    return bound * F.lit(MOON_RADIUS_KM * 2 * math.pi / 360 * 1000) + mpp / 2


def norm(x: Column, y: Column, z: Column) -> Column:
    return F.sqrt(x * x + y * y + z * z)


def spread(*columns: Column) -> Column:
    """Largest minus smallest; null if any is null or NaN."""
    whole = None
    for c in columns:
        ok = c.isNotNull() & ~F.isnan(c.cast("double"))
        whole = ok if whole is None else whole & ok
    return F.when(whole, F.greatest(*columns) - F.least(*columns))


def layer_albedo(albedo: Column, incidence: Column, c0: float, c1: float) -> Column:
    """Albedo at an incidence angle in radians."""
    return albedo + c0 * F.pow(incidence / math.pi * 4, F.lit(3)) + c1 * F.pow(incidence / math.pi * 2, F.lit(8))
