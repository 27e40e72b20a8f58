"""Row predicates and membership joins."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.functions.units import norm
from gridlark.schema import CHANNELS, MapSpec


def valid_box(df: DataFrame, lon: float = 360.0, lat: float = 90.0, d: float = 999.9) -> DataFrame:
    """Rows whose position is no special constant: upper bounds only, so the scan can prune."""
    return df.where((F.col("lon") <= lon) & (F.col("lat") <= lat) & (F.col("d") <= d))


def between_half_open(c: Column, bounds: tuple[float, float]) -> Column:
    return (c >= bounds[0]) & (c < bounds[1])


def local_time(c: Column, bounds: tuple[float, float] | None) -> Column:
    """A day fraction within bounds; a negative lower bound wraps around midnight; None is always true."""
    if bounds is None:
        return F.lit(True)
    lo, hi = bounds
    if lo < 0:
        return between_half_open(c, (1 + lo, 1.0)) | between_half_open(c, (0.0, hi))
    return between_half_open(c, bounds)


def hours_closed(c: Column, lo: float, hi: float, last: float) -> Column:
    """Hours within a closed range that may wrap below 0 or above `last`, the last modelled hour."""
    if lo < 0 and hi > last:
        raise ValueError("the range covers more than a day")
    if lo < 0:
        return (c >= last + lo) | (c <= hi)
    if hi > last:
        return (c >= lo) | (c <= hi - last)
    return (c >= lo) & (c <= hi)


def unwrap_hours(c: Column, lo: float, hi: float, last: float) -> Column:
    """Hours of a wrapped range, moved by a day so that the range is one interval."""
    if lo < 0:
        return F.when(c >= lo + 24, c - 24).otherwise(c)
    if hi > last:
        return F.when(c <= hi - last, c + 24).otherwise(c)
    return c


def member(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is among keys (left semi). Spark broadcasts keys if their measured size allows."""
    return df.join(keys, on, "left_semi")


def not_member(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def load_slice(samples: DataFrame, spec: MapSpec) -> DataFrame:
    """The columns and rows that a map needs: all conditions are on scanned columns, so they are pushed down."""
    where = [
        F.col("orbiter") == spec.orbiter,
        between_half_open(F.col("lat"), spec.lat_bounds),
        between_half_open(F.col("lon"), spec.lon_bounds),
        local_time(F.col("ltst"), spec.ltst_bounds),
    ]
    if spec.unflagged and "flag" in samples.columns:
        where.append(F.col("flag") == 0)
    if spec.exclude_orbits:
        where.append(~F.col("orbit").isin(*spec.exclude_orbits))
    out = samples.where(reduce(lambda a, b: a & b, where))
    return out.select("d", "lat", "lon", "ltst", F.col(CHANNELS[spec.channel - 1]).alias("t"), "orbit").where(F.col("t").isNotNull())


def load_slices(samples: DataFrame, spec: MapSpec, channels: Iterable[int]) -> DataFrame:
    """(orbiter, channel, d, lat, lon, ltst, t, orbit): a row a sample and channel, for maps of all orbiters, channels and times in one pass."""
    where = between_half_open(F.col("lat"), spec.lat_bounds) & between_half_open(F.col("lon"), spec.lon_bounds)
    if spec.unflagged and "flag" in samples.columns:
        where = where & (F.col("flag") == 0)
    if spec.exclude_orbits:
        where = where & ~F.col("orbit").isin(*spec.exclude_orbits)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(CHANNELS[c - 1]).alias("t")) for c in channels])).alias("_c")
    out = samples.where(where).select("orbiter", "d", "lat", "lon", "ltst", "orbit", each)
    return out.select("orbiter", "_c.channel", "d", "lat", "lon", "ltst", "_c.t", "orbit").where(F.col("t").isNotNull())


def axes_agree(axes: DataFrame, keys: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """(keys, columns that differ) of the groups whose rows do not have one value in each of the columns: runs that cannot be stacked."""
    names, by = list(columns), list(keys)
    counted = axes.groupBy(*by).agg(*[F.count_distinct(F.struct(c)).alias(f"_n_{c}") for c in names])
    bad = F.filter(F.array(*[F.when(F.col(f"_n_{c}") > 1, F.lit(c)) for c in names]), lambda x: x.isNotNull())
    return counted.select(*by, bad.alias("differ")).where(F.size("differ") > 0)


def valid_bounds(grid: DataFrame, value: str = "value") -> DataFrame:
    """(lat_lo, lat_hi, lon_lo, lon_hi): one row with the index bounds of the valid cells; upper bounds are exclusive."""
    ends = [f(c).alias(f"{c[:3]}_{n}") for c in ("lat_ix", "lon_ix") for n, f in (("lo", F.min), ("hi", F.max))]
    return grid.where(F.col(value).isNotNull() & ~F.isnan(value)).agg(*ends)


def finite_box(grid: DataFrame, value: str = "value") -> dict[str, int]:
    """valid_bounds as numbers."""
    return valid_bounds(grid, value).first().asDict()


def cut_valid(grid: DataFrame, value: str = "value") -> DataFrame:
    """The cells within the bounds of the valid ones, in one plan."""
    b = F.broadcast(valid_bounds(grid, value))
    inside = (F.col("lat_ix") >= F.col("lat_lo")) & (F.col("lat_ix") < F.col("lat_hi")) & (F.col("lon_ix") >= F.col("lon_lo")) & (F.col("lon_ix") < F.col("lon_hi"))
    return grid.crossJoin(b).where(inside).select(*grid.columns)


def abs_lat_crop(df: DataFrame, most: float) -> DataFrame:
    return df.where(F.abs("lat") <= most)


def mask_outside(x: Column, lo: float | None = None, hi: float | None = None, valid_max: float | None = None) -> Column:
    """Null where x <= lo, x >= hi or x > valid_max."""
    ok = x.isNotNull() & ~F.isnan(x)
    if lo is not None:
        ok = ok & (x > lo)
    if hi is not None:
        ok = ok & (x < hi)
    if valid_max is not None:
        ok = ok & (x <= valid_max)
    return F.when(ok, x)


def line_of_sight(body: tuple[str, str, str], target: tuple[str, str, str], radius: float) -> dict[str, Column]:
    """Whether a spherical body hides a target; vectors start at the observer."""
    b, t = norm(*map(F.col, body)), norm(*map(F.col, target))
    dot = reduce(lambda x, y: x + y, [F.col(p) * F.col(q) for p, q in zip(body, target)])
    closer, outside = (t - b) < 0, (t - b) <= radius
    off_axis = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / (b * t)))) >= F.atan(F.lit(radius) / b)
    return {"visible": (closer & outside) | off_axis, "closer": closer, "outside": outside, "off_axis": off_axis}


def require_constant(df: DataFrame, columns: Iterable[str]) -> None:
    """Raises unless each column has one value at most."""
    names = list(columns)
    got = df.agg(*[F.count_distinct(c).alias(c) for c in names]).first()
    bad = [c for c in names if got[c] > 1]
    if bad:
        raise ValueError(f"columns vary: {', '.join(bad)}")
