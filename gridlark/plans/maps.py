"""End-to-end plans: flagged samples to maps, model sweep to modelled maps and residuals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.functions.times import local_bin
from gridlark.functions.units import hapke_to_albedo, slope_time_shift
from gridlark.operators.brightness import Loss, brightness_temperature, cross_settings
from gridlark.operators.filters import between_half_open, load_slice, load_slices, mask_outside
from gridlark.operators.footprint import deconvolve, footprint_spill
from gridlark.operators.grids import Axis, Grid, block_mean, finish_moments, full_grid, nearest_fill, weighted_moments
from gridlark.operators.interpolate import multilinear
from gridlark.operators.residual import fit_latitude_trend, grid_residual, latitude_residual
from gridlark.operators.thermal import profile_table, simulate
from gridlark.schema import MapSpec


def binned_map(samples: DataFrame, spec: MapSpec) -> DataFrame:
    """Binning and averaging: the footprint is one point."""
    grid = full_grid(spec.resolution, spec.lat_bounds, spec.lon_bounds)
    return grid.with_coordinates(finish_moments(weighted_moments(grid.place(load_slice(samples, spec)))))


def _wide_grid(spec: MapSpec, spill: float) -> Grid:
    """The spec's grid with latitudes for half a footprint more; longitudes are a full turn."""
    return Grid(Axis.over(spec.lat_bounds, spec.resolution, spill), Axis.over((-180.0, 180.0), spec.resolution))


def _within(cells: DataFrame, spec: MapSpec) -> DataFrame:
    return cells.where(between_half_open(F.col("lat"), spec.lat_bounds) & between_half_open(F.col("lon"), spec.lon_bounds))


def footprint_map(samples: DataFrame, spec: MapSpec, kernel: DataFrame, sigma: float | None = 3.0, threshold: float | None = None, dense: bool | None = None) -> DataFrame:
    """A deconvolved map over the spec's bounds; samples that reach in from outside by half a footprint count."""
    rows = load_slice(samples, spec)
    wide = _wide_grid(spec, footprint_spill(rows, kernel)[0])
    out = wide.with_coordinates(deconvolve(rows, kernel, wide, wide.lon.count, sigma, threshold, dense=dense))
    return _within(out, spec)


def footprint_maps(samples: DataFrame, spec: MapSpec, kernels: Mapping[int, DataFrame], hours: int = 2, sigma: float | None = 3.0, threshold: float | None = None, dense: bool | None = None) -> DataFrame:
    """(orbiter, channel, bin_start, ...): the maps of all orbiters, channels and local-time bins in one pass over the samples.

    kernels: channel to kernel. The spec gives bounds and resolution alone.
    """
    rows = load_slices(samples, spec, kernels).withColumn("bin_start", local_bin(F.col("ltst"), hours))
    wide = _wide_grid(spec, max(footprint_spill(rows, k)[0] for k in kernels.values()))
    every = reduce(DataFrame.unionByName, [k.withColumn("channel", F.lit(c)) for c, k in kernels.items()])
    out = deconvolve(rows, every, wide, wide.lon.count, sigma, threshold, dense=dense, keys=["orbiter", "channel", "bin_start"])
    return _within(wide.with_coordinates(out), spec)


def time_bins(hours: int = 2) -> list[tuple[float, float]]:
    if 24 % hours:
        raise ValueError(f"{hours} does not divide 24")
    return [(h / 24, (h + hours) / 24) for h in range(0, 24, hours)]


def all_bins_map(samples: DataFrame, spec: MapSpec, hours: int = 2) -> DataFrame:
    """Every local-time bin of a channel in one pass: the bin is a grouping key."""
    grid = full_grid(spec.resolution, spec.lat_bounds, spec.lon_bounds)
    placed = grid.place(load_slice(samples, spec)).withColumn("bin_start", local_bin(F.col("ltst"), hours))
    return finish_moments(weighted_moments(placed, ["bin_start"]))


def latitude_shift_map(maps: DataFrame, value: str = "mean") -> DataFrame:
    """Residual to one latitude trend fitted over all valid cells."""
    return latitude_residual(maps, *fit_latitude_trend(maps, value), value)


def brightness_table(points: DataFrame, ghz: Sequence[float], c: Sequence[float], loss: Loss = Loss(), samples: int = 240, path: str = "rho") -> DataFrame:
    """(lat, albedo, h, ltst, freq, c, tb): the model sweep collapsed over depth."""
    layers = profile_table(simulate(points), samples)
    keys = ["lat", "albedo", "h", "ltst", "freq", "c"]
    return brightness_temperature(cross_settings(layers, list(ghz), list(c)), keys, loss, path)


def modelled_map(cells: DataFrame, table: DataFrame, hour: float, max_shift: float = 1.5) -> DataFrame:
    """cells (lat, albedo from the source map, h, slope, azimuth) with tb at a local hour, from one channel's model table.

    The table's first hours are repeated after midnight and its last ones before
    it, so that a shifted hour lies between modelled hours.
    """
    held = cells.withColumns({"_alb": hapke_to_albedo(F.col("albedo")), "_lat": F.abs("lat"), "_hour": F.lit(float(hour)) + slope_time_shift(F.col("slope"), F.col("azimuth"), max_shift)})
    day = table.select("lat", "albedo", "h", "ltst", "tb")
    near = max_shift + 2
    wide = day.union(day.where(F.col("ltst") <= near).withColumn("ltst", F.col("ltst") + 24)).union(day.where(F.col("ltst") >= 24 - near).withColumn("ltst", F.col("ltst") - 24))
    return multilinear(held, wide, {"_alb": "albedo", "h": "h", "_lat": "lat", "_hour": "ltst"}, "tb", "tb").drop("_alb", "_lat", "_hour")


def prepare_source(raster: DataFrame, factor: int, lo: float | None = None, hi: float | None = None, valid_max: float | None = None, rows: tuple[int, int] | None = None, fill: bool = True) -> DataFrame:
    """A source raster (lat_ix, lon_ix, value) for modelled maps: cropped to rows, values outside their range and then holes
    filled by the nearest valid ones, and averaged over factor x factor cells."""
    held = raster if rows is None else raster.where(between_half_open(F.col("lat_ix"), rows)).withColumn("lat_ix", F.col("lat_ix") - rows[0])
    held = held.withColumn("value", mask_outside(F.col("value"), lo, hi, valid_max))
    return block_mean(nearest_fill(held) if fill else held, factor)


def residual_map(measured: DataFrame, modelled: DataFrame, keys: Sequence[str] = ("bin_start", "lat_ix", "lon_ix")) -> DataFrame:
    return grid_residual(measured, modelled, keys)
