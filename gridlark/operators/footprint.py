"""Antenna pattern, footprint projection and deconvolution onto a grid."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.functions.units import db_to_power
from gridlark.operators.grids import Grid, finish_moments, smooth, wrap_longitude
from gridlark.schema import ANTENNAS, MOON_RADIUS_KM, Antenna

#: Kernel points that may be broadcast and joined in SQL, beyond which blocks of samples are added up with numpy unless asked otherwise, and of all kernels together on the driver.
SQL_KERNEL_POINTS, DENSE_POINTS, MOST_KERNEL_POINTS = 5000, 16, 4_000_000
#: Footprint points that a numpy task places at once, and cells between the least and the largest of them for plain counting.
BLOCK_POINTS, SPAN_CELLS = 500_000, 2_000_000


def _peak(theta: Column, centre: float, sigma: float) -> Column:
    return F.exp(-F.pow((theta - centre) / sigma, F.lit(2)))


def main_beam_db(theta: Column, a: Antenna) -> Column:
    """Two Gaussians in dB, half a beam width to either side."""
    half = a.main_width / 2
    return a.main_power * (_peak(theta, -half, a.sigma) + _peak(theta, half, a.sigma))


def side_lobe_db(theta: Column, a: Antenna) -> Column:
    """The first side lobe as if it were radially symmetric: its peak less an inner and an outer annulus."""
    s = (theta - a.main_width / 2) / a.side_ratio
    return (a.main_power - a.side_peak) * (_peak(s, 0.0, a.sigma) + _peak(s, a.main_width, a.sigma)) + a.side_peak


def side_lobe_edge(a: Antenna, step: float, most: float, flat: float = 0.01) -> float:
    """The angle at which the outer annulus has reached its full depth, to within `flat` dB."""
    r = np.arange(0, most + step / 2, step)
    s = (r - a.main_width / 2) / a.side_ratio
    outer = (a.main_power - a.side_peak) * np.exp(-(((s - a.main_width) / a.sigma) ** 2))
    return float(r[np.nonzero(np.abs(outer - outer.min()) < flat)[0].min()])


def kernel(spark: SparkSession, channel: int, step: float = 1.0, most: float = 28.0, main_only: bool = True, cutoff_db: float | None = None, radius_km: float = MOON_RADIUS_KM) -> DataFrame:
    """(k, x_over_rad, y_over_rad, scaled_rad, weight): the points of the pattern within its valid circle.

    weight is power relative to the peak; scaled_rad is the angle at the body's
    centre that a point spans per kilometre of altitude.
    """
    a = ANTENNAS[channel]
    n = int(round(most / step))
    side = 2 * n + 1
    ids = spark.range(side * side)
    az = (F.col("id") % side - n) * F.lit(step)
    el = (F.floor(F.col("id") / side) - n) * F.lit(step)
    pts = ids.select(F.col("id").alias("k"), az.alias("az"), el.alias("el"), F.sqrt(az * az + el * el).alias("theta"))
    beam = main_beam_db(F.col("theta"), a)
    inside = F.col("theta") < a.main_width / 2
    if main_only:
        pts = pts.where(inside).withColumn("gain", beam)
    else:
        edge = side_lobe_edge(a, step, most)
        pts = pts.where(F.col("theta") <= edge).withColumn("gain", F.when(inside, beam).otherwise(side_lobe_db(F.col("theta"), a)))
    if cutoff_db is not None:
        # the first angle along an axis from which the gain stays below the limit bounds the circle
        reach = pts.where((F.col("el") == 0) & (F.col("az") >= 0) & (F.col("gain") >= cutoff_db)).agg(F.max("theta").alias("reach"))
        pts = pts.crossJoin(F.broadcast(reach)).where(F.col("theta") <= F.col("reach")).drop("reach")
    peak = pts.agg(F.max("gain").alias("peak"))
    out = pts.crossJoin(F.broadcast(peak)).withColumn("weight", db_to_power(F.col("gain") - F.col("peak")))
    # linear offset per km of altitude: 2 * tan(angle / 2) along each axis
    flat = lambda c: F.tan(F.radians(F.col(c)) / 2) * 2
    out = out.withColumns({"_x": flat("az"), "_y": flat("el")}).withColumn("_r", F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y")))
    unit = lambda c: F.when(F.col("_r") > 0, F.col(c) / F.col("_r")).otherwise(F.lit(0.0))
    return out.select("k", unit("_x").alias("x_over_rad"), unit("_y").alias("y_over_rad"), (F.col("_r") / radius_km).alias("scaled_rad"), "weight")


def project(d: Column, lat: Column, lon: Column, x: Column, y: Column, r: Column, standard: bool = False, wrap: bool = False) -> tuple[Column, Column]:
    """Latitude and longitude, in degrees, of a footprint point.

    standard=False divides by the cosine in both terms of the longitude, as the
    published maps were made; standard=True is the inverse orthographic formula.
    wrap=True gives longitudes in [0, 360).
    """
    c = r * d
    phi = F.radians(lat)
    point_lat = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.cos(c) * F.sin(phi) + y * F.sin(c) * F.cos(phi))))
    other = F.sin(phi) if standard else F.cos(phi)
    turn = F.atan2(x * F.sin(c), F.cos(c) * F.cos(phi) - y * F.sin(c) * other)
    point_lon = lon + F.degrees(turn)
    return F.degrees(point_lat), F.pmod(point_lon, F.lit(360.0)) if wrap else point_lon


def flat_offset(d: Column, x: Column, y: Column, r: Column, radius_km: float = MOON_RADIUS_KM) -> tuple[Column, Column]:
    """Offsets in km of a footprint point on a flat surface."""
    span = r * d * radius_km
    return x * span, y * span


def spill(samples: DataFrame, kernel_df: DataFrame, standard: bool = False) -> DataFrame:
    """(lat_spill, lon_spill): half the largest extent in degrees of latitude and longitude, for the highest altitude and latitude; one row."""
    worst = samples.agg(F.max("d").cast("double").alias("d"), F.max(F.abs("lat")).cast("double").alias("lat"))
    pts = kernel_df.crossJoin(F.broadcast(worst))
    lat, lon = project(F.col("d"), F.col("lat"), F.lit(0.0), F.col("x_over_rad"), F.col("y_over_rad"), F.col("scaled_rad"), standard)
    half = lambda c: F.coalesce((F.max(c) - F.min(c)) / 2, F.lit(0.0))
    return pts.select(lat.alias("a"), lon.alias("b")).agg(half("a").alias("lat_spill"), half("b").alias("lon_spill"))


def footprint_spill(samples: DataFrame, kernel_df: DataFrame, standard: bool = False) -> tuple[float, float]:
    """spill as numbers, from which the axes of a grid are made."""
    return tuple(spill(samples, kernel_df, standard).first())


def small_kernel(kernel_df: DataFrame) -> DataFrame:
    """The kernel, to be broadcast; raises if it is too fine for a join."""
    if kernel_df.limit(SQL_KERNEL_POINTS + 1).count() > SQL_KERNEL_POINTS:
        raise ValueError(f"the kernel has more than {SQL_KERNEL_POINTS} points: use numpy sums")
    return F.broadcast(kernel_df)


def with_kernel(samples: DataFrame, kernel_df: DataFrame) -> DataFrame:
    """Each sample with every point of the kernel, of its channel's if the kernel has a channel."""
    kernel_df = small_kernel(kernel_df)
    return samples.join(kernel_df, "channel") if "channel" in kernel_df.columns else samples.crossJoin(kernel_df)


def _doubles(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    return samples.select(*keys, *[F.col(c).cast("double").alias(c) for c in ("d", "lat", "lon", "t")])


def spread_samples(samples: DataFrame, kernel_df: DataFrame, grid: Grid, turn: int, standard: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """Per keys and cell w, wt, wt2 of all samples' footprints, in SQL: the kernel is at most SQL_KERNEL_POINTS rows."""
    pts = with_kernel(_doubles(samples, keys), kernel_df)
    lat, lon = project(F.col("d"), F.col("lat"), F.col("lon"), F.col("x_over_rad"), F.col("y_over_rad"), F.col("scaled_rad"), standard)
    placed = pts.select(*keys, grid.lat.index(lat).alias("lat_ix"), grid.lon.index(lon).alias("lon_ix"), "weight", "t")
    w, t = F.col("weight"), F.col("t")
    sums = wrap_longitude(placed, turn).where(grid.lat.inside(F.col("lat_ix"))).groupBy(*keys, "lat_ix", "lon_ix")
    return sums.agg(F.sum(w).alias("w"), F.sum(w * t).alias("wt"), F.sum(w * t * t).alias("wt2"))


def _block_sums(d, la, lo, t, kernel: tuple, g: Grid, turn: int, standard: bool):
    """Cells and sums of a block of samples (columns) with all kernel points (rows of a wide array)."""
    x, y, r, weight = kernel
    phi = np.radians(la)[:, None]
    c = r[None, :] * d[:, None]
    sin_c, cos_c, sin_p, cos_p = np.sin(c), np.cos(c), np.sin(phi), np.cos(phi)
    p_lat = np.degrees(np.arcsin(np.clip(cos_c * sin_p + y * sin_c * cos_p, -1, 1)))
    p_lon = lo[:, None] + np.degrees(np.arctan2(x * sin_c, cos_c * cos_p - y * sin_c * (sin_p if standard else cos_p)))
    i = np.floor((p_lat - g.lat.start) / g.lat.step).astype(np.int64)
    j = np.floor((p_lon - g.lon.start) / g.lon.step).astype(np.int64) % turn
    ok = (i >= 0) & (i < g.lat.count)
    cell = (i * turn + j)[ok]
    if not len(cell):
        return cell, np.zeros((3, 0))
    w, value = np.broadcast_to(weight, ok.shape)[ok], np.broadcast_to(t[:, None], ok.shape)[ok]
    first = int(cell.min())
    if int(cell.max()) - first < SPAN_CELLS:
        at, back = None, cell - first
    else:
        at, back = np.unique(cell, return_inverse=True)
    sums = np.stack([np.bincount(back, x) for x in (w, w * value, w * value * value)])
    if at is None:
        at = np.flatnonzero(np.bincount(back))
        return at + first, sums[:, at]
    return at, sums


def spread_samples_dense(samples: DataFrame, kernel_df: DataFrame, grid: Grid, turn: int, standard: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """As spread_samples, without a row for each sample and point: tasks add up blocks of samples with numpy and hand on sums of cells.

    The kernels go to the driver: their size depends on resolution, not on data,
    and more than MOST_KERNEL_POINTS raise.
    """
    by_channel = "channel" in kernel_df.columns
    k = kernel_df.select(*(["channel"] if by_channel else []), "x_over_rad", "y_over_rad", "scaled_rad", "weight").limit(MOST_KERNEL_POINTS + 1).toPandas()
    if len(k) > MOST_KERNEL_POINTS:
        raise ValueError(f"the kernels have more than {MOST_KERNEL_POINTS} points")
    parts = {c: p.drop(columns="channel") for c, p in k.groupby("channel")} if by_channel else {None: k}
    kernels = {c: tuple(np.ascontiguousarray(p.to_numpy(float)[:, i]) for i in range(4)) for c, p in parts.items()}
    held = _doubles(samples, keys)
    schema = T.StructType([*[held.schema[c] for c in keys], T.StructField("lat_ix", T.IntegerType()), T.StructField("lon_ix", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in ("w", "wt", "wt2")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            own = list(zip(*(b.column(c).to_pylist() for c in keys))) if keys else [()] * b.num_rows
            names = {key: i for i, key in enumerate(dict.fromkeys(own))}
            code = np.fromiter((names[x] for x in own), np.int64, len(own))
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("d", "lat", "lon", "t")]
            for key, i in names.items():
                kernel = kernels.get(key[list(keys).index("channel")] if by_channel else None)
                if kernel is None:  # a channel without a kernel, as the join has it
                    continue
                rows, step = np.flatnonzero(code == i), max(1, BLOCK_POINTS // max(1, len(kernel[0])))
                for at in range(0, len(rows), step):
                    cell, sums = _block_sums(*(c[rows[at : at + step]] for c in cols), kernel, grid, turn, standard)
                    same = [pa.array([v] * len(cell), b.schema.field(c).type) for c, v in zip(keys, key)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array((cell // turn).astype(np.int32)), pa.array((cell % turn).astype(np.int32)), *(pa.array(x) for x in sums)], names=schema.fieldNames())

    return held.mapInArrow(run, schema).groupBy(*keys, "lat_ix", "lon_ix").agg(*[F.sum(c).alias(c) for c in ("w", "wt", "wt2")])


def spread(samples: DataFrame, kernel_df: DataFrame, grid: Grid, turn: int, standard: bool = False, keys: Sequence[str] = (), dense: bool | None = None) -> DataFrame:
    """spread_samples_dense, or spread_samples if asked for or if the kernel is a few points: a join has a row for each sample and point."""
    if dense is None:
        dense = kernel_df.limit(DENSE_POINTS + 1).count() > DENSE_POINTS
    return (spread_samples_dense if dense else spread_samples)(samples, kernel_df, grid, turn, standard, keys)


def coverage_threshold(samples: DataFrame, kernel_df: DataFrame, grid: Grid, turn: int, sigma: float | None, gain_db: float, standard: bool = False) -> float:
    """Mean over two probe samples, nearest to and furthest from the equator, of the least smoothed weight where a footprint's power is within the gain."""
    cases = []
    for order in (F.abs("lat").asc(), F.abs("lat").desc()):
        probe = samples.orderBy(order, "lat", "lon").limit(1)
        one = spread(probe, kernel_df, grid, turn, standard)
        one = smooth(one, sigma, ["w", "wt", "wt2"]) if sigma else one
        strong = spread(probe, kernel_df.where(F.col("weight") >= 10 ** (gain_db / 10)), grid, turn, standard).select("lat_ix", "lon_ix")
        least = one.join(strong, ["lat_ix", "lon_ix"], "left_semi").agg(F.min("w")).first()[0]
        if least is not None:
            cases.append(least)
    if not cases:
        raise ValueError("no samples to find a threshold with")
    return float(np.mean(cases))


def deconvolve(samples: DataFrame, kernel_df: DataFrame, grid: Grid, turn: int, sigma: float | None = None, threshold: float | None = None, standard: bool = False, dense: bool | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, lat_ix, lon_ix, w, wt, wt2, mean, std): footprints summed, smoothed once after the sums, and finished.

    keys part the samples into maps that are made in one pass; with a channel
    among them the kernel may have one too.
    """
    sums = spread(samples, kernel_df, grid, turn, standard, keys, dense)
    if sigma:
        sums = wrap_longitude(smooth(sums, sigma, ["w", "wt", "wt2"], keys=keys), turn).groupBy(*keys, "lat_ix", "lon_ix").agg(*[F.sum(c).alias(c) for c in ("w", "wt", "wt2")])
    return finish_moments(sums, None if threshold is None else F.lit(threshold))


def sample_counts(samples: DataFrame, kernel_df: DataFrame, grid: Grid, turn: int, least: float, standard: bool = False) -> DataFrame:
    """(lat_ix, lon_ix, n): samples whose own weight in a cell is at least `least`. samples: with a unique `sample_id`."""
    pts = with_kernel(samples, kernel_df)
    lat, lon = project(F.col("d"), F.col("lat"), F.col("lon"), F.col("x_over_rad"), F.col("y_over_rad"), F.col("scaled_rad"), standard)
    placed = wrap_longitude(pts.select("sample_id", grid.lat.index(lat).alias("lat_ix"), grid.lon.index(lon).alias("lon_ix"), "weight"), turn)
    own = placed.groupBy("sample_id", "lat_ix", "lon_ix").agg(F.sum("weight").alias("w"))
    return own.where(F.col("w") >= least).groupBy("lat_ix", "lon_ix").agg(F.count(F.lit(1)).alias("n"))
