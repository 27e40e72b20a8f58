"""Grids in long form: integer cell indices, never float keys.

A cell (lat_ix, lon_ix) covers [lat0 + lat_ix * res, lat0 + (lat_ix + 1) * res)
and likewise in longitude.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlark.operators.order import even_groups
from gridlark.sources.scratch import written


@dataclass(frozen=True)
class Axis:
    start: float
    step: float
    count: int

    @classmethod
    def over(cls, bounds: tuple[float, float], step: float, spill: float = 0.0) -> "Axis":
        """The axis over bounds, widened by whole steps to hold `spill`."""
        more = math.ceil(spill / step - 1e-9)
        return cls(bounds[0] - more * step, step, round((bounds[1] - bounds[0]) / step) + 2 * more)

    def index(self, x: Column) -> Column:
        return F.floor((x - self.start) / self.step).cast("int")

    def left(self, ix: Column) -> Column:
        return ix * self.step + self.start

    def inside(self, ix: Column) -> Column:
        return (ix >= 0) & (ix < self.count)


@dataclass(frozen=True)
class Grid:
    lat: Axis
    lon: Axis

    def cells(self, spark: SparkSession) -> DataFrame:
        """All cells, made in parallel."""
        n = self.lat.count * self.lon.count
        ids = spark.range(n)
        return ids.select(F.floor(F.col("id") / self.lon.count).cast("int").alias("lat_ix"), (F.col("id") % self.lon.count).cast("int").alias("lon_ix"))

    def place(self, df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """df with lat_ix and lon_ix, without rows off the grid."""
        out = df.withColumns({"lat_ix": self.lat.index(F.col(lat)), "lon_ix": self.lon.index(F.col(lon))})
        return out.where(self.lat.inside(F.col("lat_ix")) & self.lon.inside(F.col("lon_ix")))

    def with_coordinates(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"lat": self.lat.left(F.col("lat_ix")), "lon": self.lon.left(F.col("lon_ix"))})


def full_grid(resolution: float, lat_bounds: tuple[float, float], lon_bounds: tuple[float, float], spill: float = 0.0) -> Grid:
    """The grid over both bounds as given; longitudes are not widened beyond a full turn."""
    return Grid(Axis.over(lat_bounds, resolution, spill), Axis.over(lon_bounds, resolution, spill))


@dataclass(frozen=True)
class Tiling:
    """Square tiles over a box; the last tile of a row is cut at the bound, so that no row is left out."""

    lat_bounds: tuple[float, float]
    lon_bounds: tuple[float, float]
    size: float

    def assign(self, df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """df with tile_lat and tile_lon: a range join as a computed key."""
        out = df
        for name, c, (lo, hi) in (("tile_lat", lat, self.lat_bounds), ("tile_lon", lon, self.lon_bounds)):
            out = out.where((F.col(c) >= lo) & (F.col(c) < hi)).withColumn(name, F.floor((F.col(c) - lo) / self.size).cast("int"))
        return out

    def specs(self, spark: SparkSession) -> DataFrame:
        """(tile_lat, tile_lon, lat_lo, lat_hi, lon_lo, lon_hi) of every tile."""
        n_lat, n_lon = (math.ceil((b[1] - b[0]) / self.size - 1e-9) for b in (self.lat_bounds, self.lon_bounds))
        base = spark.range(n_lat).select(F.col("id").cast("int").alias("tile_lat")).crossJoin(F.broadcast(spark.range(n_lon).select(F.col("id").cast("int").alias("tile_lon"))))
        edge = lambda c, b: ((F.col(c) * self.size + b[0]), F.least(F.lit(float(b[1])), (F.col(c) + 1) * self.size + b[0]))
        (a, b), (c, d) = edge("tile_lat", self.lat_bounds), edge("tile_lon", self.lon_bounds)
        return base.withColumns({"lat_lo": a, "lat_hi": b, "lon_lo": c, "lon_hi": d})


def wrap_longitude(df: DataFrame, columns: int) -> DataFrame:
    """Cells with lon_ix beyond either edge of a full turn of `columns` cells, moved to their partners."""
    return df.withColumn("lon_ix", F.pmod(F.col("lon_ix"), F.lit(columns)).cast("int"))


def roll_longitude(df: DataFrame, columns: int) -> DataFrame:
    """Longitudes turned by half a turn."""
    return df.withColumn("lon_ix", F.pmod(F.col("lon_ix") + columns // 2, F.lit(columns)).cast("int"))


def scale_factor(source: int, target: int) -> int:
    """Cells of the source in one of the target."""
    if source % target:
        raise ValueError(f"{target} cells a degree do not divide {source}")
    return source // target


def block_mean(df: DataFrame, factor: int, value: str = "value") -> DataFrame:
    """Means of factor x factor blocks; null cells do not count."""
    return df.groupBy(F.floor(F.col("lat_ix") / factor).cast("int").alias("lat_ix"), F.floor(F.col("lon_ix") / factor).cast("int").alias("lon_ix")).agg(F.avg(value).alias(value))


def flip_latitude(df: DataFrame, rows: int) -> DataFrame:
    """North up."""
    return df.withColumn("lat_ix", (F.lit(rows - 1) - F.col("lat_ix")).cast("int"))


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[tuple[int, float]]:
    """(offset, weight) of a normalised one-dimensional Gaussian."""
    r = int(truncate * sigma + 0.5)
    w = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-r, r + 1)]
    return [(i - r, x / sum(w)) for i, x in enumerate(w)]


#: Cells of a tile's side when planes are smoothed, unless the kernel asks for more.
TILE = 256


def _convolved(grid: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The grid convolved along both axes, without what lies at its borders: both get shorter by the kernel's reach."""
    for axis in (0, 1):
        n = grid.shape[axis] - len(weights) + 1
        part = lambda k: grid[k : k + n] if axis == 0 else grid[:, k : k + n]  # noqa: B023, E731
        total = weights[0] * part(0)
        for k in range(1, len(weights)):
            total += weights[k] * part(k)
        grid = total
    return grid


def smooth(df: DataFrame, sigma: float, columns: list[str], truncate: float = 4.0, keys: Sequence[str] = (), tile: int = TILE) -> DataFrame:
    """Gaussian smoothing of summed planes (per keys), by dense tiles.

    Smoothing is linear, so it comes after the aggregation of samples. A cell is
    sent to its tile, and once to each neighbour in whose margin it lies: with
    margins of the kernel's reach r, (1 + 2 r / tile) ** 2 rows a cell are
    shuffled. A tile is an array with margins, convolved along both axes; its own
    cells come out that a cell of the input reaches. A null counts as no cell;
    cells off the grid that smoothing reaches are there too.
    """
    kernel = np.array([w for _, w in gaussian_weights(sigma, truncate)])
    reach = len(kernel) // 2
    side = max(tile, 2 * reach, 1)

    def tiles(c: str) -> Column:
        own, inside = F.floor(F.col(c) / side), F.pmod(F.col(c), F.lit(side))
        around = F.array(own, F.when(inside < reach, own - 1), F.when(inside >= side - reach, own + 1))
        return F.filter(around, lambda x: x.isNotNull())

    held = df.select(*keys, F.col("lat_ix").cast("int").alias("lat_ix"), F.col("lon_ix").cast("int").alias("lon_ix"), *[F.col(c).cast("double").alias(c) for c in columns])
    sent = held.withColumn("_ty", F.explode(tiles("lat_ix"))).withColumn("_tx", F.explode(tiles("lon_ix")))
    schema = T.StructType([*[held.schema[k] for k in keys], *[held.schema[c] for c in ("lat_ix", "lon_ix", *columns)]])
    whole = side + 2 * reach

    def run(t: pa.Table) -> pa.Table:
        top, left = (t.column(c)[0].as_py() * side for c in ("_ty", "_tx"))
        y, x = t.column("lat_ix").to_numpy() - top + reach, t.column("lon_ix").to_numpy() - left + reach
        there, planes, known = np.zeros((whole, whole)), {}, {}
        there[y, x] = 1.0
        near = _convolved(there, np.ones(len(kernel))) > 0.5
        for c in columns:
            v = t.column(c).combine_chunks()
            plane = np.zeros((whole, whole))
            np.add.at(plane, (y, x), v.fill_null(0.0).to_numpy())
            planes[c] = _convolved(plane, kernel)[near]
            if v.null_count:
                valid = np.zeros((whole, whole))
                valid[y, x] = v.is_valid().to_numpy(zero_copy_only=False)
                known[c] = _convolved(valid, np.ones(len(kernel)))[near] > 0.5
        at = np.nonzero(near)
        out = {k: pa.array([t.column(k)[0].as_py()] * len(at[0]), t.column(k).type) for k in keys}
        out |= {"lat_ix": pa.array(at[0] + top, pa.int32()), "lon_ix": pa.array(at[1] + left, pa.int32())}
        return pa.table(out | {c: pa.array(planes[c], mask=~known[c] if c in known else None) for c in columns})

    return sent.groupBy(*keys, "_ty", "_tx").applyInArrow(run, schema)


def _nearest_in_row(table: pa.Table) -> pa.Table:
    """Of one grid row's columns with their nearest valid cells (x, dy, y, v): the nearest cell of each hole, by growing distance."""
    x = table.column("lon_ix").to_numpy()
    first = int(x.min())
    n = int(x.max()) - first + 1
    dy, y, v = np.full(n, np.iinfo(np.int64).max // 4), np.zeros(n, np.int64), np.zeros(n)
    ok = table.column("dy").is_valid().to_numpy(zero_copy_only=False)
    dy[x[ok] - first] = table.column("dy").filter(pa.array(ok)).to_numpy() ** 2
    y[x[ok] - first] = table.column("y").filter(pa.array(ok)).to_numpy()
    v[x[ok] - first] = table.column("v").filter(pa.array(ok)).to_numpy()
    holes = x[table.column("hole").to_numpy(zero_copy_only=False)] - first
    cost, at = dy[holes].copy(), holes.copy()
    for k in range(1, n):
        left = np.flatnonzero(cost >= k * k)
        if not len(left):
            break
        for step in (-k, k):
            i = holes[left] + step
            own = left[(i >= 0) & (i < n)]
            i = holes[own] + step
            c = dy[i] + k * k
            better = (c < cost[own]) | (c == cost[own]) & ((y[i] < y[at[own]]) | (y[i] == y[at[own]]) & (i < at[own]))
            cost[own[better]], at[own[better]] = c[better], i[better]
    found = cost < np.iinfo(np.int64).max // 4
    return pa.table({"lat_ix": pa.array([table.column("lat_ix")[0].as_py()] * int(found.sum()), pa.int32()), "lon_ix": pa.array(holes[found] + first, pa.int32()), "_fill": pa.array(v[at[found]], pa.float64()), "_d": pa.array(cost[found], pa.int64())})


def nearest_fill(df: DataFrame, reach: int | None = None, value: str = "value") -> DataFrame:
    """Null cells get the value of the nearest valid cell (ties: smaller lat_ix, then lon_ix), within `reach` cells if that is given.

    A distance transform in two passes: along each column of the grid windows
    find the nearest valid cell above and below, along each row the best of the
    columns' cells is taken. Either pass holds one line of the grid. df is written
    once, since four steps read it.
    """
    df = written(df, "holes")
    bounds = df.agg(F.min("lat_ix").alias("_lo"), F.max("lat_ix").alias("_hi"))
    lattice = df.select("lon_ix").distinct().crossJoin(F.broadcast(bounds)).select("lon_ix", F.explode(F.sequence("_lo", "_hi")).alias("lat_ix"))
    here = df.select("lat_ix", "lon_ix", F.col(value).cast("double").alias("_v"), F.lit(True).alias("_in"))
    held = lattice.join(here, ["lat_ix", "lon_ix"], "left")
    along = Window.partitionBy("lon_ix").orderBy("lat_ix")
    own = F.when(F.col("_v").isNotNull(), F.struct(F.col("lat_ix").alias("y"), F.col("_v").alias("v")))
    above = F.last(own, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    below = F.first(own, ignorenulls=True).over(along.rowsBetween(0, Window.unboundedFollowing))
    held = held.select("lat_ix", "lon_ix", (F.col("_v").isNull() & F.col("_in").isNotNull()).alias("hole"), above.alias("_a"), below.alias("_b"))
    nearer = F.when(F.col("_b").isNull() | (F.col("lat_ix") - F.col("_a.y") <= F.col("_b.y") - F.col("lat_ix")), F.col("_a")).otherwise(F.col("_b"))
    held = held.withColumn("_n", nearer).select("lat_ix", "lon_ix", "hole", F.abs(F.col("_n.y") - F.col("lat_ix")).cast("long").alias("dy"), F.col("_n.y").cast("long").alias("y"), F.col("_n.v").alias("v"))
    rows = held.join(held.where("hole").select("lat_ix").distinct(), "lat_ix", "left_semi")
    best = rows.groupBy("lat_ix").applyInArrow(_nearest_in_row, "lat_ix int, lon_ix int, _fill double, _d long")
    if reach is not None:
        best = best.where(F.col("_d") <= reach * reach)
    return df.join(best.drop("_d"), ["lat_ix", "lon_ix"], "left").withColumn(value, F.coalesce(value, "_fill")).drop("_fill")


def weighted_moments(df: DataFrame, keys: list[str] | None = None, weight: Column | None = None, value: str = "t") -> DataFrame:
    """Per cell the sums w, wt and wt2: partial sums before the shuffle, merged by addition."""
    w = F.lit(1.0) if weight is None else weight
    t = F.col(value).cast("double")
    return df.groupBy(*(keys or []), "lat_ix", "lon_ix").agg(F.sum(w).alias("w"), F.sum(w * t).alias("wt"), F.sum(w * t * t).alias("wt2"))


def finish_moments(df: DataFrame, least: Column | None = None) -> DataFrame:
    """Mean and biased standard deviation; cells with less weight than `least` become null."""
    ok = F.col("w") > 0 if least is None else (F.col("w") > 0) & (F.col("w") >= least)
    mean = F.when(ok, F.col("wt") / F.col("w"))
    var = (F.col("wt2") * F.col("w") - F.col("wt") * F.col("wt")) / (F.col("w") * F.col("w"))
    return df.withColumns({"mean": mean, "std": F.when(ok, F.sqrt(F.greatest(F.lit(0.0), var)))})


def mean_histogram(df: DataFrame, bins: int, value: str, x: str = "lon", y: str = "lat") -> DataFrame:
    """Means of `value` in bins x bins cells over the data's own range; the largest value is in the last bin."""
    span = df.agg(*[f(c).alias(f"_{n}_{c}") for c in (x, y) for n, f in (("lo", F.min), ("hi", F.max))])
    held = df.crossJoin(F.broadcast(span))

    def at(c: str) -> Column:
        width = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        return F.least(F.lit(bins - 1), F.when(width > 0, F.floor((F.col(c) - F.col(f"_lo_{c}")) / width * bins)).otherwise(0)).cast("int")

    return held.groupBy(at(y).alias("lat_ix"), at(x).alias("lon_ix")).agg(F.avg(value).alias(value))


def downsample_orbit(df: DataFrame, points: int, order: list[str]) -> DataFrame:
    """Every k-th row of an orbit in its order, k = rows // points, without the last row."""
    w = Window.partitionBy("orbit")
    n, i = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy(*order)) - 1
    stride = F.greatest(F.lit(1), F.floor(F.col("_n") / points))
    return df.withColumns({"_n": n, "_i": i}).where((F.col("_i") < F.col("_n") - 1) & (F.col("_i") % stride == 0)).drop("_n", "_i")


def representatives(keys: DataFrame, column: str, n: int) -> DataFrame:
    """The first key of each of n evenly divided groups of the ordered distinct keys."""
    return even_groups(keys.select(column).distinct(), [column], n, "_g").groupBy("_g").agg(F.min(column).alias(column)).select(column)


def arg_max_row(df: DataFrame, by: str, tie: list[str]) -> DataFrame:
    """The row with the largest value; ties go to the smallest `tie`."""
    return df.orderBy(F.col(by).desc(), *tie).limit(1)


def tick_positions(df: DataFrame, index: str, value: str, targets: list[float], tolerance: float) -> DataFrame:
    """(target, position): the middle of the indices within tolerance of each target; raises at a target without any."""
    t = F.explode(F.array(*[F.lit(float(x)) for x in targets])).alias("target")
    near = df.select(index, value, t).where(F.abs(F.col(value) - F.col("target")) <= tolerance)
    held = near.groupBy("target").agg(F.sort_array(F.collect_list(index)).alias("_at"))
    out = held.select("target", F.get("_at", F.floor(F.size("_at") / 2).cast("int")).alias("position"))
    if (missing := len(set(targets)) - out.count()) > 0:
        raise ValueError(f"{missing} targets have no match within {tolerance}")
    return out


def end_tiles(df: DataFrame, size: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(end, tile_lat, tile_lon, n): the tiles with rows that are nearest to the equator and furthest from it, by their least absolute latitude; ties: smaller indices."""
    floor = lambda c: F.floor(F.col(c) / size).cast("int")
    tiles = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy(floor(lat).alias("tile_lat"), floor(lon).alias("tile_lon")).agg(F.count(F.lit(1)).alias("n"))
    away = F.greatest(F.col("tile_lat"), -F.col("tile_lat") - 1)
    first = lambda sign: F.min(F.struct((sign * away).alias("away"), "tile_lat", "tile_lon", "n"))
    ends = tiles.agg(first(1).alias("near"), first(-1).alias("far"))
    both = F.explode(F.array(F.struct(F.lit("near").alias("end"), F.col("near").alias("t")), F.struct(F.lit("far").alias("end"), F.col("far").alias("t")))).alias("e")
    return ends.select(both).where("e.t is not null").select("e.end", "e.t.tile_lat", "e.t.tile_lon", "e.t.n")
