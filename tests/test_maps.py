from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlark.operators import filters, footprint, grids, interpolate, ranks, residual
from gridlark.plans import maps
from gridlark.schema import MapSpec


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(3)
    rows = [("a", 1, float(x), float(y), float(d), float(h), 250.0, 0) for x, y, d, h in zip(rng.uniform(-80, 80, 300), rng.uniform(-180, 180, 300), rng.uniform(90, 110, 300), rng.uniform(0, 1, 300))]
    return spark.createDataFrame(rows, "orbiter string, orbit int, lat double, lon double, d double, ltst double, t1 double, flag int").withColumns({"t2": F.col("t1"), "t3": F.col("t1"), "t4": F.col("t1")}).cache()


def test_constant_field_gives_the_constant(spark, samples):
    k = footprint.kernel(spark, 2, 4.0)
    spec = MapSpec("a", 2, None, (-60.0, 60.0), resolution=5.0)
    out = maps.footprint_map(samples, spec, k, sigma=1.0).where("mean is not null").agg(F.min("mean"), F.max("mean"), F.max("std")).first()
    assert out[0] == pytest.approx(250) and out[1] == pytest.approx(250) and out[2] < 1e-2


def test_dense_and_sql_footprints_agree(spark, samples):
    k = footprint.kernel(spark, 1, 5.0)
    grid = grids.Grid(grids.Axis(-90.0037, 5.0, 37), grids.Axis(-180.0037, 5.0, 72))
    s = samples.withColumn("t", F.col("t1") + F.col("lat"))
    a = {(r.lat_ix, r.lon_ix): r.wt for r in footprint.spread_samples(s, k, grid, 72).collect()}
    b = {(r.lat_ix, r.lon_ix): r.wt for r in footprint.spread_samples_dense(s, k, grid, 72).collect()}
    assert a.keys() == b.keys()
    assert all(a[x] == pytest.approx(b[x]) for x in a)


def test_a_point_kernel_is_binning(spark, samples):
    grid = grids.full_grid(5.0, (-90.0, 90.0), (-180.0, 180.0))
    point = spark.createDataFrame([(0, 0.0, 0.0, 0.0, 1.0)], "k long, x_over_rad double, y_over_rad double, scaled_rad double, weight double")
    s = samples.withColumn("t", F.col("lat"))
    a = {(r.lat_ix, r.lon_ix): r.wt for r in footprint.spread_samples(s, point, grid, 72).collect()}
    b = {(r.lat_ix, r.lon_ix): r.wt for r in grids.weighted_moments(grid.place(s)).collect()}
    assert a.keys() == b.keys() and all(a[x] == pytest.approx(b[x]) for x in a)


def test_wrapping_keeps_the_weight(spark):
    df = spark.createDataFrame([(0, -3, 1.0), (0, 69, 2.0), (0, 75, 4.0)], "lat_ix int, lon_ix int, w double")
    got = {r.lon_ix: r.w for r in grids.wrap_longitude(df, 72).groupBy("lon_ix").agg(F.sum("w").alias("w")).collect()}
    assert got == {69: 3.0, 3: 4.0}


def test_moments_do_not_depend_on_partitions(spark, samples):
    grid = grids.full_grid(10.0, (-90.0, 90.0), (-180.0, 180.0))
    s = grid.place(samples.withColumn("t", F.col("lat")))
    one, many = (sorted((r.lat_ix, r.lon_ix, round(r.wt2, 6)) for r in grids.weighted_moments(s.repartition(n)).collect()) for n in (1, 7))
    assert one == many


def test_tiles_reach_the_upper_bound(spark):
    t = grids.Tiling((-75.0, 75.0), (-180.0, 180.0), 4.0)
    df = spark.createDataFrame([(74.5, 0.0), (75.0, 0.0), (-75.0, -180.0)], "lat double, lon double")
    assert t.assign(df).count() == 2
    assert t.specs(spark).agg(F.max("lat_hi")).first()[0] == 75.0


def test_nearest_fill_and_blocks(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 1, None), (5, 5, None), (1, 0, 3.0)], "lat_ix int, lon_ix int, value double")
    got = {(r.lat_ix, r.lon_ix): r.value for r in grids.nearest_fill(df, 2).collect()}
    assert got == {(0, 0): 1.0, (0, 1): 1.0, (5, 5): None, (1, 0): 3.0}
    assert {(r.lat_ix, r.lon_ix): r.value for r in grids.block_mean(df, 2).collect()}[0, 0] == 2.0
    with pytest.raises(ValueError):
        grids.scale_factor(64, 10)


def test_interpolation_is_exact_at_nodes_and_for_linear_functions(spark):
    t = spark.createDataFrame([(float(a), float(b), 2.0 * a + 3 * b + a * b) for a in (0, 1, 5) for b in (0, 2, 10)], "a double, b double, v double")
    p = spark.createDataFrame([(0.0, 0.0), (5.0, 10.0), (2.5, 7.0), (9.0, -4.0)], "x double, y double")
    got = {(r.x, r.y): r.o for r in interpolate.multilinear(p, t, {"x": "a", "y": "b"}, "v", "o").collect()}
    assert got == {(0.0, 0.0): 0.0, (5.0, 10.0): pytest.approx(90.0), (2.5, 7.0): pytest.approx(43.5), (9.0, -4.0): pytest.approx(10.0)}


def test_resample_matches_numpy(spark):
    v = [3.0, 1.0, 4.0, 1.0, 5.0]
    got = spark.range(1).select(interpolate.resample(F.array(*map(F.lit, v)), 9)).first()[0]
    assert got == pytest.approx(np.interp(np.linspace(0, 5, 9), np.arange(5), v).tolist())


def test_regular_series(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.5, 3.0), (4.0, 8.0)], "x double, v double")
    got = sorted((r.x, r.v) for r in interpolate.regular_series(df, "x", "v", 1.0).collect())
    assert got == [(float(i), pytest.approx(2.0 * i)) for i in range(5)]


def test_quantization_error_is_bounded(spark):
    df = spark.createDataFrame([(None if i == 7 else 200 + 40 * math.sin(i),) for i in range(500)], "value double")
    out = residual.check_quantized(residual.quantize(df))
    assert out.where("q = -32768").count() == 1
    with pytest.raises(ValueError):
        residual.check_quantized(residual.quantize(df.withColumn("value", F.col("value") * 1e4)))


def test_trend_fit_over_all_cells(spark):
    rows = [(float(la), 240 * math.cos(math.radians(la)) ** 0.4) for la in range(-80, 81, 4) for _ in range(abs(la) % 3 + 1)]
    a, b = residual.fit_latitude_trend(spark.createDataFrame(rows, "lat double, value double"))
    assert a == pytest.approx(240) and b == pytest.approx(0.4)


def test_cut_valid_leaves_the_upper_edges_out(spark):
    df = spark.createDataFrame([(i, j, 1.0 if 1 <= i <= 3 and 1 <= j <= 3 else None) for i in range(5) for j in range(5)], "lat_ix int, lon_ix int, value double")
    assert filters.cut_valid(df).count() == 4
    assert filters.cut_valid(df.where("value is null")).count() == 0


def test_spill_grows_with_latitude(spark, samples):
    k = footprint.kernel(spark, 1, 4.0)
    lat, lon = footprint.footprint_spill(samples, k)
    assert 0 < lat < lon


def test_coverage_threshold_and_side_lobes(spark, samples):
    grid = grids.Grid(grids.Axis(-90.0037, 1.0, 181), grids.Axis(-180.0037, 1.0, 360))
    k = footprint.kernel(spark, 1, 4.0)
    s = samples.withColumn("t", F.col("t1"))
    assert footprint.coverage_threshold(s, k, grid, 360, None, -3.0) > 0
    both = footprint.kernel(spark, 4, 2.0, main_only=False)
    assert both.count() > footprint.kernel(spark, 4, 2.0).count()
    assert footprint.kernel(spark, 4, 2.0, cutoff_db=-10.0).count() < footprint.kernel(spark, 4, 2.0).count()


@pytest.mark.parametrize("reach", [None, 3])
def test_nearest_fill_is_exact_at_any_distance(spark, reach):
    rng = np.random.default_rng(8)
    cells = {(i, j): (float(10 * i + j) if rng.random() < 0.03 else None) for i in range(-3, 30) for j in range(2, 41) if rng.random() < 0.9}
    valid = [k for k, v in cells.items() if v is not None]
    got = {(r.lat_ix, r.lon_ix): r.value for r in grids.nearest_fill(spark.createDataFrame([(i, j, v) for (i, j), v in cells.items()], "lat_ix int, lon_ix int, value double"), reach).collect()}
    assert got.keys() == cells.keys()
    for (i, j), v in cells.items():
        d, a, b = min(((i - a) ** 2 + (j - b) ** 2, a, b) for a, b in valid)
        assert got[i, j] == (v if v is not None else cells[a, b] if reach is None or d <= reach * reach else None)


def test_nearest_fill_without_valid_cells(spark):
    df = spark.createDataFrame([(0, 0, None), (4, 2, None)], "lat_ix int, lon_ix int, value double")
    assert [r.value for r in grids.nearest_fill(df).collect()] == [None, None]
    assert grids.nearest_fill(df.limit(0)).count() == 0


@pytest.mark.parametrize("few", [5, 10_000])
def test_quantiles_match_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(ranks, "SKETCH", 16)
    monkeypatch.setattr(ranks, "ERROR", 0.2)
    monkeypatch.setattr(ranks, "SORTED", few)
    monkeypatch.setattr(ranks, "BINS", 7)
    rng = np.random.default_rng(2)
    v = np.round(np.r_[rng.normal(size=300), np.full(100, 0.25), 1e300, -1e300], 2)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "value double")
    shares = [0.0, 0.02, 0.25, 0.5, 0.77, 0.98, 1.0]
    assert residual.quantiles(df, "value", shares) == pytest.approx(np.quantile(v, shares).tolist())
    assert residual.quantiles(df.where("value is null"), "value", [0.5]) == [None]


def test_all_maps_in_one_pass_are_the_single_maps(spark, samples):
    s = samples.withColumns({"t1": F.col("t1") + F.col("lat"), "t2": F.col("t1") - F.col("lon"), "orbiter": F.when(F.col("lon") > 0, "a").otherwise("b")})
    kernels = {c: footprint.kernel(spark, c, 6.0) for c in (1, 2)}
    spec = MapSpec("", 1, None, (-60.0, 60.0), resolution=5.0)
    for dense in (False, True):
        every = maps.footprint_maps(s, spec, kernels, 12, 1.0, dense=dense).where("mean is not null").collect()
        for o, c, h in (("a", 1, 0), ("b", 2, 12)):
            one = maps.footprint_map(s, MapSpec(o, c, (h / 24, (h + 12) / 24), (-60.0, 60.0), resolution=5.0), kernels[c], 1.0).where("mean is not null")
            want = {(r.lat_ix, r.lon_ix): r for r in one.collect()}
            got = {(round((r.lat + 60) / 5), round((r.lon + 180) / 5)): r.mean for r in every if (r.orbiter, r.channel, r.bin_start) == (o, c, h)}
            near = {(round((r.lat + 60) / 5), round((r.lon + 180) / 5)): r.mean for r in want.values()}
            assert near and got.keys() == near.keys()
            # edges of a cell may take a point either way where a kernel's spill moves the first row
            assert np.mean([abs(got[k] - near[k]) < 1e-6 for k in near]) > 0.99


def test_a_fine_kernel_is_not_joined(spark, samples, monkeypatch):
    monkeypatch.setattr(footprint, "SQL_KERNEL_POINTS", 10)
    k = footprint.kernel(spark, 1, 5.0)
    grid = grids.Grid(grids.Axis(-90.0037, 5.0, 37), grids.Axis(-180.0037, 5.0, 72))
    s = samples.withColumn("t", F.col("t1"))
    with pytest.raises(ValueError):
        footprint.spread_samples(s, k, grid, 72)
    assert footprint.spread(s, k, grid, 72).count() > 0


def test_interpolation_by_a_shuffled_join_and_with_nulls(spark, monkeypatch):
    monkeypatch.setattr(interpolate, "BROADCAST_CELLS", 0)
    t = spark.createDataFrame([(float(a), 7.0, 2.0 * a) for a in (0, 1, 5)], "a double, b double, v double")
    p = spark.createDataFrame([(2.0, 7.0), (None, 7.0), (2.0, 7.0), (9.0, 1.0)], "x double, y double")
    got = [r.o for r in interpolate.multilinear(p, t, {"x": "a", "y": "b"}, "v", "o").collect()]
    assert sorted(x for x in got if x is not None) == [4.0, 4.0, 10.0] and len(got) == 4


def test_runs_that_cannot_be_stacked(spark):
    df = spark.createDataFrame([("x", 1.0, 2), ("x", 1.0, 3), ("y", 1.0, 2), ("y", 1.0, 2)], "run string, start double, n int")
    assert [(r.run, r.differ) for r in filters.axes_agree(df, ["run"], ["start", "n"]).collect()] == [("x", ["n"])]
