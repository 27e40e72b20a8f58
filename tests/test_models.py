from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlark.operators import brightness, ephemeris, thermal
from gridlark.plans import maps
from gridlark.schema import BOLTZMANN, LIGHT_SPEED, PLANCK, Body


def test_runs_do_not_depend_on_their_batch():
    s = thermal.Solver(years=0.0, days=1)
    one = thermal.run_models(np.array([0.12]), np.array([30.0]), np.array([0.07]), Body(), s)[0]
    two = thermal.run_models(np.array([0.12, 0.12]), np.array([30.0, 30.0]), np.array([0.07, 0.07]), Body(), s)[1]
    assert np.allclose(one["temp"], two["temp"])
    assert np.all(np.diff(one["z"]) > 0) and 50 < one["temp"].min() < one["temp"].max() < 420


def test_depth_grid_grows_by_a_constant_ratio():
    z = thermal.depth_grid(0.12, 0.0, Body(), thermal.Solver())
    dz = np.diff(z)
    assert dz[1:] / dz[:-1] == pytest.approx(np.full(len(dz) - 1, 1.1))


def test_profiles_start_at_noon(spark):
    out = thermal.profile_table(thermal.simulate(thermal.sweep(spark, [0.0], [0.12], [0.07]), solver=thermal.Solver(years=0.0)), 24)
    top = {r.ltst: r.temp for r in out.where("layer = 0").collect()}
    assert len(top) == 24 and top[12.0] > top[0.0]


def test_brightness_against_a_loop(spark):
    temp, dz, rho = [250.0, 240.0, 235.0, 230.0], [0.01, 0.02, 0.03, 0.05], [1100.0, 1300.0, 1500.0, 1700.0]
    df = spark.createDataFrame(list(zip([1] * 4, range(4), temp, dz, rho)), "run int, layer int, temp double, dz double, rho double")
    got = brightness.brightness_temperature(brightness.cross_settings(df, [7.8], [2.0]), ["run", "freq", "c"], path="dz").first()["tb"]
    f = 7.8e9
    n = [math.sqrt(1.92 ** (r / 1000)) for r in rho]
    k = [2 * math.pi * f / LIGHT_SPEED * m * 10 ** (0.312 * r / 1000 - 2.0) for m, r in zip(n, rho)]
    att = [math.exp(-d * x) for d, x in zip(dz, k)]
    ref = [((b - a) / (b + a)) ** 2 for a, b in zip(n, n[1:])] + [0.0]
    top = ((n[0] - 1) / (n[0] + 1)) ** 2
    total, product = 0.0, 1 - top
    for i in range(4):
        total += (1 - att[i]) * (1 + ref[i] * att[i]) * product / (math.exp(PLANCK * f / BOLTZMANN / temp[i]) - 1)
        before = top if i == 0 else ref[i - 1]
        product *= (1 - ref[i]) * att[i] / (1 - before * ref[i] * att[i] ** 2)
    want = PLANCK * f / BOLTZMANN / math.log(1 / total + 1) + (temp[3] + (temp[3] - temp[2]) * 2 / (dz[2] + dz[3]) / k[3]) * product
    assert got == pytest.approx(want)
    with pytest.raises(ValueError):
        brightness.layer_weights(df, ["run"], path="z")


def test_vectors_and_local_time(spark):
    df = spark.createDataFrame([(10.0, 20.0, 100.0, 0.0)], "lat double, lon double, d double, et double")
    out = ephemeris.with_vectors(df)
    assert ephemeris.height_error(out).first()[0] < 1e-9
    r = out.first()
    assert r.nx**2 + r.ny**2 + r.nz**2 == pytest.approx(1) and r.ltst == pytest.approx(20 / 360 + 0.5)


def test_modelled_map_crosses_midnight(spark):
    table = spark.createDataFrame([(float(la), float(al), float(h), float(t), float(la + 100 * al + (t if t <= 12 else 24 - t))) for la in (0, 60) for al in (0, 0.2) for h in (0.02, 0.13) for t in range(24)], "lat double, albedo double, h double, ltst double, tb double")
    cells = spark.createDataFrame([(0, 0, -30.0, 0.05, 0.07, 0.0, 0.0), (0, 1, 30.0, 0.05, 0.07, 22.5, 90.0)], "lat_ix int, lon_ix int, lat double, albedo double, h double, slope double, azimuth double")
    got = {r.lon_ix: r.tb for r in maps.modelled_map(cells, table, 23.5).collect()}
    albedo = -18 * 0.05**2 + 3.39 * 0.05 + 0.00427
    assert got[0] == pytest.approx(30 + 100 * albedo + 0.5)
    assert got[1] == pytest.approx(30 + 100 * albedo + 1.0)


def test_failed_points_keep_their_error(spark):
    bad = spark.createDataFrame([(0, float("nan"), 0.1, 0.07)], "run long, lat double, albedo double, h double")
    r = thermal.simulate(bad).first()
    assert r.error is not None and r.layer is None
    assert thermal.profile_table(thermal.simulate(bad)).where(F.col("run") == 0).count() == 0


def test_catalogued_bodies():
    from gridlark.schema import BODIES, BODY_COLUMNS, Body, body

    moon = dict(zip(BODY_COLUMNS, BODIES["Moon"]))
    assert body("Moon") == Body() and all(moon[c] == getattr(Body(), c) for c in ("albedo", "emissivity", "solar_constant", "day", "year", "eccentricity", "obliquity"))
    assert 5.2 < body("Europa").distance_au < 5.21 and body("Bennu").k_depth == Body().k_depth
    try:
        body("Venus")
    except KeyError:
        return
    raise AssertionError("Venus has no solid parameters")
