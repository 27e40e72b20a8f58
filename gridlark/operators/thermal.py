"""One-dimensional heat flow in a layered surface, many parameter points at a time.

The sweep is a DataFrame of points; each task steps all the points of a batch
together with numpy, one column a point. Points of different depth grids (the
grid follows from albedo and latitude) are padded to the deepest one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.functions.units import rotate_hours
from gridlark.operators.interpolate import resample
from gridlark.schema import GM_SUN_AU3_S2, STEFAN_BOLTZMANN, Body

CHI = 2.7


@dataclass(frozen=True)
class Solver:
    """Numerical settings of the model."""

    mesh_number: float = 0.49
    surface_accuracy: float = 0.01
    layers_per_skin: int = 10
    growth: int = 10
    skins: int = 20
    years: float = 1.0
    days: int = 1
    steps_per_day: int = 24
    warmth_scale: float = 0.1


def sweep(spark: SparkSession, lat: Sequence[float], albedo: Sequence[float], h: Sequence[float]) -> DataFrame:
    """The cartesian product of the axes (lat in degrees), with a run number."""
    n = len(lat) * len(albedo) * len(h)
    i = F.col("id")
    pick = lambda values, at: F.get(F.array(*[F.lit(float(v)) for v in values]), at.cast("int"))
    return spark.range(n, numPartitions=max(1, min(n, spark.sparkContext.defaultParallelism))).select(
        i.alias("run"), pick(lat, F.floor(i / (len(albedo) * len(h)))).alias("lat"), pick(albedo, F.floor(i / len(h)) % len(albedo)).alias("albedo"), pick(h, i % len(h)).alias("h")
    )


def _capacity(t: np.ndarray, body: Body) -> np.ndarray:
    return np.polyval(body.cp_terms, t)


def depth_grid(albedo: float, lat: float, body: Body, s: Solver) -> np.ndarray:
    """Depths of the layers: thickness grows by 1 + 1 / growth from a fraction of the skin depth; lat in radians."""
    noon = ((1 - albedo) * body.solar_constant * math.cos(lat) / (STEFAN_BOLTZMANN * body.distance_au**2)) ** 0.25
    skin = math.sqrt(body.k_surface / (body.rho_surface * float(_capacity(np.array(noon), body))) * body.day / math.pi)
    ratio, first = 1 + 1 / s.growth, skin / s.layers_per_skin
    # depth of layer i is first * (ratio^i - 1) / (ratio - 1)
    layers = math.ceil(math.log(1 + skin * s.skins * (ratio - 1) / first) / math.log(ratio) - 1e-12)
    return first * (ratio ** np.arange(layers + 1) - 1) / (ratio - 1)


class Column1D:
    """The state of a set of runs with equal layer counts: arrays of (layer, run)."""

    def __init__(self, albedo: np.ndarray, lat: np.ndarray, h: np.ndarray, z: np.ndarray, body: Body, s: Solver):
        self.body, self.s, self.albedo, self.lat = body, s, albedo, lat
        self.z, self.dz = z, np.diff(z, axis=0)
        e = np.exp(-z / h)
        self.kc = body.k_depth - (body.k_depth - body.k_surface) * e
        self.rho = body.rho_depth - (body.rho_depth - body.rho_surface) * e
        up, down = self.dz[:-1], self.dz[1:]
        self.g_up, self.g_down = 2 / (up * (up + down)), 2 / (down * (up + down))
        noon = ((1 - albedo) * body.solar_constant * np.cos(lat) / (STEFAN_BOLTZMANN * body.distance_au**2)) ** 0.25
        deep = noon / math.sqrt(2)
        self.temp = deep - (deep - noon) * np.exp(-z / s.warmth_scale)
        self.k, self.cp = self._thermals()
        self.nu = 0.0
        self.semi = body.distance_au * (1 - body.eccentricity**2)
        self.sweep_rate = math.sqrt(self.semi * GM_SUN_AU3_S2)
        self.absorbed = (1 - albedo) * body.solar_constant

    def _thermals(self) -> tuple[np.ndarray, np.ndarray]:
        return self.kc * (1 + CHI / 350**3 * self.temp**3), _capacity(self.temp, self.body)

    def largest_step(self) -> float:
        return float(np.min(self.s.mesh_number * self.rho[:-1] * self.cp[:-1] * self.dz**2 / self.k[:-1]))

    def flux(self, t: float) -> tuple[np.ndarray, float]:
        b = self.body
        r = self.semi / (1 + b.eccentricity * math.cos(self.nu))
        dec = math.asin(math.sin(b.obliquity) * math.sin(self.nu + b.perihelion))
        c = np.maximum(0.0, np.sin(self.lat) * math.sin(dec) + np.cos(self.lat) * math.cos(dec) * math.cos(2 * math.pi * t / b.day))
        i = np.arccos(np.minimum(c, 1.0))
        albedo = self.albedo + b.albedo_slope[0] * (i / math.pi * 4) ** 3 + b.albedo_slope[1] * (i / math.pi * 2) ** 8
        return (1 - albedo) / (1 - self.albedo) * self.absorbed * (r / b.distance_au) ** -2 * c, r

    def surface(self, flux: np.ndarray) -> np.ndarray:
        """Newton steps for the radiating boundary, each run until its own step is small."""
        b, two = self.body, 2 * self.dz[0]
        slope = self.kc[0] * CHI / 350**3
        ts, limit = self.temp[0].copy(), self.s.surface_accuracy * self.temp[0]
        active = np.ones(len(ts), bool)
        for _ in range(100):
            grad = (4 * self.temp[1] - self.temp[2] - 3 * ts) / two
            out = b.emissivity * STEFAN_BOLTZMANN * ts**4
            k = self.kc[0] + slope * ts**3
            miss = out - flux - k * grad
            step = -miss / (4 * out / ts + 3 * k / two - 3 * slope * ts**2 * grad)
            ts = np.where(active, ts + step, ts)
            active &= np.abs(step) > limit
            if not active.any():
                break
        return ts

    def advance(self, t: float, dt: float) -> None:
        flux, r = self.flux(t)
        self.nu += r**-2 * dt * self.sweep_rate
        into, out = self.g_up * self.k[:-2], self.g_down * self.k[1:-1]
        # layers are updated from the top down: a layer sees its upper neighbour's new temperature
        fixed = (dt / (self.rho * self.cp))[1:-1]
        for i in range(1, len(self.temp) - 2):
            above, own, below = self.temp[i - 1], self.temp[i], self.temp[i + 1]
            self.temp[i] = own + fixed[i - 1] * (into[i - 1] * (above - own) + out[i - 1] * (below - own))
        self.temp[0] = self.surface(flux)
        self.temp[-2] = self.temp[-3] + self.body.heat_flow / ((self.k[-2] + self.k[-3]) / 2) * self.dz[-1]
        self.k, self.cp = self._thermals()


def run_models(albedo: np.ndarray, lat_deg: np.ndarray, h: np.ndarray, body: Body, s: Solver) -> list[dict]:
    """One dict a run: z, dz, rho (last layer dropped) and temp as (layer, time) after equilibration."""
    lat = np.radians(lat_deg)
    grids = [depth_grid(a, la, body, s) for a, la in zip(albedo, lat)]
    out: list[dict | None] = [None] * len(grids)
    for layers in {len(g) for g in grids}:
        rows = np.array([i for i, g in enumerate(grids) if len(g) == layers])
        c = Column1D(albedo[rows], lat[rows], h[rows], np.stack([grids[i] for i in rows], axis=1), body, s)
        total = s.years * body.year
        total -= total % body.day
        t, dt = 0.0, c.largest_step()
        while t < total:
            c.advance(t, dt)
            t += dt
        step = min(dt, body.day / s.steps_per_day)
        n = int(s.days * body.day / step)
        temps, t = np.empty((n, layers, len(rows))), 0.0
        for k in range(n):
            c.advance(t, step)
            temps[k] = c.temp
            t += step
        for j, i in enumerate(rows):
            out[i] = {"z": c.z[:-1, j], "dz": c.dz[:, j], "rho": c.rho[:-1, j], "temp": temps[:, :-1, j].T}
    return out


def simulate(points: DataFrame, body: Body = Body(), solver: Solver = Solver()) -> DataFrame:
    """(run, lat, albedo, h, layer, z, dz, rho, temps, error): temps over one day from noon. A failed batch gives its error in place of layers."""
    schema = "run long, lat double, albedo double, h double, layer int, z double, dz double, rho double, temps array<double>, error string"
    names = ["run", "lat", "albedo", "h", "layer", "z", "dz", "rho", "temps", "error"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in frames:
            if not len(p):
                continue
            rows = []
            try:
                made = run_models(p["albedo"].to_numpy(float), p["lat"].to_numpy(float), p["h"].to_numpy(float), body, solver)
                for point, m in zip(p.itertuples(), made):
                    rows.extend((point.run, point.lat, point.albedo, point.h, i, m["z"][i], m["dz"][i], m["rho"][i], m["temp"][i].tolist(), None) for i in range(len(m["z"])))
            except (ArithmeticError, ValueError, np.linalg.LinAlgError) as e:
                rows = [(q.run, q.lat, q.albedo, q.h, None, None, None, None, None, repr(e)) for q in p.itertuples()]
            yield pd.DataFrame(rows, columns=names).astype({"layer": "Int32"})

    return points.select("run", "lat", "albedo", "h").mapInPandas(work, schema)


def profile_table(simulated: DataFrame, samples: int = 240) -> DataFrame:
    """(run, lat, albedo, h, layer, z, dz, rho, ltst, temp): `samples` local times in hours, 0 at midnight."""
    held = simulated.where("error is null").withColumn("_t", resample(F.col("temps"), samples))
    flat = held.select("run", "lat", "albedo", "h", "layer", "z", "dz", "rho", F.posexplode("_t").alias("_i", "temp"))
    return flat.withColumn("ltst", rotate_hours(F.col("_i") * F.lit(24.0 / samples))).drop("_i")
