"""Declared schemas, physical constants and instrument parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of a raw per-orbit table, in file order.
RAW_COLUMNS = ["time", "t1", "t2", "t3", "t4", "theta", "phi", "lon", "lat", "d", "flag"]
CHANNELS = ("t1", "t2", "t3", "t4")

_KINDS = {"int": T.IntegerType(), "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "timestamp_ntz": T.TimestampNTZType()}


def _schema(**columns: str) -> T.StructType:
    """A schema from type name = space-separated columns."""
    return T.StructType([T.StructField(c, _KINDS[kind.rstrip("_")]) for kind, names in columns.items() for c in names.split()])


#: The sample table.
SAMPLES = T.StructType([
    *_schema(int="orbit", timestamp_ntz="utc", double="jd", string="tdb", double_="et"),
    *_schema(float="ltst t1 t2 t3 t4 theta phi lat lon d", double="bx by bz cx cy cz mx my mz nx ny nz", float_="ox oy", int="flag", string="orbiter"),
])

# Physical constants (SI unless named otherwise).
LIGHT_SPEED, PLANCK, BOLTZMANN, STEFAN_BOLTZMANN = 299792458.0, 6.62607015e-34, 1.380649e-23, 5.670374419e-08
MOON_RADIUS_KM = 1737.4
GM_SUN_AU3_S2 = 3.96423e-14

#: Nominal frequency of each channel, GHz.
CHANNEL_GHZ = {1: 3.0, 2: 7.8, 3: 19.35, 4: 37.0}


@dataclass(frozen=True)
class Antenna:
    """Parameters of a channel's antenna pattern."""

    main_width: float
    sigma: float
    main_power: float
    side_peak: float
    side_ratio: float


# Antenna parameters of each channel.
ANTENNAS = {
    1: Antenna(32.2, 7.6, -16.5, -14.8, 0.53),
    2: Antenna(24.0, 4.5, -36.0, -16.7, 0.67),
    3: Antenna(24.0, 5.5, -18.0, -17.0, 0.2),
    4: Antenna(26.0, 5.3, -30.0, -20.0, 0.23),
}


@dataclass(frozen=True)
class Body:
    """A planetary body for the heat-flow model; the defaults are the Moon's (fixed values)."""

    name: str = "Moon"
    solar_constant: float = 1361.0
    albedo: float = 0.12
    albedo_slope: tuple[float, float] = (0.06, 0.25)
    emissivity: float = 0.95
    heat_flow: float = 0.018
    k_surface: float = 7.4e-4
    k_depth: float = 3.4e-3
    rho_surface: float = 1100.0
    rho_depth: float = 1800.0
    h: float = 0.07
    cp_terms: tuple[float, ...] = (8.9093e-9, -1.234e-5, 2.3616e-3, 2.7431, -3.6125)
    distance_au: float = 1.0
    eccentricity: float = 0.0167
    obliquity: float = 0.026878
    perihelion: float = 0.0
    day: float = 29.53059 * 86400.0
    year: float = 365.256 * 86400.0


_DAY, _HOUR, AU = 86400.0, 3600.0, 149597870700.0
# Surface gravity (m/s2), Bond albedo, emissivity, solar constant (W/m2), semi-major axis (m),
# sidereal year (s), eccentricity, solar day (s), obliquity as catalogued (degrees or radians).
BODIES = {
    "Mercury": (3.70, 0.119, 0.95, 9126.6, 57.91e9, 87.969 * _DAY, 0.2056, 4222.6 * _HOUR, 0.01),
    "Venus": (8.87, 0.750, 0.95, 2613.9, 108.21e9, 224.701 * _DAY, 0.0067, 2802.0 * _HOUR, 177.36),
    "Earth": (9.798, 0.306, 0.95, 1361.0, 149.60e9, 365.256 * _DAY, 0.0167, 24.0 * _HOUR, 23.45),
    "Mars": (3.71, 0.250, 0.95, 589.2, 227.92e9, 686.98 * _DAY, 0.0935, 24.6597 * _HOUR, 25.19),
    "Jupiter": (24.79, 0.343, None, 50.5, 778.57e9, 4332.0 * _DAY, 0.0, 9.9259 * _HOUR, 0.0546288),
    "Saturn": (10.44, 0.342, None, 14.90, 1433.0e9, 10759.0 * _DAY, 0.0565, 10.656 * _HOUR, 26.73),
    "Uranus": (8.87, 0.300, None, 3.71, 2872.46e9, 30685.4 * _DAY, 0.0457, 17.24 * _HOUR, 97.77),
    "Neptune": (11.15, 0.290, None, 1.51, 4495.06e9, 60189.0 * _DAY, 0.0113, 16.11 * _HOUR, 28.32),
    "Pluto": (0.58, 0.5, 0.95, 0.89, 5906.0e9, 90465.0 * _DAY, 0.2488, 153.2820 * _HOUR, 122.53),
    "Moon": (1.62, 0.12, 0.95, 1361.0, 149.60e9, 365.256 * _DAY, 0.0167, 29.53059 * _DAY, 0.026878),
    "Titan": (1.35, 0.22, 0.95, 14.90, 1433.0e9, 10759.0 * _DAY, 0.0565, 15.9452 * _DAY, 26.73),
    "Europa": (1.31, 0.6, 0.90, 50.5, 778.57e9, 4332.0 * _DAY, 0.0, 3.06822e5, 0.0546288),
    "Ganymede": (1.43, 0.4, 0.90, 50.5, 778.57e9, 4332.0 * _DAY, 0.0, 6.18192e5, 0.0546288),
    "Triton": (0.78, 0.76, 0.95, 1.51, 4495.06e9, 60189.0 * _DAY, 0.0113, 5.877 * _DAY, 156.0),
    "Bennu": (1.0e-5, 0.045, 0.95, 1072.7, 1.685e11, 365.256 * _DAY, 0.204, 15469.2, 3.106686),
}
BODY_COLUMNS = ("gravity", "albedo", "emissivity", "solar_constant", "semi_major_m", "year", "eccentricity", "day", "obliquity")
# Heat flow (W/m2), conductivity at the surface and at depth, density likewise, e-folding scale (m), heat capacity polynomial.
_ICE = (0.030, 2e-3, 1e-2, 100.0, 450.0, 0.07, (90.0, 7.49))
SOLIDS = {"Europa": _ICE, "Ganymede": _ICE, "Bennu": (0.0, 7.4e-4, 3.4e-3, 1100.0, 1800.0, 0.07, Body.cp_terms)}


def body(name: str) -> Body:
    """The model's parameters of a catalogued body with a solid surface; the Moon's are the defaults."""
    if name == "Moon":
        return Body()
    if name not in SOLIDS:
        raise KeyError(f"{name} has no thermal parameters")
    b, (flow, k_surface, k_depth, rho_surface, rho_depth, h, cp) = dict(zip(BODY_COLUMNS, BODIES[name])), SOLIDS[name]
    return Body(
        name=name, solar_constant=b["solar_constant"], albedo=b["albedo"], emissivity=b["emissivity"], heat_flow=flow, k_surface=k_surface, k_depth=k_depth,
        rho_surface=rho_surface, rho_depth=rho_depth, h=h, cp_terms=cp, distance_au=b["semi_major_m"] / AU, eccentricity=b["eccentricity"], obliquity=b["obliquity"], day=b["day"], year=b["year"],
    )


@dataclass(frozen=True)
class FlagRules:
    """Thresholds of the quality flags."""

    low_temp: float = 34.0
    channel_spread: float = 75.0
    min_orbit_size: int = 100
    bad_orbits: tuple[int, ...] = ()
    excluded: tuple[int, int] | None = None
    mad_limit: float = 8.0
    vote_percentile: float = 0.98
    min_tile_count: int = 10


@dataclass(frozen=True)
class MapSpec:
    """What a gridded map is made of: a frozen replacement for a stateful manager."""

    orbiter: str
    channel: int
    ltst_bounds: tuple[float, float] | None = None
    lat_bounds: tuple[float, float] = (-75.0, 75.0)
    lon_bounds: tuple[float, float] = (-180.0, 180.0)
    resolution: float = 0.25
    exclude_orbits: tuple[int, ...] = field(default=())
    unflagged: bool = True


def conform(df: DataFrame, schema: T.StructType = SAMPLES) -> DataFrame:
    """The schema's columns in its order and types; missing ones null, others dropped."""
    have = {c.lower(): c for c in df.columns}

    def pick(f: T.StructField) -> Column:
        value = F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)
        return value.cast(f.dataType).alias(f.name)

    return df.select(*[pick(f) for f in schema])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column: Spark orders NaN above all numbers."""
    fixed = [
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f.name)
        for f in df.schema
    ]
    return df.select(*fixed)
