"""Closed forms of the thermal model as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlark.functions.units import layer_albedo
from gridlark.schema import STEFAN_BOLTZMANN, Body


def heat_capacity(t: Column, terms: tuple[float, ...] = Body().cp_terms) -> Column:
    """Polynomial in temperature, highest power first (Horner's form)."""
    out = F.lit(float(terms[0]))
    for c in terms[1:]:
        out = out * t + float(c)
    return out


def conductivity(t: Column, kc: Column, chi: float = 2.7) -> Column:
    return kc * (F.lit(1.0) + F.pow(t, F.lit(3)) * (chi / 350**3))


def depth_profile(z: Column, surface: float, depth: float, h: Column | float) -> Column:
    """A quantity that goes from its surface value to its value at depth over e-folding scale h."""
    return F.lit(depth) - (depth - surface) * F.exp(-z / F.lit(h))


def radiative_temperature(albedo: Column, lat_rad: Column, body: Body = Body()) -> Column:
    """Equilibrium temperature at local noon."""
    return F.pow((1 - albedo) / (STEFAN_BOLTZMANN * body.distance_au**2) * body.solar_constant * F.cos(lat_rad), F.lit(0.25))


def mean_equilibrium_temperature(lat_deg: Column, body: Body = Body()) -> Column:
    flux = (1 - body.albedo) * body.solar_constant / (4 * body.emissivity * STEFAN_BOLTZMANN)
    return F.pow(F.lit(flux) * F.cos(F.radians(lat_deg)), F.lit(0.25))


def skin_depth(t: Column, body: Body = Body()) -> Column:
    return F.sqrt(F.lit(body.k_surface) / (body.rho_surface * heat_capacity(t, body.cp_terms)) * (body.day / math.pi))


def cos_incidence(lat: Column, declination: Column, hour_angle: Column) -> Column:
    """Cosine of the solar incidence angle, zero with the Sun below the horizon; radians."""
    raw = F.sin(lat) * F.sin(declination) + F.cos(lat) * F.cos(declination) * F.cos(hour_angle)
    return F.greatest(F.lit(0.0), raw)


def surface_flux(t: Column, lat: Column, declination: Column, distance: Column, albedo: Column, body: Body = Body()) -> Column:
    """Absorbed flux at time t in seconds after noon."""
    c = cos_incidence(lat, declination, t * (2 * math.pi / body.day))
    share = (1 - layer_albedo(albedo, F.acos(c), *body.albedo_slope)) / (1 - albedo)
    absorbed = (1 - albedo) * body.solar_constant
    return share * absorbed * F.pow(distance / body.distance_au, F.lit(-2)) * c


def orbit_distance(nu: Column, body: Body = Body()) -> Column:
    return F.lit(body.distance_au * (1 - body.eccentricity**2)) / (1 + body.eccentricity * F.cos(nu))


def orbit_declination(nu: Column, body: Body = Body()) -> Column:
    return F.asin(math.sin(body.obliquity) * F.sin(nu + body.perihelion))
