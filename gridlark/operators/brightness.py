"""Radiative transfer: layered temperatures to brightness temperatures, in window functions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlark.schema import BOLTZMANN, LIGHT_SPEED, PLANCK


@dataclass(frozen=True)
class Loss:
    """Terms of the loss tangent: 10 ** (a * tio2 + b * rho / 1000 - c)."""

    tio2: float = 0.0
    a: float = 0.0
    b: float = 0.312
    c: float = 2.5


def permittivity(rho: Column) -> Column:
    return F.pow(F.lit(1.92), rho / 1000)


def loss_tangent(rho: Column, loss: Loss, c: Column | None = None) -> Column:
    return F.pow(F.lit(10.0), F.lit(loss.a * loss.tio2) + loss.b * rho / 1000 - (F.lit(loss.c) if c is None else c))


def absorption(rho: Column, ghz: Column, loss: Loss, c: Column | None = None) -> Column:
    """Attenuation coefficient of a layer, 1/m."""
    return 2 * math.pi * ghz * 1e9 / LIGHT_SPEED * F.sqrt(permittivity(rho)) * loss_tangent(rho, loss, c)


def cross_settings(layers: DataFrame, ghz: list[float], c: list[float]) -> DataFrame:
    """Every layer with every frequency and loss constant: an explode, no join."""
    pick = lambda v: F.array(*[F.lit(float(x)) for x in v])
    return layers.withColumn("freq", F.explode(pick(ghz))).withColumn("c", F.explode(pick(c)))


def layer_weights(layers: DataFrame, keys: list[str], loss: Loss = Loss(), path: str = "rho") -> DataFrame:
    """layers (keys, layer, rho, dz, freq, c) with `weight`, `coeff`, `rest` and `surface`.

    path names the quantity that is multiplied with the coefficient in a
    layer's attenuation: "rho" as the published maps were made, or "dz".
    `rest` is what of the radiation from below a layer's bottom goes through it
    and all above. Products over the layers above are sums of logarithms.
    """
    if path not in ("rho", "dz"):
        raise ValueError(f"path must be rho or dz, not {path}")
    w = Window.partitionBy(*keys).orderBy("layer")
    above = w.rowsBetween(Window.unboundedPreceding, -1)
    through = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = layers.withColumns({"coeff": absorption(F.col("rho"), F.col("freq"), loss, F.col("c")), "_n": F.sqrt(permittivity(F.col("rho")))})
    ratio = lambda a, b: F.pow((a - b) / (a + b), F.lit(2))
    out = out.withColumns({
        "_att": F.exp(-F.col(path) * F.col("coeff")),
        "_ref": F.coalesce(ratio(F.lead("_n").over(w), F.col("_n")), F.lit(0.0)),
        "surface": ratio(F.first("_n").over(whole), F.lit(1.0)),
    })
    out = out.withColumn("_mult", 1 - F.coalesce(F.lag("_ref").over(w), F.col("surface")) * F.col("_ref") * F.col("_att") * F.col("_att"))
    log = F.log(1 - F.col("_ref")) + F.log("_att") - F.log("_mult")
    product = lambda frame: F.exp(F.coalesce(F.sum("_log").over(frame), F.lit(0.0)))
    out = out.withColumn("_log", log)
    weight = (1 - F.col("_att")) * (1 + F.col("_ref") * F.col("_att")) * (1 - F.col("surface")) * product(above)
    return out.withColumns({"weight": weight, "rest": (1 - F.col("surface")) * product(through)}).drop("_n", "_att", "_ref", "_mult", "_log")


def brightness_temperature(layers: DataFrame, keys: list[str], loss: Loss = Loss(), path: str = "rho") -> DataFrame:
    """(keys, tb). layers: keys, layer, temp, dz, rho, freq, c; two layers or more."""
    w = Window.partitionBy(*keys).orderBy("layer")
    held = layer_weights(layers, keys, loss, path).withColumns({"_t1": F.lag("temp").over(w), "_d1": F.lag("dz").over(w)})
    quantum = PLANCK / BOLTZMANN * 1e9 * F.col("freq")
    radiance = F.sum(F.col("weight") / (F.exp(quantum / F.col("temp")) - 1))
    below = F.col("temp") + (F.col("temp") - F.col("_t1")) * 2 / (F.col("dz") + F.col("_d1")) / F.col("coeff")
    summed = held.groupBy(*keys).agg(radiance.alias("_rad"), F.first(PLANCK / BOLTZMANN * 1e9 * F.col("freq")).alias("_q"), F.max_by(below * F.col("rest"), "layer").alias("_below"))
    return summed.select(*keys, (F.col("_q") / F.log(1 / F.col("_rad") + 1) + F.col("_below")).alias("tb"))
