"""Residual maps, quantization and display numbers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlark.functions.units import clip, lat_model
from gridlark.operators.flags import fit_cosine_power
from gridlark.operators.ranks import exact_quantiles

CELL = ["lat_ix", "lon_ix"]
#: Latitudes of a grid.
MOST_ROWS = 100_000


def grid_residual(measured: DataFrame, model: DataFrame, keys: Sequence[str] = ("channel", "bin_start", *CELL), value: str = "value") -> DataFrame:
    """Measured minus modelled value of the cells that both have: an equi-join on the bin and cell indices."""
    right = model.select(*keys, F.col(value).alias("_model"))
    return measured.join(right, list(keys)).withColumn(value, F.col(value) - F.col("_model")).drop("_model")


def fit_latitude_trend(grid: DataFrame, value: str = "value", lat: str = "lat") -> tuple[float, float]:
    """a, b of a * cos(lat) ** b over all valid cells.

    Cells are first reduced to (latitude, n, sum): the least-squares solution
    depends on the cells of a latitude through these alone, and latitudes are
    as many as the grid has rows; more than MOST_ROWS raise.
    """
    rows = grid.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(F.abs(lat).alias("lat")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("double")).alias("s")).limit(MOST_ROWS + 1).collect()
    if not rows:
        raise ValueError("no valid cells")
    if len(rows) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} latitudes: no grid")
    rows.sort(key=lambda r: r["lat"])
    la, n, s = (np.array([r[k] for r in rows], float) for k in ("lat", "n", "s"))
    # weighting a latitude by its count: repeat sqrt(n) in both residual and derivative
    c = np.log(np.maximum(np.cos(np.radians(la)), 1e-12))
    a, b = fit_cosine_power(la, s / n)
    damp = 1e-3
    cost = lambda a, b: float((n * (s / n - a * np.exp(b * c)) ** 2).sum())
    now = cost(a, b)
    for _ in range(200):
        e = np.exp(b * c)
        j = np.stack([e, a * e * c], axis=1) * np.sqrt(n)[:, None]
        r = (s / n - a * e) * np.sqrt(n)
        h = j.T @ j
        step = np.linalg.solve(h + damp * np.diag(np.diag(h) + 1e-12), j.T @ r)
        new = cost(a + step[0], b + step[1])
        if new <= now:
            done = now - new <= 1e-14 * max(now, 1e-30)
            a, b, now, damp = a + step[0], b + step[1], new, damp / 4
            if done:
                break
        else:
            damp *= 8
            if damp > 1e12:
                break
    return float(a), float(b)


def latitude_residual(grid: DataFrame, a: float, b: float, value: str = "value", lat: str = "lat") -> DataFrame:
    return grid.withColumn(value, F.col(value) - lat_model(F.col(lat), a, b))


def r_squared(df: DataFrame, measured: str, fitted: str) -> DataFrame:
    """1 - residual sum of squares / total sum of squares."""
    held = df.where(F.col(measured).isNotNull() & F.col(fitted).isNotNull())
    mean = held.agg(F.avg(measured).alias("_mean"))
    sq = lambda c: F.sum(c * c)
    return held.crossJoin(F.broadcast(mean)).agg((1 - sq(F.col(measured) - F.col(fitted)) / sq(F.col(measured) - F.col("_mean"))).alias("r_squared"))


def max_difference(df: DataFrame, a: str, b: str) -> DataFrame:
    """Largest absolute and relative (percent) difference."""
    diff = F.abs(F.col(a) - F.col(b))
    return df.agg(F.max(diff).alias("max_abs"), F.max(F.try_divide(diff, F.abs(F.col(b))) * 100).alias("max_percent"))


BLANK = -32768


def quantize(df: DataFrame, value: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """df with q (16-bit steps from the least to the largest value; BLANK for null), scale and zero, per keys."""
    ok = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    held = df.withColumn("_v", ok)
    span = held.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    # -32767 .. 32767: the least 16-bit value stays free for BLANK
    span = span.withColumn("scale", F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / 65534.0).otherwise(F.lit(1.0))).withColumn("zero", (F.col("_hi") + F.col("_lo")) / 2).drop("_lo", "_hi")
    joined = held.join(span, list(keys)) if keys else held.crossJoin(F.broadcast(span))
    q = F.coalesce(F.round((F.col("_v") - F.col("zero")) / F.col("scale")), F.lit(BLANK)).cast("int")
    return joined.withColumn("q", q).drop("_v")


def dequantize(q: Column, scale: Column, zero: Column) -> Column:
    return F.when(q != BLANK, q * scale + zero)


def check_quantized(df: DataFrame, value: str = "value", most: float = 2e-3) -> DataFrame:
    """df, if the largest error is within bounds; raises otherwise (one pass)."""
    err = df.agg(F.max(F.abs(dequantize(F.col("q"), F.col("scale"), F.col("zero")) - F.col(value)))).first()[0]
    if err is not None and err > most:
        raise ValueError(f"quantization error {err} is above {most}")
    return df


def quantiles(df: DataFrame, value: str, shares: Sequence[float]) -> list[float | None]:
    """Exact quantiles, linear between ranks."""
    return exact_quantiles(df, {"v": F.col(value)}, shares)["v"]


def clip_percentiles(df: DataFrame, lo: float, hi: float, value: str = "value") -> DataFrame:
    a, b = quantiles(df, value, [lo, hi])
    return df if a is None else df.withColumn(value, clip(F.col(value), a, b))


def clip_sigma(df: DataFrame, times: float, value: str = "value") -> DataFrame:
    b = df.agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    return df.crossJoin(F.broadcast(b)).withColumn(value, clip(F.col(value), F.col("_m") - times * F.col("_s"), F.col("_m") + times * F.col("_s"))).drop("_m", "_s")


def centred_norm(df: DataFrame, value: str = "value", out: str = "shade") -> DataFrame:
    """Values less their mean, scaled to [0, 1] with the mean at one half: two slopes."""
    b = df.agg(F.avg(value).alias("_m"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    x = F.col(value) - F.col("_m")
    shade = F.when(x < 0, F.lit(0.5) + x / (F.col("_m") - F.col("_lo")) * 0.5).otherwise(F.lit(0.5) + F.coalesce(F.try_divide(x, F.col("_hi") - F.col("_m")), F.lit(0.0)) * 0.5)
    return df.crossJoin(F.broadcast(b)).withColumn(out, shade).drop("_m", "_lo", "_hi")


def plain_norm(df: DataFrame, value: str = "value", out: str = "shade") -> DataFrame:
    b = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return df.crossJoin(F.broadcast(b)).withColumn(out, F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")
