"""Interpolation in one and four dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlark.functions.units import clip


def interp_array(values: Column, at: Column) -> Column:
    """The value at a fractional index of an array, linear between elements, constant beyond its ends."""
    last = F.size(values) - 1
    x = F.least(F.greatest(at, F.lit(0.0)), last.cast("double"))
    i = F.floor(x).cast("int")
    lo, hi = F.get(values, i), F.get(values, F.least(i + 1, last))
    return lo + (hi - lo) * (x - i)


def resample(values: Column, samples: int) -> Column:
    """An array of `samples` values at evenly spaced indices from 0 to size, ends included."""
    def at(k: Column) -> Column:
        return interp_array(values, k * F.size(values) / F.lit(float(samples - 1)))

    return F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: at(k.cast("double")))


def regular_series(df: DataFrame, axis: str, value: str, step: float, keys: list[str] | None = None) -> DataFrame:
    """Linear interpolation of a series at axis values from its least on, by `step`: each row covers up to the next one."""
    w = Window.partitionBy(*(keys or [])).orderBy(axis)
    first = F.min(axis).over(Window.partitionBy(*(keys or [])))
    held = df.select(*(keys or []), axis, value, F.lead(axis).over(w).alias("_ax"), F.lead(value).over(w).alias("_v"), first.alias("_first"))
    lo = F.ceil((F.col(axis) - F.col("_first")) / step)
    hi = F.when(F.col("_ax").isNull(), lo).otherwise(F.ceil((F.col("_ax") - F.col("_first")) / step) - 1)
    here = held.where(hi >= lo).withColumn("_k", F.explode(F.sequence(lo, hi)))
    x = F.col("_first") + F.col("_k") * step
    share = F.when(F.col("_ax") > F.col(axis), (x - F.col(axis)) / (F.col("_ax") - F.col(axis))).otherwise(F.lit(0.0))
    here = here.where(F.col("_ax").isNotNull() | (x == F.col(axis)))
    return here.select(*(keys or []), x.alias(axis), (F.col(value) + share * (F.coalesce("_v", F.col(value)) - F.col(value))).alias(value))


#: Values that a model axis may have, and lattice cells that may be broadcast; with more, the join is left to Spark.
MOST_AXIS, BROADCAST_CELLS = 10_000, 50_000


def axis_of(table: DataFrame, column: str) -> list[float]:
    """The sorted distinct values of a model axis; raises if they are too many for one."""
    rows = table.select(column).distinct().limit(MOST_AXIS + 1).collect()
    if len(rows) > MOST_AXIS:
        raise ValueError(f"{column} has more than {MOST_AXIS} values: no model axis")
    return sorted(r[0] for r in rows)


def _bracket(x: Column, axis: list[float]) -> tuple[Column, Column]:
    """The index of the axis interval that holds x, and x's share of it."""
    if len(axis) == 1:
        return F.lit(0), F.lit(0.0)
    pts = F.array(*[F.lit(float(a)) for a in axis])
    inside = clip(x.cast("double"), float(axis[0]), float(axis[-1]))
    below = F.size(F.filter(pts, lambda a: a <= inside)) - 1
    i = F.least(below, F.lit(len(axis) - 2))
    lo, hi = F.get(pts, i), F.get(pts, i + 1)
    return i, (inside - lo) / (hi - lo)


def corner_table(table: DataFrame, lattice: dict[str, list[float]], value: str) -> DataFrame:
    """(_k_ of each axis, _corners): a row a lattice cell, with the table's values at its 2^n corners; bit j of a corner's place is its side on axis j."""
    axes = list(lattice)
    at = {t: F.array_position(F.array(*[F.lit(float(a)) for a in lattice[t]]), F.col(t).cast("double")) - 1 for t in axes}
    points = table.select(F.col(value).cast("double").alias("_v"), *[at[t].cast("int").alias(f"_k_{t}") for t in axes])
    spread = points.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(2 ** len(axes) - 1))))
    lower = {f"_k_{t}": (F.col(f"_k_{t}") - F.shiftright("_c", j).bitwiseAND(F.lit(1))).cast("int") for j, t in enumerate(axes)}
    spread = spread.withColumns(lower).where(reduce(lambda a, b: a & b, [F.col(f"_k_{t}").between(0, max(0, len(lattice[t]) - 2)) for t in axes]))
    corners = F.array(*[F.max(F.when(F.col("_c") == i, F.col("_v"))) for i in range(2 ** len(axes))])
    return spread.groupBy(*lower).agg(corners.alias("_corners"))


def multilinear(points: DataFrame, table: DataFrame, axes: dict[str, str], value: str, out: str) -> DataFrame:
    """points with `out`, interpolated in a complete regular table; inputs are clipped to the axes, null ones give null.

    axes: column of points to column of table. A point meets the one lattice
    cell that holds it, by an equi-join on axis indices.
    """
    lattice = {t: axis_of(table, t) for t in axes.values()}
    located = points
    for p, t in axes.items():
        i, share = _bracket(F.col(p), lattice[t])
        located = located.withColumns({f"_k_{t}": F.when(F.col(p).isNotNull(), i).cast("int"), f"_s_{t}": share})
    cells = corner_table(table, lattice, value)
    if reduce(lambda a, b: a * b, [max(1, len(v) - 1) for v in lattice.values()]) <= BROADCAST_CELLS:
        cells = F.broadcast(cells)
    joined = located.join(cells, [f"_k_{t}" for t in lattice], "left")

    def part(i: int) -> Column:
        side = lambda j, t: F.col(f"_s_{t}") if i >> j & 1 else 1 - F.col(f"_s_{t}")
        w = reduce(lambda a, b: a * b, [side(j, t) for j, t in enumerate(lattice)])
        return F.when(w > 0, w * F.get("_corners", F.lit(i))).otherwise(F.lit(0.0))

    total = reduce(lambda a, b: a + b, [part(i) for i in range(2 ** len(lattice))])
    return joined.withColumn(out, F.when(F.col("_corners").isNotNull(), total)).select(*points.columns, out)
