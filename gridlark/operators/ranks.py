"""Exact quantiles in a few scans: a mergeable sketch brackets them, a count inside the brackets finds them.

The first scan merges KLL sketches, one a column, and counts. Of up to SKETCH
values a sketch holds all and is exact. With more, an order statistic lies between
the sketch's quantiles at its rank less and plus the sketch's error; the second
scan counts what lies before each bracket and how often each value in it occurs:
two scans for some ten million values. If brackets hold more than SORTED values,
what is inside them is counted by bins until few are left: two scans more, each of
a small share of the values. If a bracket should fail, all values are counted so.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sketches' k: values that are held exactly, and the share of ranks that a quantile may be off, at many times its usual error.
SKETCH, ERROR = 16384, 1.5e-3
#: Bins of a pass that counts ranks, and values that are sorted on the driver.
BINS, SORTED = 4096, 50_000


def _by_bins(held: DataFrame, ranks: list[int], lo: float, hi: float, n: int) -> dict[int, float]:
    """The values at these ranks (from 0) of column v, which has n values from lo to hi."""
    if lo == hi:
        return dict.fromkeys(ranks, lo)
    if n <= SORTED:
        v = np.sort(held.toArrow().column("v").to_numpy())
        return {r: float(v[r]) for r in ranks}
    # halves first: the range of two finite numbers may not be one
    place = F.least(F.lit(BINS - 1), F.floor((F.col("v") / 2 - lo / 2) / (hi / 2 - lo / 2) * BINS))
    bins = held.groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    out, below = {}, 0
    for x in sorted(bins, key=lambda x: x["b"]):
        own = [r - below for r in ranks if below <= r < below + x["n"]]
        if own:
            inside = held.where((F.col("v") >= x["lo"]) & (F.col("v") <= x["hi"]))
            out.update({r + below: v for r, v in _by_bins(inside, own, x["lo"], x["hi"], x["n"]).items()})
        below += x["n"]
    return out


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[list[float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _in_brackets(held: DataFrame, brackets: list[tuple[float, float]], ranks: list[int]) -> dict[int, float] | None:
    """The values at the ranks if all lie in the brackets and few values do: one scan, one row a value inside or a stretch outside."""
    v, region, value = F.col("v"), F.lit(2 * len(brackets)), F.lit(None).cast("double")
    for k, (lo, hi) in reversed(list(enumerate(brackets))):
        region = F.when(v < lo, F.lit(2 * k)).when(v <= hi, F.lit(2 * k + 1)).otherwise(region)
        value = F.when((v >= lo) & (v <= hi), v).otherwise(value)
    rows = held.groupBy(region.alias("region"), value.alias("value")).agg(F.count(F.lit(1)).alias("n")).limit(SORTED + 1).collect()
    if len(rows) > SORTED:
        return None
    rows.sort(key=lambda x: (x["region"], x["value"] is not None, x["value"] or 0.0))
    ends = np.cumsum([x["n"] for x in rows])
    out = {}
    for r in ranks:
        x = rows[int(np.searchsorted(ends, r, "right"))]
        if x["value"] is None:
            return None
        out[r] = x["value"]
    return out


def _narrowed(held: DataFrame, brackets: list[tuple[float, float]], ranks: list[int]) -> dict[int, float] | None:
    """The values at the ranks if all lie in the brackets: ranks are counted by bins inside them."""
    v = F.col("v")
    counts = held.agg(*[x for k, (lo, hi) in enumerate(brackets) for x in (F.count(F.when(v < lo, 1)).alias(f"below{k}"), F.count(F.when((v >= lo) & (v <= hi), 1)).alias(f"inside{k}"))]).first()
    out = {}
    for k, (lo, hi) in enumerate(brackets):
        below, inside = counts[f"below{k}"], counts[f"inside{k}"]
        own = sorted({r - below for r in ranks if below <= r < below + inside})
        if own:
            out.update({r + below: x for r, x in _by_bins(held.where((v >= lo) & (v <= hi)), own, lo, hi, inside).items()})
    return out if set(ranks) <= set(out) else None


def exact_quantiles(df: DataFrame, columns: Mapping[str, Column], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Of each column the quantiles, linear between ranks; null and NaN don't count, and a column without values has None."""
    held = df.select(*[c.cast("double").alias(k) for k, c in columns.items()])
    held = held.select(*[F.when(~F.isnan(k), F.col(k) + F.lit(0.0)).alias(k) for k in columns])
    found = held.agg(*[F.struct(F.count(k).alias("n"), F.min(k).alias("lo"), F.max(k).alias("hi"), F.kll_sketch_agg_double(k, SKETCH).alias("sketch")).alias(k) for k in columns]).first()
    # the sketches, a few hundred KB each, answer on the driver: such a projection of constants is folded and is no job
    asked = {}
    for k in columns:
        if n := found[k]["n"]:
            at = [(n - 1) * p for p in shares]
            near = [min(1.0, max(0.0, (r + 0.5) / n + off)) for x in at for r in (math.floor(x), math.ceil(x)) for off in (-ERROR, 0.0, ERROR)]
            asked[k] = F.kll_sketch_get_quantile_double(F.lit(bytearray(found[k]["sketch"])), F.array(*[F.lit(x) for x in near])).alias(k)
    answers = df.sparkSession.sql("SELECT 1").select(*asked.values()).first() if asked else None
    out: dict[str, list[float | None]] = {}
    for k in columns:
        n = found[k]["n"]
        if not n:
            out[k] = [None] * len(shares)
            continue
        q = answers[k]
        at = [(n - 1) * p for p in shares]
        ranks = [r for x in at for r in (math.floor(x), math.ceil(x))]
        if n <= SKETCH:
            got = {r: q[3 * i + 1] for i, r in enumerate(ranks)}
        else:
            own = held.select(F.col(k).alias("v")).where("v is not null")
            # the ends are known: brackets that reach them are open there
            brackets = [(q[3 * i] if (r + 0.5) / n > ERROR else found[k]["lo"], q[3 * i + 2] if (r + 0.5) / n < 1 - ERROR else found[k]["hi"]) for i, r in enumerate(ranks)]
            brackets = _merged(brackets)
            got = _in_brackets(own, brackets, ranks) or _narrowed(own, brackets, ranks) or _by_bins(own, sorted(set(ranks)), found[k]["lo"], found[k]["hi"], n)
        out[k] = [got[math.floor(x)] + (got[math.ceil(x)] - got[math.floor(x)]) * (x - math.floor(x)) for x in at]
    return out
