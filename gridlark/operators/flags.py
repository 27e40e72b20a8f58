"""Quality flags: an ordered chain of bits on an integer column `flag`.

Each step sees the rows that no step before it has flagged and adds its bit.
Per-orbit rules are aggregates over unflagged rows whose small results are
joined back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlark.functions.units import spread
from gridlark.operators.ranks import exact_quantiles
from gridlark.schema import CHANNELS, FlagRules
from gridlark.sources.scratch import written

MISSION, LOW_TEMP, SPREAD, BAD_ORBIT, SMALL_ORBIT, TIME_TWICE, EXCLUDED, LAT_MODEL, LAT_CUT = (1 << i for i in range(9))
Step = Callable[[DataFrame], DataFrame]


def add_bit(df: DataFrame, condition: Column, bit: int) -> DataFrame:
    """The bit where the condition holds in a row without a flag."""
    return df.withColumn("flag", F.col("flag") + F.when((F.col("flag") == 0) & F.coalesce(condition, F.lit(False)), F.lit(bit)).otherwise(F.lit(0)))


def flag_orbits(df: DataFrame, orbits: DataFrame, bit: int) -> DataFrame:
    """The bit in the rows of the given orbits."""
    hit = orbits.select("orbit").distinct().withColumn("_hit", F.lit(True))
    return add_bit(df.join(hit, "orbit", "left"), F.col("_hit"), bit).drop("_hit")


def unflagged(df: DataFrame) -> DataFrame:
    return df.where("flag = 0")


def mission(ok: dict[str, str], column: str = "mflag") -> Step:
    """Sets flag from the mission's own flag: the literal that means good differs between orbiters."""
    good = F.lit(False)
    for orbiter, literal in ok.items():
        good = good | ((F.col("orbiter") == orbiter) & (F.col(column) == literal))
    return lambda df: df.withColumn("flag", F.when(good, 0).otherwise(MISSION))


def low_temp(cutoff: float) -> Step:
    def step(df: DataFrame) -> DataFrame:
        low = F.lit(False)
        for c in CHANNELS:
            low = low | F.coalesce(F.col(c) < cutoff, F.lit(False))
        return add_bit(df, low, LOW_TEMP)

    return step


def channel_spread(most: float) -> Step:
    return lambda df: add_bit(df, spread(*[F.col(c) for c in CHANNELS]) > most, SPREAD)


def bad_orbits(orbits: Sequence[int]) -> Step:
    return lambda df: add_bit(df, F.col("orbit").isin(*orbits) if orbits else F.lit(False), BAD_ORBIT)


def excluded(bounds: tuple[int, int] | None) -> Step:
    """Orbits in a half-open range."""
    hit = F.lit(False) if bounds is None else (F.col("orbit") >= bounds[0]) & (F.col("orbit") < bounds[1])
    return lambda df: add_bit(df, hit, EXCLUDED)


def orbit_sizes(df: DataFrame) -> DataFrame:
    return unflagged(df).groupBy("orbit").agg(F.count(F.lit(1)).alias("n"))


def small_orbits(least: int) -> Step:
    """Orbits with fewer unflagged rows; an orbit without any is not hit. A window by orbit reads the rows before it once."""
    def step(df: DataFrame) -> DataFrame:
        n = F.count(F.when(F.col("flag") == 0, F.lit(1))).over(Window.partitionBy("orbit"))
        return add_bit(df.withColumn("_n", n), (F.col("_n") > 0) & (F.col("_n") < least), SMALL_ORBIT).drop("_n")

    return step


def repeated_times(df: DataFrame, key: Column) -> DataFrame:
    """(key, n) of the times that occur more than once, among all rows."""
    return df.groupBy(key.alias("_time")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def time_twice(column: str = "utc") -> Step:
    def step(df: DataFrame) -> DataFrame:
        n = F.count(F.col(column)).over(Window.partitionBy(column))
        return add_bit(df.withColumn("_n", n), F.col("_n") > 1, TIME_TWICE).drop("_n")

    return step


def fit_cosine_power(lat_deg: np.ndarray, t: np.ndarray, guess: tuple[float, float] = (231.0, 0.35), rounds: int = 60) -> tuple[float, float]:
    """Least squares of a * cos(|lat|) ** b by damped Gauss-Newton steps; NaN if there are too few rows."""
    if len(t) < 2:
        return float("nan"), float("nan")
    c = np.log(np.maximum(np.cos(np.radians(np.abs(lat_deg))), 1e-12))
    a, b = guess
    damp, best = 1e-3, None
    for _ in range(rounds):
        e = np.exp(b * c)
        r = t - a * e
        cost = float(r @ r)
        if best is None or cost <= best[0]:
            best, damp = (cost, a, b), damp / 4
        else:
            a, b, damp = best[1], best[2], damp * 8
            e = np.exp(b * c)
            r = t - a * e
        j = np.stack([e, a * e * c], axis=1)
        h = j.T @ j
        step = np.linalg.solve(h + damp * np.diag(np.diag(h) + 1e-12), j.T @ r)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-10 * max(1.0, abs(a)):
            break
    r = t - a * np.exp(b * c)
    return (float(a), float(b)) if float(r @ r) <= best[0] else (best[1], best[2])


def _sums(a: Column, b: Column) -> list[Column]:
    """What a Gauss-Newton step at (a, b) needs of an orbit's rows (c = ln cos lat, t): cost, normal matrix and gradient."""
    e, c = F.exp(b * F.col("c")), F.col("c")
    r, d = F.col("t") - a * e, a * e * c
    return [F.sum(x).alias(n) for n, x in (("cost", r * r), ("h11", e * e), ("h12", e * d), ("h22", d * d), ("g1", e * r), ("g2", d * r))]


SUMS = ("cost", "h11", "h12", "h22", "g1", "g2")


def _round(rows: DataFrame, state: DataFrame) -> DataFrame:
    """One damped step of every orbit: the sums at the point it leads to, taken if its cost is no greater. The state is read once, so rounds follow each other in one plan."""
    k11, k22 = (F.col(h) + F.col("damp") * (F.col(h) + 1e-12) for h in ("h11", "h22"))
    det = k11 * k22 - F.col("h12") * F.col("h12")
    da, db = F.try_divide(k22 * F.col("g1") - F.col("h12") * F.col("g2"), det), F.try_divide(k11 * F.col("g2") - F.col("h12") * F.col("g1"), det)
    da, db = (F.when(F.col("done") | F.isnan(x), F.lit(0.0)).otherwise(F.coalesce(x, F.lit(0.0))) for x in (da, db))
    trial = state.select(F.col("orbit").alias("_orbit"), F.struct(*[c for c in state.columns if c != "orbit"]).alias("was"), (F.col("a") + da).alias("a"), (F.col("b") + db).alias("b"), (F.greatest(F.abs(da), F.abs(db)) < 1e-8 * F.greatest(F.lit(1.0), F.abs("a"))).alias("small"))
    held = rows.join(trial, F.col("orbit") == F.col("_orbit"))
    new = held.groupBy("orbit").agg(F.first("was").alias("was"), F.first("a").alias("a"), F.first("b").alias("b"), F.first("small").alias("small"), *_sums(F.col("a"), F.col("b")))
    better = ~F.isnan("cost") & (F.col("cost") <= F.col("was.cost"))
    pick = [F.when(better, F.col(c)).otherwise(F.col(f"was.{c}")).alias(c) for c in ("a", "b", *SUMS)]
    damp = F.when(better, F.col("was.damp") / 4).otherwise(F.col("was.damp") * 8)
    return new.select("orbit", *pick, damp.alias("damp"), (F.col("was.done") | F.col("small") | (damp > 1e12)).alias("done"))


#: Orbits whose state may be broadcast; with more, the join is left to Spark. Rounds of one job, and of all.
BROADCAST_ORBITS, ROUNDS, MOST_ROUNDS = 50_000, 4, 60


def latitude_fits(df: DataFrame, channel: str = "t1", most_lat: float = 85.0, guess: tuple[float, float] = (231.0, 0.35)) -> DataFrame:
    """(orbit, a, b): least squares of a * cos(|lat|) ** b for each orbit with two rows or more.

    Damped Gauss-Newton steps from grouped sums: a round reads the rows' two
    numbers once and leaves six sums an orbit, so an orbit of any size is summed
    by all tasks, and its damping is a column. The rows' two numbers are written
    once, and so is the state (a row an orbit) after every few rounds.
    """
    c = F.log(F.greatest(F.cos(F.radians(F.abs(F.col("lat").cast("double")))), F.lit(1e-12)))
    rows = unflagged(df).where(F.abs("lat") < most_lat).select("orbit", c.alias("c"), F.col(channel).cast("double").alias("t")).where("orbit is not null and t is not null and not isnan(t)")
    rows = written(rows, "fit-rows")
    a, b = (F.lit(float(x)) for x in guess)
    state = rows.groupBy("orbit").agg(F.count(F.lit(1)).alias("n"), *_sums(a, b)).where("n >= 2")
    state = written(state.select("orbit", a.alias("a"), b.alias("b"), *SUMS, F.lit(1e-3).alias("damp"), F.lit(False).alias("done")), "fit")
    light = F.broadcast if state.limit(BROADCAST_ORBITS + 1).count() <= BROADCAST_ORBITS else lambda x: x
    for _ in range(MOST_ROUNDS // ROUNDS):
        for _ in range(ROUNDS):
            state = _round(rows, light(state))
        state = written(state, "fit")
        if state.where("not done").isEmpty():
            break
    return state.select("orbit", "a", "b").where("not isnan(a) and not isnan(b)")


def mad_outliers(df: DataFrame, columns: Sequence[str], limit: float) -> DataFrame:
    """Rows where a column is further from its median than `limit` unscaled median absolute deviations. df is written once."""
    held = written(df, "outliers")
    med = {c: m for c, (m,) in exact_quantiles(held, {c: F.col(c) for c in columns}, [0.5]).items() if m is not None}
    if not med:
        return held.limit(0)
    mad = exact_quantiles(held, {c: F.abs(F.col(c) - m) for c, m in med.items()}, [0.5])
    hit = F.lit(False)
    for c, m in med.items():
        hit = hit | (F.abs(F.col(c) - m) > limit * mad[c][0])
    return held.where(hit)


def aggregating(step: Step) -> Step:
    """Marks a step that reads the plan before it twice."""
    step.aggregates = True
    return step


def lat_model(limit: float, channel: str = "t1") -> Step:
    return aggregating(lambda df: flag_orbits(df, mad_outliers(latitude_fits(df, channel), ["a", "b"], limit), LAT_MODEL))


def latitude_votes(df: DataFrame, channel: str = "t1", least: int = 10) -> DataFrame:
    """(orbit, votes): one-degree tiles, open at both ends, in which the orbit's mean is over two deviations off."""
    rows = unflagged(df).where(F.col("lat") != F.floor("lat")).select("orbit", F.floor("lat").alias("tile"), F.col(channel).cast("double").alias("t"))
    tiles = rows.groupBy("tile").agg(F.avg("t").alias("mean"), F.stddev_samp("t").alias("std"))
    own = rows.groupBy("tile", "orbit").agg(F.avg("t").alias("own"), F.count("t").alias("n")).where(F.col("n") >= least)
    off = own.join(tiles, "tile").where(F.abs(F.col("own") - F.col("mean")) > 2 * F.col("std"))
    return off.groupBy("orbit").agg(F.count(F.lit(1)).alias("votes"))


def lat_cut_orbits(votes: DataFrame, share: float = 0.98) -> DataFrame:
    """Orbits whose votes exceed the percentile of all orbits with a vote. votes is written once."""
    held = written(votes, "votes")
    limit = exact_quantiles(held, {"votes": F.col("votes")}, [share])["votes"][0]
    return held.limit(0) if limit is None else held.where(F.col("votes") > limit)


def lat_cut(rules: FlagRules, channel: str = "t1") -> Step:
    return aggregating(lambda df: flag_orbits(df, lat_cut_orbits(latitude_votes(df, channel, rules.min_tile_count), rules.vote_percentile), LAT_CUT))


def standard_steps(rules: FlagRules, with_fit: bool = True) -> list[Step]:
    """The steps after the mission flag, in order; bit values are not in that order."""
    steps = [low_temp(rules.low_temp), channel_spread(rules.channel_spread), small_orbits(rules.min_orbit_size), time_twice(), bad_orbits(rules.bad_orbits), excluded(rules.excluded)]
    return steps + ([lat_model(rules.mad_limit)] if with_fit else []) + [lat_cut(rules)]


def apply_flags(df: DataFrame, first: Step, steps: Sequence[Step], between: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The steps one after another. A step that aggregates reads the plan before it twice, so that is written first, by `between` or to the shared folder."""
    out = first(df)
    for s in steps:
        out = s((between or (lambda held: written(held, "flags")))(out) if getattr(s, "aggregates", False) else out)
    return out


def summary(df: DataFrame) -> DataFrame:
    """(bit, n, percent) of rows with each bit."""
    bits = F.explode(F.array(*[F.lit(1 << i) for i in range(9)])).alias("bit")
    held = df.groupBy("flag").agg(F.count(F.lit(1)).alias("k")).select("flag", "k", bits)
    hit = F.when(F.col("flag").bitwiseAND(F.col("bit")) > 0, F.col("k")).otherwise(0)
    return held.groupBy("bit").agg(F.sum(hit).alias("n"), (F.sum(hit) * F.lit(100.0) / F.sum("k")).alias("percent"))
