"""Further registered queries: tabulated ephemerides, global order, dictionaries, files written and read, tile functions, nested labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.functions import times
from gridlark.operators import filters, order, states, tile_functions
from gridlark.plans.catalogue import G5, MAP_SQL, cells, lit, q, query, r, r1, r2
from gridlark.schema import CHANNEL_GHZ, LIGHT_SPEED, MOON_RADIUS_KM
from gridlark.sources import fits, labels, sinks, slices, tables
from gridlark.sources.scratch import scratch_path
from gridlark.sources.tables import samples_view

# --- tabulated ephemerides

#: State vectors that events stand in for: a table for each type, irregularly spaced.
STATES_SQL = """st AS (SELECT event_type AS target, epoch_us(ts) / 1000000.0::DOUBLE AS lo, value * 10 AS x, (event_id % 97)::DOUBLE AS y, user_id::DOUBLE AS z,
    (event_id % 13 - 6) / 1000.0::DOUBLE AS vx, (user_id % 7 - 3) / 1000.0::DOUBLE AS vy, (event_id % 5 - 2) / 1000.0::DOUBLE AS vz FROM events),
  pieces AS (SELECT * FROM (SELECT *, lead(lo) OVER w AS hi, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(z) OVER w AS z1, lead(vx) OVER w AS vx1, lead(vy) OVER w AS vy1, lead(vz) OVER w AS vz1
    FROM st WINDOW w AS (PARTITION BY target ORDER BY lo)) WHERE hi IS NOT NULL AND hi - lo <= {gap})"""
#: Samples with a time within the month of the events, in milliseconds, and a target that the table may lack.
TIMED_SQL = """timed AS (SELECT key, line, t1, t2, lat, lon, d, 1704067200.0::DOUBLE + (key * 7919 + line * 104729 + orbit * 15485863) % 2592000000 / 1000.0::DOUBLE AS et,
    CASE key % 6 WHEN 0 THEN 'view' WHEN 1 THEN 'click' WHEN 2 THEN 'error' WHEN 3 THEN 'purchase' WHEN 4 THEN 'signup' ELSE 'none' END AS target FROM samples)"""


def _states(spark, sf_dir) -> DataFrame:
    """event_id tells events at one time apart; the SQL leaves their order open."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    n, u = F.col("event_id"), F.col("user_id")
    milli = lambda c: c.cast("double") / 1000.0
    return e.select(
        F.col("event_type").alias("target"), times.unix_seconds(F.col("ts")).alias("et"), (F.col("value") * 10).alias("x"), (n % 97).cast("double").alias("y"), u.cast("double").alias("z"),
        milli(n % 13 - 6).alias("vx"), milli(u % 7 - 3).alias("vy"), milli(n % 5 - 2).alias("vz"), "event_id",
    )


def _timed(spark, sf_dir) -> DataFrame:
    s = samples_view(spark, sf_dir)
    et = F.lit(1704067200.0) + (F.col("key") * 7919 + F.col("line") * 104729 + F.col("orbit") * 15485863) % 2592000000 / F.lit(1000.0)
    names = F.array(*[F.lit(x) for x in ("view", "click", "error", "purchase", "signup", "none")])
    return s.select("key", "line", "t1", "t2", "lat", "lon", "d", et.alias("et"), F.get(names, (F.col("key") % 6).cast("int")).alias("target"))


@query("SELECT target, lo, hi, x AS x0, x1, z AS z0, z1 FROM pieces", STATES_SQL.format(gap="1e18"), samples=False)
def ephemeris_pieces(spark, sf_dir):
    p = states.state_pieces(_states(spark, sf_dir), ["target"], ties=["event_id"])
    return p.select("target", "lo", "hi", F.col("p.x").alias("x0"), F.col("q.x").alias("x1"), F.col("p.z").alias("z0"), F.col("q.z").alias("z1"))


def _hermite_sql(a: str) -> str:
    return f"((2 * s * s * s - 3 * s * s + 1) * {a} + (s * s * s - 2 * s * s + s) * h * v{a} + (3 * s * s - 2 * s * s * s) * {a}1 + (s * s * s - s * s) * h * v{a}1)"


def _slope_sql(a: str) -> str:
    return f"((6 * s * s - 6 * s) * ({a} - {a}1) / h + (3 * s * s - 4 * s + 1) * v{a} + (3 * s * s - 2 * s) * v{a}1)"


ASOF_SQL = f"{STATES_SQL.format(gap='3600')},\n  {TIMED_SQL},\n" + """  found AS (SELECT *, (et - lo) / h AS s FROM (SELECT t.*, lo, hi - lo AS h, x, y, z, vx, vy, vz, x1, y1, z1, vx1, vy1, vz1
    FROM timed t ASOF LEFT JOIN pieces p ON t.target = p.target AND t.et >= p.lo WHERE p.hi IS NULL OR t.et < p.hi
    UNION ALL SELECT t.*, """ + ", ".join(["NULL"] * 14) + " FROM timed t ASOF JOIN pieces p ON t.target = p.target AND t.et >= p.lo WHERE t.et >= p.hi))"


@query(f"SELECT key, line, target, {q('et', 3)} AS et, lo, {q(_hermite_sql('x'))} AS mx, {q(_hermite_sql('y'))} AS my, {q(_hermite_sql('z'))} AS mz, {q(_slope_sql('x'), 5)} AS mvx FROM found", ASOF_SQL)
def asof_states(spark, sf_dir):
    """Every sample meets the one piece of its target's table that covers its time, or none."""
    out = states.covered(_timed(spark, sf_dir), states.state_pieces(_states(spark, sf_dir), ["target"], most_gap=3600.0, ties=["event_id"]), ["target"])
    h = F.col("hi") - F.col("lo")
    s = (F.col("et") - F.col("lo")) / h
    at = {a: states.hermite(s, h, F.col(f"p.{a}"), F.col(f"p.v{a}"), F.col(f"q.{a}"), F.col(f"q.v{a}")) for a in states.AXES}
    lo = F.when(F.col("p").isNotNull(), F.col("lo")).alias("lo")
    return out.select("key", "line", "target", r2(F.col("et"), 3).alias("et"), lo, *[r2(at[a][0]).alias(f"m{a}") for a in states.AXES], r2(at["x"][1], 5).alias("mvx"))


@query(f"SELECT key, line, {q('c0 + c1 * x + c2 * (2 * x * x - 1) + c3 * (4 * x * x * x - 3 * x)')} AS mx, {q('c3 + c2 * x')} AS my, {q('c1')} AS mz FROM (SELECT t.key, t.line, rec.*, (2 * t.et - rec.hour - (rec.hour + 3600)) / 3600 AS x FROM timed t LEFT JOIN rec ON floor(t.et / 3600) * 3600 = rec.hour)",
       TIMED_SQL + ", rec AS (SELECT floor(epoch_us(ts) / 3600000000.0::DOUBLE) * 3600 AS hour, round(avg(value), 6) AS c0, max(value) / 10 AS c1, min(value) / 10 AS c2, count(*) / 100.0::DOUBLE AS c3 FROM events WHERE event_type <> 'error' OR user_id % 3 > 0 GROUP BY 1)")
def chebyshev_positions(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type <> 'error' or user_id % 3 > 0")
    hour = F.floor(times.unix_seconds(F.col("ts")) / 3600) * F.lit(3600.0)
    c = e.groupBy(hour.alias("lo")).agg(F.round(F.avg("value"), 6).alias("c0"), (F.max("value") / 10).alias("c1"), (F.min("value") / 10).alias("c2"), (F.count(F.lit(1)) / F.lit(100.0)).alias("c3"))
    records = c.select("lo", (F.col("lo") + 3600).alias("hi"), F.array("c0", "c1", "c2", "c3").alias("x"), F.array("c3", "c2").alias("y"), F.array("c1").alias("z"))
    out = states.chebyshev_states(_timed(spark, sf_dir), records)
    return out.select("key", "line", *[r(f"m{a}").alias(f"m{a}") for a in states.AXES])


#: A frame that turns once in 27.3 days about a pole.
_TURN, _ALPHA, _DELTA = 2.66e-6, 4.71, 1.16


def _sun_sql() -> str:
    """The Sun's vectors in steps: Hermite, the frame's matrix, light time in two rounds."""
    a, b = lit(_ALPHA + 1.5707963267948966), lit(1.5707963267948966 - _DELTA)
    m = [
        [f"cos({a}) * cos(w) - sin({a}) * cos({b}) * sin(w)", f"-cos({a}) * sin(w) - sin({a}) * cos({b}) * cos(w)", f"sin({a}) * sin({b})"],
        [f"sin({a}) * cos(w) + cos({a}) * cos({b}) * sin(w)", f"-sin({a}) * sin(w) + cos({a}) * cos({b}) * cos(w)", f"-cos({a}) * sin({b})"],
        [f"sin({b}) * sin(w)", f"sin({b}) * cos(w)", f"cos({b})"],
    ]
    c, axes = lit(LIGHT_SPEED / 1000.0), "xyz"
    own = ", ".join(f"({' + '.join(f'({m[i][j]}) * u{axes[j]}' for j in range(3))}) AS o{axes[i]}" for i in range(3))
    seen = ", ".join(f"g{k} - o{k} * {n} AS {p}{k}0" for p, n in (("m", "0"), ("b", "1737.4"), ("c", "(1737.4 + d)")) for k in axes)
    late = lambda n: ", ".join(f"{p}{k}0 - v{k} * sqrt({' + '.join(f'{p}{z}{n} * {p}{z}{n}' for z in axes)}) / {c} AS {p}{k}{n + 1}" for p in "mbc" for k in axes)
    back = [" + ".join(f"({m[j][i]}) * m{axes[j]}2" for j in range(3)) for i in range(2)]
    return f"""sun AS (SELECT epoch_us(ts) / 1000000.0::DOUBLE AS lo, 149600.0::DOUBLE + value * 10 AS x, (event_id % 97) * 1000.0::DOUBLE AS y, user_id * 100.0::DOUBLE AS z, (event_id % 13 - 6) / 10.0::DOUBLE AS vx, (user_id % 7 - 3) / 10.0::DOUBLE AS vy, (event_id % 5 - 2) / 10.0::DOUBLE AS vz FROM events),
  pieces AS (SELECT *, lead(lo) OVER w AS hi, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(z) OVER w AS z1, lead(vx) OVER w AS vx1, lead(vy) OVER w AS vy1, lead(vz) OVER w AS vz1 FROM sun WINDOW w AS (ORDER BY lo)),
  {TIMED_SQL},
  f0 AS (SELECT *, (et - lo) / h AS s FROM (SELECT t.*, p.* EXCLUDE (hi), hi - lo AS h FROM timed t ASOF LEFT JOIN (SELECT * FROM pieces) p ON t.et >= p.lo)),
  f1 AS (SELECT key, line, lat, lon, d, {_hermite_sql('x')} AS gx, {_hermite_sql('y')} AS gy, {_hermite_sql('z')} AS gz, {_slope_sql('x')} AS vx, {_slope_sql('y')} AS vy, {_slope_sql('z')} AS vz,
    {lit(_TURN)} * (et - 1704067200.0::DOUBLE) AS w, cos(radians(lat)) * cos(radians(lon)) AS ux, cos(radians(lat)) * sin(radians(lon)) AS uy, sin(radians(lat)) AS uz FROM f0),
  f2 AS (SELECT *, {own} FROM f1), f3 AS (SELECT *, {seen} FROM f2), f4 AS (SELECT *, {late(0)} FROM f3), f5 AS (SELECT *, {late(1)} FROM f4),
  f6 AS (SELECT *, degrees(atan2({back[1]}, {back[0]})) AS noon FROM f5)"""


@query(f"SELECT key, line, {', '.join(f'{q(f'{p}{k}2', 2)} AS {p}{k}' for p in 'mbc' for k in 'xyz')}, {q('1737.4 * ux')} AS nx, {q('(lon - noon) / 360 + 0.5 - floor((lon - noon) / 360 + 0.5)')} AS ltst FROM f6", _sun_sql())
def solar_vectors(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    n, u, ten = F.col("event_id"), F.col("user_id"), F.lit(10.0)
    sun = e.select(times.unix_seconds(F.col("ts")).alias("et"), (F.lit(149600.0) + F.col("value") * 10).alias("x"), (n % 97 * F.lit(1000.0)).alias("y"), (u * F.lit(100.0)).alias("z"), ((n % 13 - 6) / ten).alias("vx"), ((u % 7 - 3) / ten).alias("vy"), ((n % 5 - 2) / ten).alias("vz"), "event_id")
    frame = states.rotation(_TURN * (F.col("et") - 1704067200.0), F.lit(_ALPHA), F.lit(_DELTA))
    out = states.sun_vectors(_timed(spark, sf_dir), sun, frame, MOON_RADIUS_KM, ties=["event_id"])
    return out.select("key", "line", *[r1(F.col(f"{p}{k}"), 2).alias(f"{p}{k}") for p in "mbc" for k in "xyz"], r1(F.col("nx")).alias("nx"), r1(F.col("ltst")).alias("ltst"))


# --- files

@query("SELECT 'TEMP' AS name, lat_ix, lon_ix, value FROM c WHERE lat_ix >= 6 AND lat_ix < 30 AND lon_ix >= 10 AND lon_ix < 50", MAP_SQL)
def image_crop(spark, sf_dir):
    """A map as images of 7 lines, written by several tasks, of which a crop is read."""
    path = scratch_path(spark, "images")
    fits.write_images(cells(spark, sf_dir).withColumn("name", F.lit("TEMP")), path, samples=72, lines=7)
    held = fits.read_images(spark, path, prefix="TEMP", lines=(6, 30), samples=(10, 50), split=4096)
    return held.where("value is not null").select("name", "lat_ix", "lon_ix", "value")


@query("SELECT orbiter, orbit, key, line, lat, lon, d, t1, t2, CASE WHEN orbit % 7 > 0 THEN mflag END AS mflag, CASE WHEN line % 3 > 0 THEN CAST(line AS INTEGER) END AS step, t1 > 200 AS warm FROM samples")
def binary_table(spark, sf_dir):
    """All samples as binary tables and back; texts, whole numbers and null among them."""
    s = samples_view(spark, sf_dir)
    out = s.select("orbiter", "orbit", "key", "line", "lat", "lon", "d", "t1", "t2", F.when(F.col("orbit") % 7 > 0, F.col("mflag")).alias("mflag"), F.when(F.col("line") % 3 > 0, F.col("line").cast("int")).alias("step"), (F.col("t1") > 200).alias("warm"))
    path = scratch_path(spark, "tables")
    fits.write_binary_table(out, path, rows=5000)
    return fits.read_binary_table(spark, path, split=1 << 18)


@query("SELECT CAST(lat_ix // 7 * 7 AS VARCHAR) AS line0, CAST(max(lat_ix) - lat_ix // 7 * 7 + 1 AS VARCHAR) AS lines, '72' AS samples FROM c GROUP BY lat_ix // 7", MAP_SQL)
def image_headers(spark, sf_dir):
    """The header cards of written images, a row a file."""
    from gridlark.sources import rasters

    path = scratch_path(spark, "images")
    fits.write_images(cells(spark, sf_dir).withColumn("name", F.lit("TEMP")), path, samples=72, lines=7)
    h = rasters.fits_headers(spark, path).where("key in ('LINE0', 'NAXIS1', 'NAXIS2')")
    one = lambda k: F.max(F.when(F.col("key") == k, F.col("value")))
    return h.groupBy("file").agg(one("LINE0").alias("line0"), one("NAXIS2").alias("lines"), one("NAXIS1").alias("samples")).drop("file")


_BOX = {"lat": [(-20.0, 10.0)], "lon": [(30.0, 75.0)], "ltst": [(0.9, 1.0), (0.0, 0.1)]}


@query("SELECT key, line, lat, lon, ltst, t2 FROM samples WHERE lat >= -20 AND lat < 10 AND lon >= 30 AND lon < 75 AND (ltst >= 0.9 OR ltst < 0.1)")
def pruned_slice(spark, sf_dir):
    """A box and a local time across midnight from a table of 64 files in Z order: few are read (tests count them)."""
    path = scratch_path(spark, "sliced")
    slices.write_sliced(samples_view(spark, sf_dir).select("key", "line", "lat", "lon", "ltst", "t2"), path, files=64)
    return slices.read_slice(spark, path, _BOX)


@query("SELECT key, line, lat, t2 FROM samples WHERE lat >= -10 AND lat < -5")
def clustered_scan(spark, sf_dir):
    """A latitude band of a table sorted by latitude, with small row groups."""
    path = scratch_path(spark, "clustered")
    sinks.write_clustered(samples_view(spark, sf_dir).select("key", "line", "lat", "t2"), path, row_group_bytes=1 << 16)
    return tables.read_samples(spark, path).where("lat >= -10 and lat < -5")


@query(f"SELECT bin_start, lat_ix, lon_ix, {q('w / n', 9)} AS value FROM (SELECT CAST(floor(ltst * 24 / 6) * 6 AS INTEGER) AS bin_start, CAST(35 - floor((lat + 90) / 5) AS INTEGER) AS lat_ix, CAST(floor((lon + 180) / 5) AS INTEGER) AS lon_ix, sum(t2) AS w, count(*) AS n FROM samples WHERE orbiter = 'b' GROUP BY ALL)")
def stored_maps(spark, sf_dir):
    """Maps of both orbiters and all bins, written by product and north up, of which one orbiter's are read."""
    s = samples_view(spark, sf_dir).withColumn("bin_start", times.local_bin(F.col("ltst"), 6))
    m = G5.place(s).groupBy("orbiter", "bin_start", "lat_ix", "lon_ix").agg(F.avg("t2").alias("value"))
    m = m.select("orbiter", F.lit(2).alias("channel"), F.lit("TEMP").alias("maptype"), "bin_start", "lat_ix", "lon_ix", "value")
    path = scratch_path(spark, "maps")
    sinks.write_maps(m, path, rows=36, provenance={"sigma": "none"})
    held = tables.read_maps(spark, path, orbiter="b", channel=2, maptype="TEMP")
    return held.select("bin_start", "lat_ix", "lon_ix", r("value", 9).alias("value"))


@query("SELECT orbiter, orbit, strftime(utc, '%Y-%m-%dT%H:%M:%S.000') AS utc, t1, t2, lat, lon, d FROM samples")
def stored_samples(spark, sf_dir):
    """The exported sample table, a folder an orbiter."""
    path = scratch_path(spark, "samples")
    sinks.write_samples(samples_view(spark, sf_dir), path)
    return tables.read_samples(spark, path).select("orbiter", "orbit", "utc", "t1", "t2", "lat", "lon", "d")


@query("SELECT orbit, count(*) AS n, max(t1) AS t1 FROM samples GROUP BY orbit")
def cached_table(spark, sf_dir):
    """A table that is made once: the second call reads what the first has written."""
    path = scratch_path(spark, "cached")
    make = lambda: samples_view(spark, sf_dir).groupBy("orbit").agg(F.count(F.lit(1)).alias("n"), F.max("t1").alias("t1"))
    sinks.cached(spark, path, make)
    return sinks.cached(spark, path, lambda: make().limit(0))


@query("SELECT lat, albedo, h, ltst, tb FROM (SELECT DISTINCT CAST(lat AS FLOAT) AS lat, CAST(0.12 AS FLOAT) AS albedo, CAST(0.07 AS FLOAT) AS h, CAST(ltst * 24 AS FLOAT) AS ltst, CAST(t2 AS FLOAT) AS tb, line, key % 2 AS ch FROM samples) WHERE ch = 1 AND line = 1")
def brightness_scan(spark, sf_dir):
    """The model table's rows of one channel and loss constant; keys are 32-bit."""
    s = samples_view(spark, sf_dir)
    f32 = lambda c: (F.lit(c) if isinstance(c, float) else c).cast("float")
    freq = F.when(F.col("key") % 2 == 1, f32(CHANNEL_GHZ[2])).otherwise(f32(CHANNEL_GHZ[4]))
    t = s.select(freq.alias("freq"), F.when(F.col("line") == 1, f32(2.7)).otherwise(f32(2.5)).alias("c"), f32(F.col("lat")).alias("lat"), f32(0.12).alias("albedo"), f32(0.07).alias("h"), f32(F.col("ltst") * 24).alias("ltst"), f32(F.col("t2")).alias("tb"))
    path = scratch_path(spark, "model")
    sinks.write_table(t.distinct(), path, metadata={"source": "samples"})
    return tables.read_brightness(spark, path, 2, 2.7)


# --- order and dictionaries

@query("SELECT CAST(row_number() OVER (ORDER BY lat, key, line, t1, t2, t3) - 1 AS BIGINT) AS n, lat, key, line, t1, t2, t3 FROM samples")
def global_ordinals(spark, sf_dir):
    s = samples_view(spark, sf_dir).select("lat", "key", "line", "t1", "t2", "t3")
    return order.ordinals(s, ["lat", "key", "line", "t1", "t2", "t3"], "n")


@query("SELECT CAST(row_number() OVER (ORDER BY orbit, utc, key, line, t2) AS BIGINT) AS place, orbit, utc, key, line, t2 FROM samples")
def sorted_samples(spark, sf_dir):
    """Samples in order of orbit and time, with their places."""
    s = samples_view(spark, sf_dir).select("orbit", "utc", "key", "line", "t2")
    return order.ordinals(s, ["orbit", "utc", "key", "line", "t2"], "place", 1)


@query("SELECT event_id, user_id, CAST(dense_rank() OVER (ORDER BY props) - 1 AS BIGINT) AS code FROM events", samples=False)
def encoded_events(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "props")
    return order.encode(e, "props", order.dictionary(e, "props")).select("event_id", "user_id", F.col("props").alias("code"))


@query("SELECT source, old, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS BIGINT) AS code FROM (SELECT 0 AS source, * FROM (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS old FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND event_id % 3 = 0)) UNION ALL SELECT 1, * FROM (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) FROM (SELECT DISTINCT user_id FROM events WHERE value > 60)))", samples=False)
def unified_codes(spark, sf_dir):
    """What the codes of two dictionaries become in one of both."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    one, two = order.dictionary(e.where("event_type = 'view' and event_id % 3 = 0"), "user_id"), order.dictionary(e.where("value > 60"), "user_id")
    return order.unify(one, two)[1]


# --- tile functions, checks, labels

@query(f"SELECT CAST(floor((lat + 75) / 4) AS INTEGER) AS tile_lat, CAST(floor((lon + 180) / 4) AS INTEGER) AS tile_lon, count(t1) AS n, {q('avg(t1)')} AS mean, {q('stddev_pop(t1)', 5)} AS std, min(t1) AS lo, max(t1) AS hi FROM samples WHERE lat >= -75 AND lat < 75 AND lon >= -180 AND lon < 180 GROUP BY ALL")
def tile_function(spark, sf_dir):
    """A table function called from SQL, once for each tile."""
    from gridlark.operators.grids import Tiling

    tile_functions.register(spark)
    Tiling((-75.0, 75.0), (-180.0, 180.0), 4.0).assign(samples_view(spark, sf_dir)).select("tile_lat", "tile_lon", "t1").createOrReplaceTempView("gridlark_tiles")
    out = spark.sql("SELECT * FROM tile_statistics(TABLE(gridlark_tiles), 'tile_lat, tile_lon', 't1')")
    return out.select("tile_lat", "tile_lon", "n", r("mean").alias("mean"), r("std", 5).alias("std"), "lo", "hi")


@query("SELECT orbit, count(*) AS n FROM samples WHERE orbit % 2 = 0 GROUP BY orbit")
def constant_column(spark, sf_dir):
    """Counts of a table of which one column is required to have one value."""
    s = samples_view(spark, sf_dir).where("orbit % 2 = 0").withColumn("even", F.col("orbit") % 2)
    filters.require_constant(s, ["even"])
    return s.groupBy("orbit").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'orbit-' || orbit AS product, CAST(count(*) AS VARCHAR) AS records, CAST(CAST(min(orbiter) AS VARCHAR) AS VARCHAR) AS instrument, CAST(min(t1) AS INTEGER)::VARCHAR AS first_band FROM samples GROUP BY orbit")
def label_records(spark, sf_dir):
    """Nested XML labels, a file for each few orbits' elements, read back as fields by fuzzy names."""
    s = samples_view(spark, sf_dir).groupBy("orbit").agg(F.count(F.lit(1)).alias("n"), F.min("orbiter").alias("orbiter"), F.min("t1").cast("int").alias("t1"))
    text = F.format_string(
        "<Product><Identification><logical_id>orbit-%s</logical_id></Identification><File size='%s'><Table><Record_Count>%s</Record_Count><bands><band n='1'>%s</band><band n='2'>x</band></bands></Table></File><Instrument>%s</Instrument></Product>",
        *[F.col(c).cast("string") for c in ("orbit", "n", "n", "t1", "orbiter")],
    )
    path = scratch_path(spark, "labels")
    fits.write_text_files(s.select(F.format_string("orbit_%s.xml", F.col("orbit").cast("string")).alias("name"), text.alias("label")), path)
    found = labels.as_records(labels.read_xml_labels(spark, path, "Product"), {"product": "Logical_ID", "records": "record_count", "instrument": "instrument", "first_band": "band"})
    return found.drop("file")


def _label_maps(spark, sf_dir) -> DataFrame:
    s = samples_view(spark, sf_dir).withColumn("bin_start", times.local_bin(F.col("ltst"), 6))
    cells_ = G5.place(s).groupBy("orbiter", "bin_start", "lat_ix", "lon_ix").agg(F.avg("t1").alias("TEMP"), F.stddev_pop("t1").alias("STDEV"))
    long = cells_.select("orbiter", F.lit(2).alias("channel"), "bin_start", (F.col("bin_start") + 6).alias("bin_stop"), "lat_ix", "lon_ix", F.explode(F.create_map(F.lit("TEMP"), F.col("TEMP"), F.lit("STDEV"), F.col("STDEV"))).alias("maptype", "value"))
    return G5.with_coordinates(long).withColumn("value", F.when(F.col("lat_ix") % 9 > 0, F.col("value")))


@query(f"""SELECT lower(orbiter || '_t2_' || maptype) AS stem, '7.8' AS ghz, CAST(max(lat_ix) - min(lat_ix) + 1 AS VARCHAR) AS lines, CAST(count(DISTINCT bin_start) AS VARCHAR) AS bins,
    CASE WHEN maptype = 'STDEV' THEN 'biased' END AS deviation, max(maptype || '_0_6') AS first_bin, CAST(CAST(sum(CASE WHEN bin_start = 0 AND lat_ix % 9 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS VARCHAR) AS missing, CAST(min(lat_ix) * 5.0::DOUBLE - 90 AS VARCHAR) AS south
  FROM (SELECT orbiter, maptype, bin_start, lat_ix FROM (SELECT DISTINCT orbiter, CAST(floor(ltst * 24 / 6) * 6 AS INTEGER) AS bin_start, CAST(floor((lat + 90) / 5) AS INTEGER) AS lat_ix, floor((lon + 180) / 5) AS lon_ix FROM samples), (VALUES ('TEMP'), ('STDEV')) m(maptype)) GROUP BY orbiter, maptype""")
def map_labels(spark, sf_dir):
    """Maps of all bins to label files, one a product, and the files' elements."""
    from gridlark.plans import map_labels as plan

    path = scratch_path(spark, "map-labels")
    fits.write_text_files(plan.map_labels(_label_maps(spark, sf_dir), 0.2, plan.map_rules()), path)
    found = labels.as_records(labels.read_xml_labels(spark, path, "Product"), {"stem": "logical_id", "ghz": "_frequency", "lines": "lines", "bins": "_count", "deviation": "Deviation", "first_bin": "_name", "missing": "missing", "south": "south"})
    return found.drop("file")


# --- texts, headers and ends

@query("SELECT CAST(orbit AS INTEGER) AS orbit, utc, CAST(lat AS FLOAT) AS lat, CAST(CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END AS FLOAT) AS lon, CAST(d AS FLOAT) AS d, CAST(t1 AS FLOAT) AS t1, CAST(t2 AS FLOAT) AS t2, mflag FROM samples")
def orbit_texts(spark, sf_dir):
    """Attached-label text tables, a file an orbit, written in parallel and read back as typed samples."""
    path = scratch_path(spark, "texts")
    fits.write_text_files(tables.orbit_texts(samples_view(spark, sf_dir), order=("utc", "key", "line")), path)
    raw = tables.read_orbit_texts(spark, path, "a")
    return tables.typed_samples(raw, ordered=False).select("orbit", "utc", "lat", "lon", "d", "t1", "t2", "mflag")


@query("SELECT key, line, lat, lon FROM samples ORDER BY md5('7|' || key || '|' || line || '|' || CAST(orbit AS VARCHAR)), key, line, orbit LIMIT 5")
def spot_check(spark, sf_dir):
    s = samples_view(spark, sf_dir)
    return tables.spot_check(s, 5, 7, ["key", "line", "orbit"]).select("key", "line", "lat", "lon")


@query("SELECT a.key, a.line, a.t1, b.orbit, b.lat FROM (SELECT *, row_number() OVER (ORDER BY key, line, t1, t2, orbit) AS n FROM samples) a JOIN (SELECT *, row_number() OVER (ORDER BY orbit, lat, lon, t2, key) AS n FROM samples) b USING (n)")
def positional_concat(spark, sf_dir):
    """Two tables of one length side by side, each in its own order."""
    s = samples_view(spark, sf_dir)
    left = s.select("key", "line", "t1", "t2", F.col("orbit").alias("_orbit"))
    right = s.select("orbit", "lat", "lon", F.col("t2").alias("_t2"), F.col("key").alias("_key"))
    out = order.beside(left, right, ["key", "line", "t1", "t2", "_orbit"], ["orbit", "lat", "lon", "_t2", "_key"])
    return out.select("key", "line", "t1", "orbit", "lat")


@query("""SELECT orbit, k AS key, v AS value FROM (SELECT orbit, unnest(['ORBIT', 'ROWS', 'PTYPE']) AS k, unnest([CAST(orbit AS VARCHAR), CAST(count(*) AS VARCHAR), 'TEMP']) AS v FROM samples GROUP BY orbit
  UNION ALL SELECT orbit, 'LEAST', CASE WHEN orbit % 3 > 0 THEN CAST(min(line) AS VARCHAR) END FROM samples GROUP BY orbit) WHERE v IS NOT NULL""")
def merged_headers(spark, sf_dir):
    """Two headers an orbit, merged; one key is replaced, one removed, null values go."""
    from gridlark.plans.templates import merged_header

    o = samples_view(spark, sf_dir).groupBy("orbit").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("least"))
    pairs = lambda *xs: F.create_map(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in xs])
    one = pairs("ORBIT", F.col("orbit"), "PTYPE", F.lit("BASE"), "COMMENT", F.lit("x"))
    two = pairs("ROWS", F.col("n"), "PTYPE", F.lit("TEMP"), "LEAST", F.when(F.col("orbit") % 3 > 0, F.col("least")))
    return o.select("orbit", F.explode(merged_header(one, two, without=["COMMENT"])).alias("key", "value"))


@query("""SELECT * FROM (SELECT 'near' AS "end", * FROM t ORDER BY greatest(tile_lat, -tile_lat - 1), tile_lat, tile_lon LIMIT 1) UNION ALL SELECT * FROM (SELECT 'far', * FROM t ORDER BY greatest(tile_lat, -tile_lat - 1) DESC, tile_lat, tile_lon LIMIT 1)""",
       "t AS (SELECT CAST(floor(lat / 4) AS INTEGER) AS tile_lat, CAST(floor(lon / 4) AS INTEGER) AS tile_lon, count(*) AS n FROM samples GROUP BY ALL)")
def end_tiles(spark, sf_dir):
    from gridlark.operators import grids

    return grids.end_tiles(samples_view(spark, sf_dir), 4.0)


@query("SELECT orbit, n, line FROM (SELECT DISTINCT orbit FROM samples), (VALUES (0, 'orbit'), (5, '  only maps'), (7, 'end')) v(n, line)")
def label_lines(spark, sf_dir):
    """Lines of a label an orbit, without those of a block and without marks and comments."""
    from gridlark.plans.templates import delete_lines_frame

    lines = ["orbit", "{delete:table}", "  only tables", "  {stop:table}", "{delete:map}", "  only maps", "{stop:map}", "end", "<!-- note -->"]
    o = samples_view(spark, sf_dir).select("orbit").distinct()
    held = o.select("orbit", F.posexplode(F.array(*[F.lit(x) for x in lines])).alias("n", "line"))
    return delete_lines_frame(held, ["table"], ["orbit"]).select("orbit", "n", "line")
