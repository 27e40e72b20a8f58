"""The registered queries: each operator applied to the fixture tables, with its DuckDB twin.

A twin is written in plain SQL over the same tables. Floating results are
rounded on both sides, since the order of parallel sums is free.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.functions import names, physics, times, units
from gridlark.operators import brightness, ephemeris, filters, flags, footprint, grids, interpolate, residual, thermal
from gridlark.plans import maps, templates
from gridlark.schema import AU, BODIES, BODY_COLUMNS, BOLTZMANN, LIGHT_SPEED, MOON_RADIUS_KM, PLANCK, STEFAN_BOLTZMANN, ANTENNAS, Body, MapSpec, conform
from gridlark.sources import tables
from gridlark.sources.tables import samples_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Operators that read no table, as queries for tests alone: they are not registered.
FORMS: dict[str, Query] = {}
FORMS_SQL: dict[str, str] = {}

SAMPLES_SQL = """samples AS (
  SELECT CASE l_linestatus WHEN 'F' THEN 'a' ELSE 'b' END AS orbiter, l_suppkey AS orbit, l_shipdate AS utc,
         (l_partkey * 37 % 18000) / 100.0::DOUBLE - 90 AS lat, (l_orderkey * 53 % 36000) / 100.0::DOUBLE - 180 AS lon,
         l_quantity + 80 AS d, ((l_orderkey * 7 + l_linenumber) % 240) / 240.0::DOUBLE AS ltst,
         l_quantity + 180 AS t1, l_extendedprice / 1000 + 180 AS t2, l_discount * 500 + 200 AS t3, l_tax * 500 + 190 AS t4,
         l_returnflag AS mflag, l_orderkey AS key, l_linenumber AS line
  FROM lineitem)"""


def query(sql: str | None = None, ctes: str = "", samples: bool = True, reads: bool = True) -> Callable[[Query], Query]:
    """Registers a query under its name; sql follows the common table expressions. reads: whether it reads tables."""
    def register(fn: Query) -> Query:
        (QUERIES if reads else FORMS)[fn.__name__] = fn
        if sql is not None:
            parts = [p for p in ((SAMPLES_SQL if samples else ""), ctes) if p]
            (SQL if reads else FORMS_SQL)[fn.__name__] = ("WITH RECURSIVE " if "RECURSIVE" in ctes else "WITH ") + ",\n".join(parts).replace("RECURSIVE ", "") + "\n" + sql if parts else sql
        return fn

    return register


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded; adding zero turns -0.0 into 0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def r2(x: Column, digits: int = 6) -> Column:
    """As r, of doubles, halves away from zero in binary as the twins round: r makes a decimal text of every value, which takes longer than a footprint point."""
    scale = 10.0**digits
    a = F.abs(x) * scale
    whole = F.rint(a)
    near = F.signum(x) * (whole + F.when(a - whole == 0.5, F.lit(1.0)).otherwise(F.lit(0.0))) / scale
    # from here on doubles have no fraction
    return F.when(a < 2.0**52, near).otherwise(F.round(x, digits)) + F.lit(0.0)


def r1(x: Column, digits: int = 6) -> Column:
    """As r2 with a third of the code, though slower alone: a row of many r2 makes a method that the JVM does not compile."""
    scale = 10.0**digits
    return F.round(x * scale, 0) / scale + F.lit(0.0)


def q(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0::DOUBLE)"


def lit(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


# --- filters and memberships

@query("SELECT key, line, lat, lon, d FROM samples WHERE lon <= 90 AND lat <= 45 AND d <= 120")
def scan_validity_filter(spark, sf_dir):
    return filters.valid_box(samples_view(spark, sf_dir), 90.0, 45.0, 120.0).select("key", "line", "lat", "lon", "d")


@query("SELECT key, line, lat FROM samples WHERE lat >= -10 AND lat < 10")
def half_open_range(spark, sf_dir):
    return samples_view(spark, sf_dir).where(filters.between_half_open(F.col("lat"), (-10.0, 10.0))).select("key", "line", "lat")


@query(f"""SELECT d, lat, lon, ltst, t2 AS t, orbit FROM samples WHERE orbiter = 'a' AND lat >= -75 AND lat < 75 AND lon >= -180 AND lon < 180
  AND ((ltst >= {lit(1 - 1 / 24)} AND ltst < 1) OR (ltst >= 0 AND ltst < {lit(1 / 24)})) AND orbit NOT IN (3, 5)""")
def ltst_wrap_slice(spark, sf_dir):
    return filters.load_slice(samples_view(spark, sf_dir), MapSpec("a", 2, (-1 / 24, 1 / 24), exclude_orbits=(3, 5), unflagged=False))


@query("SELECT key, line, ltst * 24 AS hour, CASE WHEN ltst * 24 <= 1.5 THEN ltst * 24 + 24 ELSE ltst * 24 END AS moved FROM samples WHERE ltst * 24 >= 22 OR ltst * 24 <= 1.5")
def wrapped_hours(spark, sf_dir):
    s = samples_view(spark, sf_dir).withColumn("hour", F.col("ltst") * 24)
    lo, hi, last = 22.0, 25.4, 23.9
    return s.where(filters.hours_closed(F.col("hour"), lo, hi, last)).select("key", "line", "hour", filters.unwrap_hours(F.col("hour"), lo, hi, last).alias("moved"))


@query("SELECT key, line, lat FROM samples WHERE abs(lat) <= 30")
def abs_latitude_crop(spark, sf_dir):
    return filters.abs_lat_crop(samples_view(spark, sf_dir), 30.0).select("key", "line", "lat")


@query("SELECT orbiter, orbit, count(*) AS n FROM samples WHERE orbit NOT IN (SELECT orbit FROM samples GROUP BY orbit HAVING avg(d) > 105.5) GROUP BY orbiter, orbit")
def anti_exclude_orbits(spark, sf_dir):
    s = samples_view(spark, sf_dir)
    far = s.groupBy("orbit").agg(F.avg("d").alias("m")).where("m > 105.5").select("orbit")
    return filters.not_member(s, far, "orbit").groupBy("orbiter", "orbit").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT orbiter, orbit, count(*) AS n FROM samples WHERE orbit IN (SELECT orbit FROM samples GROUP BY orbit HAVING avg(d) > 105.5) GROUP BY orbiter, orbit")
def semi_orbits(spark, sf_dir):
    s = samples_view(spark, sf_dir)
    far = s.groupBy("orbit").agg(F.avg("d").alias("m")).where("m > 105.5").select("orbit")
    return filters.member(s, far, "orbit").groupBy("orbiter", "orbit").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT orbiter, orbit, count(*) AS n, round(sum(t1), 4) AS t1 FROM samples GROUP BY orbiter, orbit")
def orbit_union(spark, sf_dir):
    s = samples_view(spark, sf_dir)
    one = lambda o: s.where(F.col("orbiter") == o).drop("orbiter").withColumn("orbiter", F.lit(o))
    return one("a").unionByName(one("b")).groupBy("orbiter", "orbit").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("t1"), 4).alias("t1"))


@query("""SELECT key, line, (closer AND outside) OR off AS visible, closer, outside, off AS off_axis FROM (
  SELECT key, line, m - b < 0 AS closer, m - b <= 1737.4 AS outside, acos(greatest(-1, least(1, dot / (b * m)))) >= atan(1737.4 / b) AS off FROM (
    SELECT key, line, sqrt(lat * lat + lon * lon + 4000000.0) AS b, sqrt(t1 * t1 + t2 * t2 + d * d * 900) AS m, lat * t1 + lon * t2 + 2000 * d * 30 AS dot FROM samples))""")
def line_of_sight(spark, sf_dir):
    s = samples_view(spark, sf_dir).withColumns({"bz": F.lit(2000.0), "tz": F.col("d") * 30})
    seen = filters.line_of_sight(("lat", "lon", "bz"), ("t1", "t2", "tz"), MOON_RADIUS_KM)
    return s.select("key", "line", *[c.alias(n) for n, c in seen.items()])


@query("SELECT max(abs(lat)) AS max_lat, min(d) AS min_d, max(d) AS max_d, CAST(count(DISTINCT orbit) AS BIGINT) AS orbits FROM samples")
def global_extremes(spark, sf_dir):
    return samples_view(spark, sf_dir).agg(F.max(F.abs("lat")).alias("max_lat"), F.min("d").alias("min_d"), F.max("d").alias("max_d"), F.count_distinct("orbit").alias("orbits"))


# --- flags

OK = {"a": "A", "b": "N"}
MISSION_SQL = "m AS (SELECT *, CASE WHEN (orbiter = 'a' AND mflag = 'A') OR (orbiter = 'b' AND mflag = 'N') THEN 0 ELSE 1 END AS f0 FROM samples)"
TALLY = "SELECT orbiter, orbit, CAST({f} AS INTEGER) AS flag, count(*) AS n FROM {t} GROUP BY ALL"


def tally(df: DataFrame) -> DataFrame:
    return df.groupBy("orbiter", "orbit", "flag").agg(F.count(F.lit(1)).alias("n"))


def started(spark, sf_dir) -> DataFrame:
    return flags.mission(OK)(samples_view(spark, sf_dir))


@query(TALLY.format(f="f0", t="m"), MISSION_SQL)
def mission_flag(spark, sf_dir):
    return tally(started(spark, sf_dir))


@query(TALLY.format(f="f0 + CASE WHEN f0 = 0 AND least(t1, t2, t3, t4) < 190 THEN 2 ELSE 0 END", t="m"), MISSION_SQL)
def flag_low_temp(spark, sf_dir):
    return tally(flags.low_temp(190.0)(started(spark, sf_dir)))


@query(TALLY.format(f="f0 + CASE WHEN f0 = 0 AND greatest(t1, t2, t3, t4) - least(t1, t2, t3, t4) > 75 THEN 4 ELSE 0 END", t="m"), MISSION_SQL)
def flag_channel_offset(spark, sf_dir):
    return tally(flags.channel_spread(75.0)(started(spark, sf_dir)))


@query(TALLY.format(f="f0 + CASE WHEN f0 = 0 AND orbit IN (2, 3, 5, 7) THEN 8 ELSE 0 END", t="m"), MISSION_SQL)
def flag_bad_orbits(spark, sf_dir):
    return tally(flags.bad_orbits((2, 3, 5, 7))(started(spark, sf_dir)))


@query(TALLY.format(f="f0 + CASE WHEN f0 = 0 AND k < 372 THEN 16 ELSE 0 END", t="m LEFT JOIN k USING (orbit)"), MISSION_SQL + ", k AS (SELECT orbit, count(*) AS k FROM m WHERE f0 = 0 GROUP BY orbit)")
def flag_small_orbits(spark, sf_dir):
    return tally(flags.small_orbits(372)(started(spark, sf_dir)))


@query("SELECT event_id, CAST(CASE WHEN count(*) OVER (PARTITION BY date_trunc('minute', ts)) > 1 THEN 32 ELSE 0 END AS INTEGER) AS flag FROM events", samples=False)
def flag_timedupes(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.date_trunc("minute", "ts").alias("utc"), F.lit(0).alias("flag"))
    return flags.time_twice()(e).select("event_id", "flag")


@query("SELECT date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1", samples=False)
def repeated_times(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return flags.repeated_times(e, F.date_trunc("minute", "ts")).select(F.col("_time").cast("timestamp_ntz").alias("minute"), "n")


@query(TALLY.format(f="f0 + CASE WHEN f0 = 0 AND orbit >= 40 AND orbit < 60 THEN 64 ELSE 0 END", t="m"), MISSION_SQL)
def flag_exclude_orbits(spark, sf_dir):
    return tally(flags.excluded((40, 60))(started(spark, sf_dir)))


@query("""SELECT orbit FROM o, med, mad WHERE abs(mean - m1) > 2.5 * d1 OR abs(slope - m2) > 2.5 * d2""",
       """o AS (SELECT orbit, round(avg(t2), 6) AS mean, round(regr_slope(t2, abs(lat)), 9) AS slope FROM samples GROUP BY orbit),
  med AS (SELECT quantile_cont(mean, 0.5) AS m1, quantile_cont(slope, 0.5) AS m2 FROM o),
  mad AS (SELECT quantile_cont(abs(mean - m1), 0.5) AS d1, quantile_cont(abs(slope - m2), 0.5) AS d2 FROM o, med)""")
def flag_mad_outliers(spark, sf_dir):
    s = samples_view(spark, sf_dir)
    o = s.groupBy("orbit").agg(F.round(F.avg("t2"), 6).alias("mean"), F.round(F.regr_slope("t2", F.abs("lat")), 9).alias("slope"))
    return flags.mad_outliers(o, ["mean", "slope"], 2.5).select("orbit")


def gauss_newton_sql(rows: str, key: str, weight: str = "1", rounds: int = 25) -> str:
    """fit (key, a, b): the least squares of a * cos(lat) ** b by plain Gauss-Newton steps over rows (key, c = ln cos lat, t)."""
    return f"""RECURSIVE it AS (SELECT DISTINCT {key}, 231.0::DOUBLE AS a, 0.35::DOUBLE AS b, 0 AS i FROM {rows}
    UNION ALL SELECT {key}, a + (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), b + (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12), i + 1 FROM (
      SELECT {key}, a, b, i, sum({weight} * e * e) AS h11, sum({weight} * a * e * e * c) AS h12, sum({weight} * a * a * e * e * c * c) AS h22, sum({weight} * e * (t - a * e)) AS g1, sum({weight} * a * e * c * (t - a * e)) AS g2
      FROM (SELECT it.*, x.* EXCLUDE ({key}), exp(it.b * x.c) AS e FROM it JOIN {rows} x USING ({key})) WHERE i < {rounds} GROUP BY {key}, a, b, i)),
  fit AS (SELECT {key}, a, b FROM it WHERE i = {rounds})"""


LATMODEL_SQL = MISSION_SQL + """,
  rows AS (SELECT orbit, t2 AS t, ln(cos(radians(abs(lat)))) AS c FROM m WHERE f0 = 0 AND abs(lat) < 85),
  """ + gauss_newton_sql("rows", "orbit") + """,
  med AS (SELECT quantile_cont(a, 0.5) AS ma, quantile_cont(b, 0.5) AS mb FROM fit),
  mad AS (SELECT quantile_cont(abs(a - ma), 0.5) AS da, quantile_cont(abs(b - mb), 0.5) AS db FROM fit, med),
  out AS (SELECT orbit FROM fit, med, mad WHERE abs(a - ma) > 3 * da OR abs(b - mb) > 3 * db)"""


@query(TALLY.format(f="f0 + CASE WHEN f0 = 0 AND orbit IN (SELECT orbit FROM out) THEN 128 ELSE 0 END", t="m"), LATMODEL_SQL)
def flag_latmodel(spark, sf_dir):
    return tally(flags.lat_model(3.0, "t2")(started(spark, sf_dir)))


LATCUT_SQL = """x AS (SELECT orbit, floor(lat) AS tile, t2 FROM {t} WHERE {f} = 0 AND lat <> floor(lat)),
  g AS (SELECT tile, avg(t2) AS mean, stddev_samp(t2) AS std FROM x GROUP BY tile),
  o AS (SELECT tile, orbit, avg(t2) AS own, count(*) AS n FROM x GROUP BY tile, orbit HAVING count(*) >= {n}),
  v AS (SELECT orbit, count(*) AS votes FROM o JOIN g USING (tile) WHERE abs(own - mean) > {k} * std GROUP BY orbit),
  c AS (SELECT orbit FROM v WHERE votes > (SELECT quantile_cont(votes, {p}) FROM v))"""


@query(TALLY.format(f="f0 + CASE WHEN f0 = 0 AND orbit IN (SELECT orbit FROM c) THEN 256 ELSE 0 END", t="m"), MISSION_SQL + ", " + LATCUT_SQL.format(t="m", f="f0", n=2, k=2, p=0.5))
def flag_latcut(spark, sf_dir):
    s = started(spark, sf_dir)
    return tally(flags.flag_orbits(s, flags.lat_cut_orbits(flags.latitude_votes(s, "t2", 2), 0.5), flags.LAT_CUT))


CHAIN_SQL = MISSION_SQL + """,
  a1 AS (SELECT *, f0 + CASE WHEN f0 = 0 AND least(t1, t2, t3, t4) < 190 THEN 2 ELSE 0 END AS f1 FROM m),
  a2 AS (SELECT *, f1 + CASE WHEN f1 = 0 AND greatest(t1, t2, t3, t4) - least(t1, t2, t3, t4) > 75 THEN 4 ELSE 0 END AS f2 FROM a1),
  k AS (SELECT orbit, count(*) AS k FROM a2 WHERE f2 = 0 GROUP BY orbit),
  a3 AS (SELECT *, f2 + CASE WHEN f2 = 0 AND k < 250 THEN 16 ELSE 0 END AS f3 FROM a2 LEFT JOIN k USING (orbit)),
  a4 AS (SELECT *, f3 + CASE WHEN f3 = 0 AND orbit IN (2, 3) THEN 8 ELSE 0 END AS f4 FROM a3),
  a5 AS (SELECT *, f4 + CASE WHEN f4 = 0 AND orbit >= 40 AND orbit < 60 THEN 64 ELSE 0 END AS f5 FROM a4),
  """ + LATCUT_SQL.format(t="a5", f="f5", n=2, k=2, p=0.5) + """,
  fin AS (SELECT orbiter, orbit, f5 + CASE WHEN f5 = 0 AND orbit IN (SELECT orbit FROM c) THEN 256 ELSE 0 END AS flag FROM a5)"""


def chained(spark, sf_dir) -> DataFrame:
    votes = flags.aggregating(lambda df: flags.flag_orbits(df, flags.lat_cut_orbits(flags.latitude_votes(df, "t2", 2), 0.5), flags.LAT_CUT))
    steps = [flags.low_temp(190.0), flags.channel_spread(75.0), flags.small_orbits(250), flags.bad_orbits((2, 3)), flags.excluded((40, 60)), votes]
    return flags.apply_flags(samples_view(spark, sf_dir), flags.mission(OK), steps)


@query(TALLY.format(f="flag", t="fin"), CHAIN_SQL)
def flag_pipeline(spark, sf_dir):
    return tally(chained(spark, sf_dir))


@query(f"SELECT CAST(1 << b AS INTEGER) AS bit, CAST(sum(CASE WHEN flag & (1 << b) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n, {q('sum(CASE WHEN flag & (1 << b) > 0 THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*)')} AS percent FROM fin, range(9) t(b) GROUP BY b", CHAIN_SQL)
def flag_summary(spark, sf_dir):
    return flags.summary(chained(spark, sf_dir)).select("bit", F.col("n").cast("long").alias("n"), r("percent").alias("percent"))


# --- names and times

@query("SELECT DISTINCT orbit, CAST(orbit AS INTEGER) AS number FROM samples")
def orbit_number_regex(spark, sf_dir):
    s = samples_view(spark, sf_dir).select("orbit").distinct()
    path = F.format_string("/x/OBS_L2C_20071127_%04d_A.2C", F.col("orbit"))
    return s.select("orbit", names.orbit_number(path).alias("number"))


@query("SELECT orbiter, CAST(floor(ltst * 24 / 2) * 2 AS INTEGER) AS bin_start, count(*) AS n FROM samples GROUP BY ALL")
def ltst_bins(spark, sf_dir):
    return samples_view(spark, sf_dir).groupBy("orbiter", times.local_bin(F.col("ltst"), 2).alias("bin_start")).agg(F.count(F.lit(1)).alias("n"))


def _leap_sql() -> str:
    rows = " ".join(f"WHEN ts >= TIMESTAMP '{d}' THEN {s}" for d, s in reversed(times.LEAP_SECONDS))
    return f"CASE {rows} ELSE {times.LEAP_SECONDS[0][1]} END"


@query(f"SELECT event_id, u / 86400.0::DOUBLE + 2440587.5::DOUBLE AS jd, u + leap + {lit(times.TT_MINUS_TAI - 10957.5 * 86400.0)} AS et FROM e", f"e AS (SELECT event_id, epoch_us(ts) / 1000000.0::DOUBLE AS u, {_leap_sql()} AS leap FROM events)", samples=False)
def julian_date(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    u = times.unix_seconds(F.col("ts"))
    return e.select("event_id", times.julian_date(u).alias("jd"), times.ephemeris_seconds(u).alias("et"))


@query("SELECT bin_start, CAST(bin_start AS VARCHAR) || '_' || CAST(bin_start + 2 AS VARCHAR) AS label, lpad(CAST(bin_start AS VARCHAR), 2, '0') || ':00-' || lpad(CAST(bin_start + 2 AS VARCHAR), 2, '0') || ':00' AS clock FROM (SELECT DISTINCT CAST(floor(ltst * 24 / 2) * 2 AS INTEGER) AS bin_start FROM samples)")
def hour_labels(spark, sf_dir):
    b = samples_view(spark, sf_dir).select(times.local_bin(F.col("ltst"), 2).alias("bin_start")).distinct()
    label = names.hour_label(F.col("bin_start") / 24.0, (F.col("bin_start") + 2) / 24.0)
    return b.select("bin_start", label.alias("label"), names.bin_clock_label(F.concat(F.lit("TEMP_"), label)).alias("clock"))


@query("""SELECT orbiter, orbit, '<title>Orbit ' || orbit || ' of ' || orbiter || ': ' || n || ' samples</title>' AS label FROM (SELECT orbiter, orbit, count(*) AS n FROM samples GROUP BY orbiter, orbit)""")
def template_fill(spark, sf_dir):
    o = samples_view(spark, sf_dir).groupBy("orbiter", "orbit").agg(F.count(F.lit(1)).alias("n"))
    label = templates.fill_column(F.lit("<title>Orbit {orbit} of {orbiter}: {count} samples</title>"), {"orbit": F.col("orbit"), "orbiter": F.col("orbiter"), "count": F.col("n")})
    return o.select("orbiter", "orbit", label.alias("label"))


@query("""SELECT CAST(h AS INTEGER) AS hour, 'a_t2_ltst_' || h || '_' || (h + 2) || '_lat_m' || (75 - h) || '_75_lon_m180_180_deconv' AS name FROM range(0, 24, 2) t(h)""", samples=False, reads=False)
def product_names(spark, sf_dir):
    h = spark.range(0, 24, 2).select(F.col("id").cast("int").alias("hour"))
    x = F.col("hour").cast("double")
    name = names.map_name(F.lit("a"), F.lit(2), [x / 24, (x + 2) / 24], [x - 75.0, F.lit(75.0)], [F.lit(-180.0), F.lit(180.0)])
    return h.select("hour", name.alias("name"))


@query("SELECT orbiter || '/' || strftime(utc, '%Y%m') AS folder, count(*) AS n FROM samples GROUP BY ALL")
def month_folders(spark, sf_dir):
    return samples_view(spark, sf_dir).groupBy(names.month_folder(F.col("orbiter"), F.col("utc")).alias("folder")).agg(F.count(F.lit(1)).alias("n"))


# --- vectors

@query(f"""SELECT key, line, {q('1737.4 * cos(radians(lat)) * cos(radians(lon))')} AS sx, {q('1737.4 * cos(radians(lat)) * sin(radians(lon))')} AS sy, {q('1737.4 * sin(radians(lat))')} AS sz,
  {q('sin(radians(lat))')} AS nz, {q('(1737.4 + d) * sin(radians(lat))')} AS bz FROM samples""")
def surface_vectors(spark, sf_dir):
    out = ephemeris.with_vectors(samples_view(spark, sf_dir).drop("ltst").withColumn("et", F.lit(0.0)))
    return out.select("key", "line", *[r(c).alias(c) for c in ("sx", "sy", "sz", "nz", "bz")])


@query(f"SELECT key, line, {q('(((lon - s) / 360 + 0.5) - floor((lon - s) / 360 + 0.5))')} AS ltst FROM (SELECT key, line, lon, (lat * 2) AS s FROM samples)")
def local_solar_time(spark, sf_dir):
    s = samples_view(spark, sf_dir)
    return s.select("key", "line", r(ephemeris.local_solar_time(F.col("lon"), F.col("lat") * 2)).alias("ltst"))


# --- grids

@query("SELECT CAST(row_number() OVER (ORDER BY lat, albedo, h) - 1 AS BIGINT) AS run, lat, albedo, h FROM (VALUES (0.0::DOUBLE), (30.0), (60.0)) a(lat), (VALUES (0.08::DOUBLE), (0.12)) b(albedo), (VALUES (0.05::DOUBLE), (0.07)) c(h)", samples=False, reads=False)
def param_grid_cross(spark, sf_dir):
    return thermal.sweep(spark, [0.0, 30.0, 60.0], [0.08, 0.12], [0.05, 0.07])


@query("SELECT CAST(floor((lat + 75) / 4) AS INTEGER) AS tile_lat, CAST(floor((lon + 180) / 4) AS INTEGER) AS tile_lon, count(*) AS n FROM samples WHERE lat >= -75 AND lat < 75 AND lon >= -180 AND lon < 180 GROUP BY ALL")
def tile_assign(spark, sf_dir):
    t = grids.Tiling((-75.0, 75.0), (-180.0, 180.0), 4.0)
    return t.assign(samples_view(spark, sf_dir)).groupBy("tile_lat", "tile_lon").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(i AS INTEGER) AS tile_lat, CAST(j AS INTEGER) AS tile_lon, i * 4.0::DOUBLE - 75 AS lat_lo, least(75.0::DOUBLE, (i + 1) * 4.0::DOUBLE - 75) AS lat_hi, j * 4.0::DOUBLE - 180 AS lon_lo, least(180.0::DOUBLE, (j + 1) * 4.0::DOUBLE - 180) AS lon_hi FROM range(38) a(i), range(90) b(j)", samples=False, reads=False)
def tile_specs(spark, sf_dir):
    return grids.Tiling((-75.0, 75.0), (-180.0, 180.0), 4.0).specs(spark)


G5 = grids.full_grid(5.0, (-90.0, 90.0), (-180.0, 180.0))
CELL_SQL = "CAST(floor((lat + 90) / 5) AS INTEGER) AS lat_ix, CAST(floor((lon + 180) / 5) AS INTEGER) AS lon_ix"
MAP_SQL = f"g AS (SELECT {CELL_SQL}, count(*)::DOUBLE AS w, sum(t2) AS wt, sum(t2 * t2) AS wt2 FROM samples GROUP BY ALL), c AS (SELECT lat_ix, lon_ix, w, {q('wt / w', 9)} AS value FROM g)"


def cells(spark, sf_dir, channel: str = "t2") -> DataFrame:
    s = samples_view(spark, sf_dir).withColumn("t", F.col(channel))
    return grids.finish_moments(grids.weighted_moments(G5.place(s))).withColumn("value", r("mean", 9))


@query(f"SELECT lat_ix, lon_ix, lat_ix * 5.0::DOUBLE - 90 AS lat, lon_ix * 5.0::DOUBLE - 180 AS lon, w, {q('wt / w', 9)} AS mean, {q('sqrt(greatest(0, (wt2 * w - wt * wt) / (w * w)))', 4)} AS std FROM (SELECT {CELL_SQL}, count(*)::DOUBLE AS w, sum(t2) AS wt, sum(t2 * t2) AS wt2 FROM samples WHERE orbiter = 'a' AND ltst >= {lit(10 / 24)} AND ltst < {lit(14 / 24)} GROUP BY ALL)")
def binned_map(spark, sf_dir):
    m = maps.binned_map(samples_view(spark, sf_dir), MapSpec("a", 2, (10 / 24, 14 / 24), (-90.0, 90.0), resolution=5.0, unflagged=False))
    return m.select("lat_ix", "lon_ix", "lat", "lon", "w", r("mean", 9).alias("mean"), r("std", 4).alias("std"))


@query(f"SELECT bin_start, lat_ix, lon_ix, w, {q('wt / w', 9)} AS mean, {q('sqrt(greatest(0, (wt2 * w - wt * wt) / (w * w)))', 4)} AS std FROM (SELECT CAST(floor(ltst * 24 / 2) * 2 AS INTEGER) AS bin_start, {CELL_SQL}, count(*)::DOUBLE AS w, sum(t2) AS wt, sum(t2 * t2) AS wt2 FROM samples WHERE orbiter = 'a' GROUP BY ALL)")
def all_bins_map(spark, sf_dir):
    m = maps.all_bins_map(samples_view(spark, sf_dir), MapSpec("a", 2, None, (-90.0, 90.0), resolution=5.0, unflagged=False))
    return m.select("bin_start", "lat_ix", "lon_ix", "w", r("mean", 9).alias("mean"), r("std", 4).alias("std"))


@query("SELECT lat_ix, CAST((lon_ix + 4) % 72 AS INTEGER) AS lon_ix, w FROM g", MAP_SQL)
def lon_wrap_fold(spark, sf_dir):
    c = cells(spark, sf_dir).withColumn("lon_ix", F.col("lon_ix") + 76)
    return grids.wrap_longitude(c, 72).groupBy("lat_ix", "lon_ix").agg(F.sum("w").alias("w"))


@query("SELECT lat_ix, CAST((lon_ix + 36) % 72 AS INTEGER) AS lon_ix, value FROM c", MAP_SQL)
def roll_longitude(spark, sf_dir):
    return grids.roll_longitude(cells(spark, sf_dir), 72).select("lat_ix", "lon_ix", "value")


@query(f"SELECT CAST(lat_ix // 4 AS INTEGER) AS lat_ix, CAST(lon_ix // 4 AS INTEGER) AS lon_ix, {q('avg(w)', 8)} AS value FROM g GROUP BY ALL", MAP_SQL)
def block_mean_downsample(spark, sf_dir):
    return grids.block_mean(cells(spark, sf_dir).select("lat_ix", "lon_ix", F.col("w").alias("value")), 4).withColumn("value", r("value", 8))


@query("SELECT CAST(35 - lat_ix AS INTEGER) AS lat_ix, lon_ix, value FROM c", MAP_SQL)
def flip_north_up(spark, sf_dir):
    return grids.flip_latitude(cells(spark, sf_dir), 36).select("lat_ix", "lon_ix", "value")


_KERNEL = ", ".join(f"({o}, {lit(w)})" for o, w in grids.gaussian_weights(1.0))


@query(f"SELECT CAST(lat_ix + a.o AS INTEGER) AS lat_ix, CAST(lon_ix + b.o AS INTEGER) AS lon_ix, {q('sum(w * a.k * b.k)')} AS w FROM g, (VALUES {_KERNEL}) a(o, k), (VALUES {_KERNEL}) b(o, k) GROUP BY ALL", MAP_SQL)
def gaussian_smooth(spark, sf_dir):
    return grids.smooth(cells(spark, sf_dir), 1.0, ["w"]).select("lat_ix", "lon_ix", r("w").alias("w"))


@query("""SELECT h.lat_ix, h.lon_ix, coalesce(h.value, (SELECT arg_min(v.value, {'d': (v.lat_ix - h.lat_ix) ** 2 + (v.lon_ix - h.lon_ix) ** 2, 'y': v.lat_ix, 'x': v.lon_ix}) FROM x v WHERE v.value IS NOT NULL AND (v.lat_ix - h.lat_ix) ** 2 + (v.lon_ix - h.lon_ix) ** 2 <= 16)) AS value FROM x h""", MAP_SQL + ", x AS (SELECT lat_ix, lon_ix, CASE WHEN (lat_ix * 7 + lon_ix * 3) % 4 > 0 THEN value END AS value FROM c)")
def nearest_fill(spark, sf_dir):
    c = cells(spark, sf_dir).select("lat_ix", "lon_ix", F.when((F.col("lat_ix") * 7 + F.col("lon_ix") * 3) % 4 > 0, F.col("value")).alias("value"))
    return grids.nearest_fill(c, 4)


@query("""SELECT h.lat_ix, h.lon_ix, coalesce(h.value, (SELECT arg_min(v.value, {'d': (v.lat_ix - h.lat_ix) ** 2 + (v.lon_ix - h.lon_ix) ** 2, 'y': v.lat_ix, 'x': v.lon_ix}) FROM x v WHERE v.value IS NOT NULL)) AS value FROM x h""", MAP_SQL + ", x AS (SELECT lat_ix, lon_ix, CASE WHEN lat_ix % 13 < 2 AND lon_ix % 17 < 3 THEN value END AS value FROM c)")
def nearest_fill_far(spark, sf_dir):
    c = cells(spark, sf_dir).select("lat_ix", "lon_ix", F.when((F.col("lat_ix") % 13 < 2) & (F.col("lon_ix") % 17 < 3), F.col("value")).alias("value"))
    return grids.nearest_fill(c)


@query(f"""SELECT CAST(lat_ix // 4 AS INTEGER) AS lat_ix, CAST(lon_ix // 4 AS INTEGER) AS lon_ix, {q('avg(value)', 8)} AS value FROM (
  SELECT h.lat_ix - 6 AS lat_ix, h.lon_ix, coalesce(h.value, (SELECT arg_min(v.value, {{'d': (v.lat_ix - h.lat_ix) ** 2 + (v.lon_ix - h.lon_ix) ** 2, 'y': v.lat_ix, 'x': v.lon_ix}}) FROM x v WHERE v.value IS NOT NULL)) AS value FROM x h) GROUP BY ALL""",
       MAP_SQL + ", lim AS (SELECT quantile_cont(value, 0.3) AS lo FROM c), x AS (SELECT lat_ix, lon_ix, CASE WHEN value > lo THEN value END AS value FROM c, lim WHERE lat_ix >= 6 AND lat_ix < 30)")
def prepared_source(spark, sf_dir):
    c = cells(spark, sf_dir).select("lat_ix", "lon_ix", "value")
    lo = residual.quantiles(c, "value", [0.3])[0]
    return maps.prepare_source(c, 4, lo=lo, rows=(6, 30)).withColumn("value", r("value", 8))


@query("SELECT key, line, orbit FROM (SELECT *, row_number() OVER (PARTITION BY orbit ORDER BY key, line) - 1 AS i, count(*) OVER (PARTITION BY orbit) AS n FROM samples) WHERE i < n - 1 AND i % greatest(1, n // 30) = 0")
def orbit_downsample(spark, sf_dir):
    return grids.downsample_orbit(samples_view(spark, sf_dir), 30, ["key", "line"]).select("key", "line", "orbit")


@query("SELECT min(orbit) AS orbit FROM (SELECT orbit, ntile(7) OVER (ORDER BY orbit) AS g FROM (SELECT DISTINCT orbit FROM samples)) GROUP BY g")
def representative_orbits(spark, sf_dir):
    return grids.representatives(samples_view(spark, sf_dir), "orbit", 7)


@query("SELECT key, line, lat, lon, d FROM samples ORDER BY lat DESC, key, line LIMIT 1")
def argmax_row(spark, sf_dir):
    return grids.arg_max_row(samples_view(spark, sf_dir), "lat", ["key", "line"]).select("key", "line", "lat", "lon", "d")


@query(f"SELECT CAST(least(11, floor((lat - a) / (b - a) * 12)) AS INTEGER) AS lat_ix, CAST(least(11, floor((lon - e) / (f - e) * 12)) AS INTEGER) AS lon_ix, {q('avg(t1)')} AS t1 FROM samples, (SELECT min(lat) a, max(lat) b, min(lon) e, max(lon) f FROM samples) GROUP BY ALL")
def mean_histogram(spark, sf_dir):
    return grids.mean_histogram(samples_view(spark, sf_dir), 12, "t1").withColumn("t1", r("t1"))


@query("SELECT x AS target, list_sort(list(lat_ix))[len(list(lat_ix)) // 2 + 1] AS position FROM (SELECT lat_ix, lat_ix * 5.0::DOUBLE - 90 AS lat FROM range(36) t(lat_ix)), (VALUES (-60.0::DOUBLE), (0.0), (45.0)) v(x) WHERE abs(lat - x) <= 6 GROUP BY x", samples=False, reads=False)
def tick_positions(spark, sf_dir):
    a = spark.range(36).select(F.col("id").alias("lat_ix"), (F.col("id") * 5.0 - 90).alias("lat"))
    return grids.tick_positions(a, "lat_ix", "lat", [-60.0, 0.0, 45.0], 6.0)


# --- footprints

_A2 = ANTENNAS[2]


def kernel_sql(step: float, n: int) -> str:
    beam = f"{lit(_A2.main_power)} * (exp(-pow((theta + {lit(_A2.main_width / 2)}) / {lit(_A2.sigma)}, 2)) + exp(-pow((theta - {lit(_A2.main_width / 2)}) / {lit(_A2.sigma)}, 2)))"
    side = 2 * n + 1
    return f"""k0 AS (SELECT id AS k, (id % {side} - {n}) * {lit(step)} AS az, (id // {side} - {n}) * {lit(step)} AS el FROM range({side * side}) t(id)),
  k1 AS (SELECT *, sqrt(az * az + el * el) AS theta FROM k0),
  k2 AS (SELECT *, {beam} AS gain, 2 * tan(radians(az) / 2) AS x, 2 * tan(radians(el) / 2) AS y FROM k1 WHERE theta < {lit(_A2.main_width / 2)}),
  k3 AS (SELECT k, sqrt(x * x + y * y) AS rad, x, y, pow(10, (gain - max(gain) OVER ()) / 10) AS weight FROM k2),
  kernel AS (SELECT k, CASE WHEN rad > 0 THEN x / rad ELSE 0 END AS x, CASE WHEN rad > 0 THEN y / rad ELSE 0 END AS y, rad / 1737.4 AS r, weight FROM k3)"""


PROJECT_SQL = """p AS (SELECT s.*, k, weight, degrees(asin(greatest(-1, least(1, cos(r * d) * sin(radians(lat)) + y * sin(r * d) * cos(radians(lat)))))) AS plat,
    lon + degrees(atan2(x * sin(r * d), cos(r * d) * cos(radians(lat)) - y * sin(r * d) * cos(radians(lat)))) AS plon
  FROM (SELECT * FROM samples WHERE {where}) s, kernel)"""
SPREAD_SQL = """sums AS (SELECT CAST(floor((plat + 90.0037) / 5) AS INTEGER) AS lat_ix, CAST((CAST(floor((plon + 180.0037) / 5) AS BIGINT) % 72 + 72) % 72 AS INTEGER) AS lon_ix,
    sum(weight) AS w, sum(weight * t2) AS wt, sum(weight * t2 * t2) AS wt2 FROM p WHERE floor((plat + 90.0037) / 5) BETWEEN 0 AND 36 GROUP BY ALL)"""


@query(f"SELECT k, {q('x', 9)} AS x_over_rad, {q('y', 9)} AS y_over_rad, {q('r', 12)} AS scaled_rad, {q('weight', 9)} AS weight FROM kernel", kernel_sql(1.0, 28), samples=False, reads=False)
def antenna_kernel(spark, sf_dir):
    k = footprint.kernel(spark, 2, 1.0)
    return k.select("k", r("x_over_rad", 9).alias("x_over_rad"), r("y_over_rad", 9).alias("y_over_rad"), r("scaled_rad", 12).alias("scaled_rad"), r("weight", 9).alias("weight"))


@query(f"SELECT key, line, k, {q('plat')} AS lat, {q('plon')} AS lon FROM p", kernel_sql(4.0, 7) + ", " + PROJECT_SQL.format(where="true"))
def footprint_project(spark, sf_dir):
    s = samples_view(spark, sf_dir).crossJoin(F.broadcast(footprint.kernel(spark, 2, 4.0)))
    lat, lon = footprint.project(F.col("d"), F.col("lat"), F.col("lon"), F.col("x_over_rad"), F.col("y_over_rad"), F.col("scaled_rad"))
    return s.select("key", "line", "k", r2(lat).alias("lat"), r2(lon).alias("lon"))


#: Cell edges off the hundredths of a degree that sample positions have.
G5_OFF = grids.Grid(grids.Axis(-90.0037, 5.0, 37), grids.Axis(-180.0037, 5.0, 72))


def _slice(spark, sf_dir) -> DataFrame:
    return samples_view(spark, sf_dir).where("orbiter = 'a' and ltst < 0.25").withColumn("t", F.col("t2"))


_DECONV = kernel_sql(4.0, 7) + ", " + PROJECT_SQL.format(where="orbiter = 'a' AND ltst < 0.25") + ", " + SPREAD_SQL


_WHOLE = kernel_sql(4.0, 7) + ", " + PROJECT_SQL.format(where="true") + ", " + SPREAD_SQL


def _all(spark, sf_dir) -> DataFrame:
    return samples_view(spark, sf_dir).withColumn("t", F.col("t2"))


def _spread(rows: DataFrame) -> DataFrame:
    return footprint.spread_samples(rows, footprint.kernel(rows.sparkSession, 2, 4.0), G5_OFF, 72)


@query(f"SELECT lat_ix, lon_ix, {q('w', 4)} AS w FROM sums", _WHOLE)
def weighted_hist2d(spark, sf_dir):
    return _spread(_all(spark, sf_dir)).select("lat_ix", "lon_ix", r("w", 4).alias("w"))


@query(f"SELECT lat_ix, lon_ix, {q('w', 4)} AS w, {q('wt', 3)} AS wt, {q('wt2', 1)} AS wt2 FROM sums", _DECONV)
def deconv_moments(spark, sf_dir):
    return _spread(_slice(spark, sf_dir)).select("lat_ix", "lon_ix", r("w", 4).alias("w"), r("wt", 3).alias("wt"), r("wt2", 1).alias("wt2"))


@query(f"SELECT lat_ix, lon_ix, {q('wt / w', 8)} AS mean, {q('sqrt(round(greatest(0, (wt2 * w - wt * wt) / (w * w)), 5))')} AS std FROM sums", _DECONV)
def deconv_map(spark, sf_dir):
    d = footprint.deconvolve(_slice(spark, sf_dir), footprint.kernel(spark, 2, 4.0), G5_OFF, 72, dense=True)
    return d.select("lat_ix", "lon_ix", r("mean", 8).alias("mean"), r(F.sqrt(F.round(F.col("std") * F.col("std"), 5))).alias("std"))


_ALL_BINS = kernel_sql(4.0, 7) + ", " + PROJECT_SQL.format(where="true") + """, sums AS (SELECT orbiter, CAST(floor(ltst * 24 / 6) * 6 AS INTEGER) AS bin_start, CAST(floor((plat + 90.0037) / 5) AS INTEGER) AS lat_ix, CAST((CAST(floor((plon + 180.0037) / 5) AS BIGINT) % 72 + 72) % 72 AS INTEGER) AS lon_ix,
    sum(weight) AS w, sum(weight * t2) AS wt FROM p WHERE floor((plat + 90.0037) / 5) BETWEEN 0 AND 36 GROUP BY ALL)"""


@query(f"SELECT orbiter, CAST(2 AS INTEGER) AS channel, bin_start, lat_ix, lon_ix, {q('wt / w', 8)} AS mean FROM sums", _ALL_BINS)
def all_bins_deconv(spark, sf_dir):
    rows = filters.load_slices(samples_view(spark, sf_dir), MapSpec("", 2, None, (-90.0, 90.0), unflagged=False), [2])
    rows = rows.withColumn("bin_start", times.local_bin(F.col("ltst"), 6))
    k = footprint.kernel(spark, 2, 4.0).withColumn("channel", F.lit(2))
    d = footprint.deconvolve(rows, k, G5_OFF, 72, keys=["orbiter", "channel", "bin_start"])
    return d.select("orbiter", "channel", "bin_start", "lat_ix", "lon_ix", r("mean", 8).alias("mean"))


@query(f"SELECT {q('(max(plat) - min(plat)) / 2')} AS lat_spill, {q('(max(plon) - min(plon)) / 2')} AS lon_spill FROM p",
       kernel_sql(4.0, 7) + ", " + PROJECT_SQL.replace("(SELECT * FROM samples WHERE {where})", "(SELECT max(d) AS d, max(abs(lat)) AS lat, 0.0::DOUBLE AS lon FROM samples WHERE abs(lat) < 75)"))
def footprint_spill(spark, sf_dir):
    out = footprint.spill(samples_view(spark, sf_dir).where(F.abs("lat") < 75), footprint.kernel(spark, 2, 4.0))
    return out.select(r("lat_spill").alias("lat_spill"), r("lon_spill").alias("lon_spill"))


@query(f"SELECT key, line, {q('max(plat)')} AS top, {q('avg(cos(radians(plon)))')} AS east FROM p GROUP BY key, line", kernel_sql(4.0, 7) + ", " + PROJECT_SQL.format(where="true").replace("y * sin(r * d) * cos(radians(lat)))) AS plon", "y * sin(r * d) * sin(radians(lat)))) AS plon"))
def footprint_standard(spark, sf_dir):
    s = samples_view(spark, sf_dir).crossJoin(F.broadcast(footprint.kernel(spark, 2, 4.0)))
    lat, lon = footprint.project(F.col("d"), F.col("lat"), F.col("lon"), F.col("x_over_rad"), F.col("y_over_rad"), F.col("scaled_rad"), standard=True, wrap=True)
    out = s.select("key", "line", lat.alias("plat"), lon.alias("plon")).groupBy("key", "line").agg(F.max("plat").alias("top"), F.avg(F.cos(F.radians("plon"))).alias("east"))
    return out.select("key", "line", r("top").alias("top"), r("east").alias("east"))


_A4 = ANTENNAS[4]
_EDGE = footprint.side_lobe_edge(_A4, 2.0, 28.0)


def side_lobe_sql() -> str:
    peak = lambda x, at: f"exp(-pow(({x} - {lit(at)}) / {lit(_A4.sigma)}, 2))"
    main = f"{lit(_A4.main_power)} * ({peak('theta', -_A4.main_width / 2)} + {peak('theta', _A4.main_width / 2)})"
    s = f"((theta - {lit(_A4.main_width / 2)}) / {lit(_A4.side_ratio)})"
    side = f"{lit(_A4.main_power - _A4.side_peak)} * ({peak(s, 0.0)} + {peak(s, _A4.main_width)}) + {lit(_A4.side_peak)}"
    return f"""k0 AS (SELECT id AS k, sqrt(pow((id % 29 - 14) * 2, 2) + pow((id // 29 - 14) * 2, 2)) AS theta FROM range(841) t(id)),
  k1 AS (SELECT k, CASE WHEN theta < {lit(_A4.main_width / 2)} THEN {main} ELSE {side} END AS gain FROM k0 WHERE theta <= {lit(_EDGE)})"""


@query(f"SELECT k, {q('pow(10, (gain - max(gain) OVER ()) / 10)', 9)} AS weight FROM k1", side_lobe_sql(), samples=False, reads=False)
def side_lobe_kernel(spark, sf_dir):
    return footprint.kernel(spark, 4, 2.0, main_only=False).select("k", r("weight", 9).alias("weight"))


@query(f"SELECT lat_ix, lon_ix, CASE WHEN w >= 20 THEN {q('wt / w', 8)} END AS mean FROM sums", _WHOLE)
def coverage_mask(spark, sf_dir):
    d = footprint.deconvolve(_all(spark, sf_dir), footprint.kernel(spark, 2, 4.0), G5_OFF, 72, threshold=20.0)
    return d.select("lat_ix", "lon_ix", r("mean", 8).alias("mean"))


@query("SELECT lat_ix, lon_ix, count(*) AS n FROM (SELECT key, line, CAST(floor((plat + 90.0037) / 5) AS INTEGER) AS lat_ix, CAST((CAST(floor((plon + 180.0037) / 5) AS BIGINT) % 72 + 72) % 72 AS INTEGER) AS lon_ix, sum(weight) AS w FROM p GROUP BY ALL HAVING sum(weight) >= 7) GROUP BY ALL", kernel_sql(4.0, 7) + ", " + PROJECT_SQL.format(where="orbiter = 'a' AND ltst < 0.25"))
def sample_counts(spark, sf_dir):
    s = _slice(spark, sf_dir).withColumn("sample_id", F.struct("key", "line"))
    return footprint.sample_counts(s, footprint.kernel(spark, 2, 4.0), G5_OFF, 72, 7.0)


# --- residuals and display numbers

@query(f"SELECT lat_ix, lon_ix, {q('c.value - e.value', 9)} AS value FROM c JOIN e USING (lat_ix, lon_ix)", MAP_SQL + f", e AS (SELECT {CELL_SQL}, {q('avg(t3)', 9)} AS value FROM samples GROUP BY ALL)")
def grid_residual(spark, sf_dir):
    out = residual.grid_residual(cells(spark, sf_dir).select("lat_ix", "lon_ix", "value"), cells(spark, sf_dir, "t3"), ["lat_ix", "lon_ix"])
    return out.withColumn("value", r("value", 9))


@query(f"SELECT lat_ix, lon_ix, {q('value - 231 * pow(cos(radians(lat_ix * 5 - 87.5::DOUBLE)), 0.35::DOUBLE)', 8)} AS value FROM c", MAP_SQL)
def lat_trend_residual(spark, sf_dir):
    c = cells(spark, sf_dir).withColumn("lat", F.col("lat_ix") * 5 - F.lit(87.5))
    return residual.latitude_residual(c, 231.0, 0.35).select("lat_ix", "lon_ix", r("value", 8).alias("value"))


@query(f"SELECT lat_ix, lon_ix, {q('value - fit.a * pow(cos(radians(lat_ix * 5 - 87.5::DOUBLE)), fit.b)', 3)} AS value FROM c, fit", MAP_SQL + ", rows AS (SELECT 1 AS one, value AS t, ln(cos(radians(abs(lat_ix * 5 - 87.5::DOUBLE)))) AS c FROM c), " + gauss_newton_sql("rows", "one"))
def lat_trend_fit(spark, sf_dir):
    c = cells(spark, sf_dir).withColumn("lat", F.col("lat_ix") * 5 - F.lit(87.5))
    return residual.latitude_residual(c, *residual.fit_latitude_trend(c)).select("lat_ix", "lon_ix", r("value", 3).alias("value"))


@query(f"SELECT {q('1 - sum((t2 - t1) * (t2 - t1)) / sum((t2 - m) * (t2 - m))')} AS r_squared FROM samples, (SELECT avg(t2) AS m FROM samples)")
def r_squared(spark, sf_dir):
    return residual.r_squared(samples_view(spark, sf_dir), "t2", "t1").select(r("r_squared").alias("r_squared"))


@query(f"SELECT {q('max(abs(t2 - t1))')} AS max_abs, {q('max(abs(t2 - t1) / abs(t1)) * 100')} AS max_percent FROM samples")
def max_difference(spark, sf_dir):
    return residual.max_difference(samples_view(spark, sf_dir), "t2", "t1").select(r("max_abs").alias("max_abs"), r("max_percent").alias("max_percent"))


@query(f"SELECT lat_ix, lon_ix, CAST(coalesce(round((value - z) / s), -32768) AS INTEGER) AS q, {q('s', 12)} AS scale, {q('z')} AS zero FROM x, (SELECT (max(value) - min(value)) / 65534.0::DOUBLE AS s, (max(value) + min(value)) / 2 AS z FROM x)", MAP_SQL + ", x AS (SELECT lat_ix, lon_ix, CASE WHEN lat_ix % 5 > 0 THEN value END AS value FROM c)")
def quantize_int16(spark, sf_dir):
    c = cells(spark, sf_dir).select("lat_ix", "lon_ix", F.when(F.col("lat_ix") % 5 > 0, F.col("value")).alias("value"))
    return residual.check_quantized(residual.quantize(c)).select("lat_ix", "lon_ix", "q", r("scale", 12).alias("scale"), r("zero").alias("zero"))


@query(f"SELECT lat_ix, lon_ix, {q('least(hi, greatest(lo, value))', 8)} AS value FROM c, (SELECT quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM c)", MAP_SQL)
def percentile_clip(spark, sf_dir):
    return residual.clip_percentiles(cells(spark, sf_dir), 0.02, 0.98).select("lat_ix", "lon_ix", r("value", 8).alias("value"))


@query(f"SELECT lat_ix, lon_ix, {q('least(m + 1.5 * s, greatest(m - 1.5 * s, value))', 8)} AS value FROM c, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM c)", MAP_SQL)
def sigma_clip(spark, sf_dir):
    return residual.clip_sigma(cells(spark, sf_dir), 1.5).select("lat_ix", "lon_ix", r("value", 8).alias("value"))


@query(f"SELECT lat_ix, lon_ix, {q('CASE WHEN value < m THEN 0.5 + (value - m) / (m - lo) * 0.5 ELSE 0.5 + (value - m) / (hi - m) * 0.5 END')} AS shade FROM c, (SELECT avg(value) AS m, min(value) AS lo, max(value) AS hi FROM c)", MAP_SQL)
def centered_norm(spark, sf_dir):
    return residual.centred_norm(cells(spark, sf_dir)).select("lat_ix", "lon_ix", r("shade").alias("shade"))


# --- interpolation

@query(f"""SELECT orbit, CAST(i AS INTEGER) AS i, {q('v[lo + 1] + (v[least(lo + 1, n - 1) + 1] - v[lo + 1]) * (x - lo)')} AS value FROM (
  SELECT *, CAST(floor(x) AS BIGINT) AS lo FROM (SELECT orbit, v, len(v) AS n, i, least(i * len(v) / 23.0::DOUBLE, len(v) - 1.0::DOUBLE) AS x FROM a, range(24) t(i)))""", "a AS (SELECT orbit, list(t2 ORDER BY key, line, t2) AS v FROM samples GROUP BY orbit)")
def interp1d_time(spark, sf_dir):
    s = samples_view(spark, sf_dir).groupBy("orbit").agg(F.sort_array(F.collect_list(F.struct("key", "line", "t2"))).alias("v"))
    return s.select("orbit", F.posexplode(interpolate.resample(F.col("v.t2"), 24)).alias("i", "value")).withColumn("value", r("value"))


def _poly(lat: str, alb: str, h: str, hour: str) -> str:
    return f"(200 + 0.5::DOUBLE * {lat} - 40::DOUBLE * {alb} + 100::DOUBLE * {h} + 0.25::DOUBLE * {lat} * {h} + 1.5::DOUBLE * {hour} - 2::DOUBLE * {alb} * {hour})"


@query(f"SELECT key, line, {q(_poly('least(60, abs(lat))', 'least(0.17, (t1 - 180) / 250)', 'least(0.12, greatest(0.03, (round(t2) - 180) / 1000))', 'least(23.9, ltst * 24)'), 8)} AS tb FROM samples")
def multilinear_interp(spark, sf_dir):
    """The table holds a multilinear function, so the answer is that function at the clipped inputs."""
    t = spark.range(1)
    for name, v in {"a_lat": (0, 10, 25, 60), "a_alb": (0, 0.06, 0.17), "a_h": (0.03, 0.05, 0.12), "a_hour": (0, 6, 12.5, 18, 23.9)}.items():
        t = t.withColumn(name, F.explode(F.array(*[F.lit(float(x)) for x in v])))
    t = t.withColumn("v", F.expr(_poly("a_lat", "a_alb", "a_h", "a_hour").replace("::DOUBLE", "D")))
    s = samples_view(spark, sf_dir).select("key", "line", F.abs("lat").alias("x1"), ((F.col("t1") - 180) / 250).alias("x2"), ((F.round("t2") - 180) / 1000).alias("x3"), (F.col("ltst") * 24).alias("x4"))
    out = interpolate.multilinear(s, t, {"x1": "a_lat", "x2": "a_alb", "x3": "a_h", "x4": "a_hour"}, "v", "tb")
    return out.select("key", "line", r("tb", 8).alias("tb"))


@query(f"SELECT key, line, {q('least(1.5, greatest(-1.5, (t1 - 180) * sin(radians(lon)) * 24 / 360))')} AS shift FROM samples")
def ltst_shift(spark, sf_dir):
    return samples_view(spark, sf_dir).select("key", "line", r(units.slope_time_shift(F.col("t1") - 180, F.col("lon"))).alias("shift"))


@query(f"SELECT key, line, {q('-18 * x * x + 3.39 * x + 0.00427')} AS albedo FROM (SELECT key, line, (t1 - 180) / 500 AS x FROM samples)")
def hapke_albedo(spark, sf_dir):
    return samples_view(spark, sf_dir).select("key", "line", r(units.hapke_to_albedo((F.col("t1") - 180) / 500)).alias("albedo"))


@query(f"SELECT CAST(ppd AS INTEGER) AS ppd, {q('2 * pi() * 1737400 / 360 / ppd')} AS mpp FROM (VALUES (4), (8), (32)) v(ppd)", samples=False, reads=False)
def metres_per_pixel(spark, sf_dir):
    return spark.createDataFrame([(4,), (8,), (32,)], "ppd int").select("ppd", r(units.metres_per_pixel(F.col("ppd"))).alias("mpp"))


# --- physics

BODY = Body()
_CP = " + ".join(f"{lit(c)} * pow(t, {4 - i})" for i, c in enumerate(BODY.cp_terms))


@query(f"SELECT key, line, {q(_CP)} AS cp, {q(f'kc * (1 + {lit(2.7 / 350 ** 3)} * t * t * t)', 9)} AS k FROM (SELECT key, line, t2 AS t, {lit(BODY.k_depth)} - {lit(BODY.k_depth - BODY.k_surface)} * exp(-((d - 80) / 100) / 0.07) AS kc FROM samples)")
def heat_capacity_profile(spark, sf_dir):
    kc = physics.depth_profile((F.col("d") - 80) / 100, BODY.k_surface, BODY.k_depth, 0.07)
    return samples_view(spark, sf_dir).select("key", "line", r(physics.heat_capacity(F.col("t2"))).alias("cp"), r(physics.conductivity(F.col("t2"), kc), 9).alias("k"))


@query(f"""SELECT key, line, {q(f'(1 - (0.12 + 0.06 * pow(i / pi() * 4, 3) + 0.25 * pow(i / pi() * 2, 8))) / (1 - 0.12) * {lit((1 - 0.12) * 1361.0)} * pow(r, -2) * c')} AS flux FROM (
  SELECT *, acos(c) AS i FROM (SELECT key, line, 0.98::DOUBLE + d / 5000 AS r, greatest(0, sin(radians(lat)) * sin(0.02) + cos(radians(lat)) * cos(0.02) * cos(2 * pi() * ltst)) AS c FROM samples))""")
def surface_flux(spark, sf_dir):
    f = physics.surface_flux(F.col("ltst") * BODY.day, F.radians("lat"), F.lit(0.02), F.lit(0.98) + F.col("d") / 5000, F.lit(0.12))
    return samples_view(spark, sf_dir).select("key", "line", r(f).alias("flux"))


@query(f"SELECT key, line, {q(f'pow((1 - (t1 - 180) / 300) * 1361 / {lit(STEFAN_BOLTZMANN)} * cos(radians(lat)), 0.25)')} AS noon FROM samples")
def radiative_temperature(spark, sf_dir):
    t = physics.radiative_temperature((F.col("t1") - 180) / 300, F.radians("lat"))
    return samples_view(spark, sf_dir).select("key", "line", r(t).alias("noon"))


LAYERS_SQL = f"""l AS (SELECT key, line AS layer, t2 AS temp, (d - 79) / 2000 AS dz, 1100 + l2 * 90.0::DOUBLE AS rho FROM (SELECT *, line AS l2 FROM samples) WHERE key IN (SELECT key FROM samples GROUP BY key HAVING count(*) >= 2 AND count(*) = count(DISTINCT line))),
  a0 AS (SELECT *, pow(1.92, rho / 1000) AS eps, pow(10, 0.312 * rho / 1000 - 2.5) AS tand FROM l),
  a1 AS (SELECT *, {lit(2 * math.pi * 7.8e9 / LIGHT_SPEED)} * sqrt(eps) * tand AS coeff FROM a0),
  a2 AS (SELECT *, exp(-dz * coeff) AS att, coalesce(pow((lead(sqrt(eps)) OVER w - sqrt(eps)) / (lead(sqrt(eps)) OVER w + sqrt(eps)), 2), 0) AS ref,
    pow((first(sqrt(eps)) OVER w - 1) / (first(sqrt(eps)) OVER w + 1), 2) AS surface FROM a1 WINDOW w AS (PARTITION BY key ORDER BY layer)),
  a3 AS (SELECT *, 1 - coalesce(lag(ref) OVER w, surface) * ref * att * att AS mult FROM a2 WINDOW w AS (PARTITION BY key ORDER BY layer)),
  a4 AS (SELECT *, ln(1 - ref) + ln(att) - ln(mult) AS lg FROM a3),
  a5 AS (SELECT *, coalesce(sum(lg) OVER (PARTITION BY key ORDER BY layer ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above, sum(lg) OVER (PARTITION BY key ORDER BY layer ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS thru FROM a4),
  a6 AS (SELECT *, (1 - att) * (1 + ref * att) * (1 - surface) * exp(above) AS weight, (1 - surface) * exp(thru) AS rest FROM a5)"""


def _layers(spark, sf_dir) -> DataFrame:
    s = samples_view(spark, sf_dir)
    whole = s.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("line").alias("u")).where("n >= 2 and n = u").select("key")
    out = s.join(whole, "key", "left_semi")
    out = out.select("key", F.col("line").alias("layer"), F.col("t2").alias("temp"), ((F.col("d") - 79) / 2000).alias("dz"), (F.col("line") * 90.0 + 1100).alias("rho"))
    return brightness.cross_settings(out, [7.8], [2.5])


@query(f"SELECT key, layer, {q('weight', 9)} AS weight, {q('rest', 9)} AS rest FROM a6", LAYERS_SQL)
def layer_prefix_product(spark, sf_dir):
    out = brightness.layer_weights(_layers(spark, sf_dir), ["key"], path="dz")
    return out.select("key", "layer", r("weight", 9).alias("weight"), r("rest", 9).alias("rest"))


@query(f"SELECT key, {q('h / ln(1 / rad + 1) + below', 5)} AS tb FROM (SELECT key, sum(weight / (exp({lit(PLANCK / BOLTZMANN * 1e9 * 7.8)} / temp) - 1)) AS rad, max({lit(PLANCK / BOLTZMANN * 1e9 * 7.8)}) AS h, arg_max((temp + (temp - t1) * 2 / (dz + d1) / coeff) * rest, layer) AS below FROM (SELECT *, lag(temp) OVER w AS t1, lag(dz) OVER w AS d1 FROM a6 WINDOW w AS (PARTITION BY key ORDER BY layer)) GROUP BY key)", LAYERS_SQL)
def brightness_temperature(spark, sf_dir):
    out = brightness.brightness_temperature(_layers(spark, sf_dir), ["key", "freq", "c"], path="dz")
    return out.select("key", r("tb", 5).alias("tb"))


@query(reads=False)
def heat1d_run(spark, sf_dir):
    points = thermal.sweep(spark, [0.0, 60.0], [0.12], [0.07])
    out = thermal.profile_table(thermal.simulate(points), 24)
    return out.select("run", "lat", "layer", r("z").alias("z"), "ltst", r("temp", 3).alias("temp"))


# --- further scalar functions

@query(f"SELECT key, line, {q('pow(10, (t1 - 200) / 10)', 9)} AS power, {q('10 * log10(t1)', 9)} AS db FROM samples")
def power_decibel(spark, sf_dir):
    s = samples_view(spark, sf_dir)
    return s.select("key", "line", r(units.db_to_power(F.col("t1") - 200), 9).alias("power"), r(units.power_to_db(F.col("t1")), 9).alias("db"))


@query("SELECT CAST(h AS INTEGER) AS hour, (h + 12) % 24 + 0.0::DOUBLE AS rotated FROM range(24) t(h)", samples=False, reads=False)
def rotate_hours(spark, sf_dir):
    return spark.range(24).select(F.col("id").cast("int").alias("hour"), units.rotate_hours(F.col("id").cast("double")).alias("rotated"))


@query(f"SELECT key, line, {q(f'{lit(BODY.distance_au * (1 - BODY.eccentricity ** 2))} / (1 + {lit(BODY.eccentricity)} * cos(2 * pi() * ltst))', 9)} AS distance, {q(f'asin({lit(math.sin(BODY.obliquity))} * sin(2 * pi() * ltst))', 9)} AS declination FROM samples")
def orbit_parameters(spark, sf_dir):
    nu = F.col("ltst") * (2 * math.pi)
    return samples_view(spark, sf_dir).select("key", "line", r(physics.orbit_distance(nu), 9).alias("distance"), r(physics.orbit_declination(nu), 9).alias("declination"))


@query(f"SELECT lat_ix, lon_ix, {q('(value - lo) / (hi - lo)')} AS shade FROM c, (SELECT min(value) AS lo, max(value) AS hi FROM c)", MAP_SQL)
def plain_norm(spark, sf_dir):
    return residual.plain_norm(cells(spark, sf_dir)).select("lat_ix", "lon_ix", r("shade").alias("shade"))


@query(f"SELECT key, line, k, {q('x * r * d * 1737.4')} AS east, {q('y * r * d * 1737.4')} AS north FROM samples, kernel", kernel_sql(4.0, 7))
def flat_offsets(spark, sf_dir):
    s = samples_view(spark, sf_dir).crossJoin(F.broadcast(footprint.kernel(spark, 2, 4.0)))
    x, y = footprint.flat_offset(F.col("d"), F.col("x_over_rad"), F.col("y_over_rad"), F.col("scaled_rad"))
    return s.select("key", "line", "k", r2(x).alias("east"), r2(y).alias("north"))


@query(f"SELECT orbit, x, {q('v0 + CASE WHEN x1 > x0 THEN (x - x0) / (x1 - x0) ELSE 0 END * (coalesce(v1, v0) - v0)')} AS v FROM (SELECT orbit, x0, v0, x1, v1, x FROM b, range(0, 91, 10) g(x) WHERE x >= x0 AND (x < x1 OR (x1 IS NULL AND x = x0)))",
       "a AS (SELECT orbit, floor(lat) + 90 AS x, avg(t1) AS v FROM samples WHERE lat < 0 GROUP BY ALL UNION ALL SELECT DISTINCT orbit, 0, 200 FROM samples WHERE orbit NOT IN (SELECT orbit FROM samples WHERE lat < -89)), b AS (SELECT orbit, x AS x0, v AS v0, lead(x) OVER w AS x1, lead(v) OVER w AS v1 FROM a WINDOW w AS (PARTITION BY orbit ORDER BY x))")
def regular_series(spark, sf_dir):
    s = samples_view(spark, sf_dir)
    a = s.where("lat < 0").groupBy("orbit", (F.floor("lat") + 90).cast("double").alias("x")).agg(F.avg("t1").alias("v"))
    start = filters.not_member(s.select("orbit").distinct(), s.where("lat < -89").select("orbit"), "orbit").select("orbit", F.lit(0.0).alias("x"), F.lit(200.0).alias("v"))
    out = interpolate.regular_series(a.union(start), "x", "v", 10.0, ["orbit"])
    return out.select("orbit", F.col("x").cast("long").alias("x"), r("v").alias("v"))


# --- checks, times and further forms

@query("SELECT orbit, min(utc) AS start, max(utc) AS stop FROM samples GROUP BY orbit")
def time_span(spark, sf_dir):
    return tables.time_span(samples_view(spark, sf_dir))


@query("SELECT event_id, date_trunc('millisecond', ts) AS utc FROM events", samples=False)
def parse_utc(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    return e.select("event_id", times.parse_utc(text).alias("utc"))


@query(f"SELECT event_id, (u + leap + {lit(times.TT_MINUS_TAI)}) / 86400.0::DOUBLE + 2440587.5::DOUBLE AS tdb FROM e", f"e AS (SELECT event_id, epoch_us(ts) / 1000000.0::DOUBLE AS u, {_leap_sql()} AS leap FROM events)", samples=False)
def tdb_julian_date(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", times.tdb_julian_date(times.unix_seconds(F.col("ts"))).alias("tdb"))


@query("SELECT event_id, (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 86400.0::DOUBLE AS day FROM events", samples=False)
def hms_fraction(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", times.hms_fraction(F.date_format("ts", "HH:mm:ss")).alias("day"))


@query("SELECT orbiter, CAST(orbit AS INTEGER) AS orbit, CAST(lat AS FLOAT) AS lat, CAST(t1 AS FLOAT) AS t1, CAST(NULL AS DOUBLE) AS bx FROM samples")
def conform_schema(spark, sf_dir):
    out = conform(samples_view(spark, sf_dir))
    return out.select("orbiter", F.col("orbit").cast("int").alias("orbit"), F.col("lat").cast("float").alias("lat"), F.col("t1").cast("float").alias("t1"), F.col("bx").cast("double").alias("bx"))


@query("SELECT key, line, CASE WHEN t2 > 200 AND t2 < 260 AND t2 <= 250 THEN t2 END AS t2 FROM samples")
def model_mask(spark, sf_dir):
    return samples_view(spark, sf_dir).select("key", "line", filters.mask_outside(F.col("t2"), 200.0, 260.0, 250.0).alias("t2"))


HOLES_SQL = MAP_SQL + ", x AS (SELECT lat_ix, lon_ix, CASE WHEN lat_ix BETWEEN 4 AND 30 AND lon_ix BETWEEN 10 AND 60 THEN value END AS value FROM c)"


def _holes(spark, sf_dir) -> DataFrame:
    inside = F.col("lat_ix").between(4, 30) & F.col("lon_ix").between(10, 60)
    return cells(spark, sf_dir).select("lat_ix", "lon_ix", F.when(inside, F.col("value")).alias("value"))


@query("SELECT min(lat_ix) AS lat_lo, max(lat_ix) AS lat_hi, min(lon_ix) AS lon_lo, max(lon_ix) AS lon_hi FROM x WHERE value IS NOT NULL", HOLES_SQL)
def finite_box(spark, sf_dir):
    return filters.valid_bounds(_holes(spark, sf_dir))


@query("SELECT lat_ix, lon_ix, value FROM x, (SELECT min(lat_ix) AS a, max(lat_ix) AS b, min(lon_ix) AS e, max(lon_ix) AS f FROM x WHERE value IS NOT NULL) WHERE lat_ix >= a AND lat_ix < b AND lon_ix >= e AND lon_ix < f", HOLES_SQL)
def cut_valid(spark, sf_dir):
    return filters.cut_valid(_holes(spark, sf_dir))


@query("SELECT orbit, concat_ws(',', CASE WHEN count(DISTINCT mflag) > 1 THEN 'mflag' END, CASE WHEN count(DISTINCT orbiter) > 1 THEN 'orbiter' END) AS differ FROM samples GROUP BY orbit HAVING count(DISTINCT mflag) > 1 OR count(DISTINCT orbiter) > 1")
def axes_agree(spark, sf_dir):
    out = filters.axes_agree(samples_view(spark, sf_dir), ["orbit"], ["mflag", "orbiter"])
    return out.select("orbit", F.concat_ws(",", "differ").alias("differ"))


@query(f"""SELECT key, line, {q(f'sqrt({lit(BODY.k_surface)} / ({lit(BODY.rho_surface)} * ({_CP})) * {lit(BODY.day / math.pi)})', 9)} AS skin_depth,
  {q(f'pow({lit((1 - BODY.albedo) * BODY.solar_constant / (4 * BODY.emissivity * STEFAN_BOLTZMANN))} * cos(radians(lat)), 0.25)')} AS mean_temperature FROM (SELECT key, line, lat, t2 AS t FROM samples)""")
def skin_depth(spark, sf_dir):
    s = samples_view(spark, sf_dir)
    return s.select("key", "line", r(physics.skin_depth(F.col("t2")), 9).alias("skin_depth"), r(physics.mean_equilibrium_temperature(F.col("lat"))).alias("mean_temperature"))


@query(f"SELECT {q('max(abs(sqrt(pow(cos(p) * cos(l) * d, 2) + pow(cos(p) * sin(l) * d, 2) + pow(sin(p) * d, 2)) - d))')} AS max_error FROM (SELECT radians(lat) AS p, radians(lon) AS l, d FROM samples)")
def height_error(spark, sf_dir):
    out = ephemeris.with_vectors(samples_view(spark, sf_dir).drop("ltst").withColumn("et", F.lit(0.0)))
    return ephemeris.height_error(out).select(r("max_error").alias("max_error"))


_BODIES_SQL = ", ".join("(" + ", ".join([f"'{k}'", *("NULL" if x is None else lit(x) for x in v)]) + ")" for k, v in BODIES.items())


@query(f"SELECT name, semi_major_m / {lit(AU)} AS distance_au, {q(f'pow((1 - albedo) * solar_constant / (4 * emissivity * {lit(STEFAN_BOLTZMANN)}), 0.25)')} AS equator FROM (VALUES {_BODIES_SQL}) b(name, {', '.join(BODY_COLUMNS)})", samples=False, reads=False)
def body_catalogue(spark, sf_dir):
    equator = F.pow((1 - F.col("albedo")) * F.col("solar_constant") / (4 * F.col("emissivity") * STEFAN_BOLTZMANN), F.lit(0.25))
    return tables.bodies(spark).select("name", (F.col("semi_major_m") / F.lit(AU)).alias("distance_au"), r(equator).alias("equator"))


from gridlark.plans import catalogue_tables  # noqa: E402,F401  registers further queries with the names above
