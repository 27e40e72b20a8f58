"""Tabulated ephemerides against a plain search and exact polynomials."""

from __future__ import annotations

import bisect
import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlark.operators import states
from gridlark.plans import catalogue, catalogue_tables
from gridlark.schema import LIGHT_SPEED

STATE = "et double, x double, y double, z double, vx double, vy double, vz double"


def frame(spark, rows, keys=""):
    return spark.createDataFrame(rows, f"{keys}{STATE}")


@pytest.mark.parametrize("most_gap", [None, 40.0])
def test_every_sample_meets_the_one_piece(spark, most_gap):
    """Bursts, long gaps, several targets, one without states, times at the borders, null and NaN times."""
    rng = random.Random(1)
    table = {t: sorted({round(x, 3) for x in [*(rng.uniform(0, 1000) for _ in range(60)), *(500 + rng.random() for _ in range(200)), 5000.0, -3000.0 * (t == "b")]}) for t in "ab"}
    rows = [(t, et, et, 0.0, 0.0, 1.0, 0.0, 0.0) for t, ts in table.items() for et in ts]
    rows += [("a", None, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0), ("a", 1.5, None, 0.0, 0.0, 0.0, 0.0, 0.0), (None, 1.5, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0)]
    times = [*(rng.uniform(-4000, 6000) for _ in range(100)), *(rng.uniform(499, 502) for _ in range(200)), *table["a"][:50], table["a"][-1], None, float("nan")]
    asked = [(i, t, et) for i, (t, et) in enumerate((t, et) for t in ("a", "b", "none", None) for et in times)]
    samples = spark.createDataFrame(asked, "id int, target string, et double").repartition(3)
    pieces = states.state_pieces(frame(spark, rows, "target string, "), ["target"], most_gap=most_gap, chunk=50.0)
    got = states.covered(samples, pieces, ["target"]).collect()
    assert sorted(r.id for r in got) == list(range(len(asked)))
    for r in got:
        ts = table.get(r.target, [])
        i = bisect.bisect_right(ts, r.et) - 1 if r.et is not None and r.et == r.et else -1
        want = (ts[i], ts[i + 1]) if 0 <= i < len(ts) - 1 and (most_gap is None or ts[i + 1] - ts[i] <= most_gap) else None
        assert (None if r.p is None else (r.lo, r.hi)) == want, (r.target, r.et)


def test_join_is_an_equality_of_keys_and_few_pieces_meet(spark):
    rows = [(500 + i * 1e-3, float(i), 0.0, 0.0, 0.0, 0.0, 0.0) for i in range(2000)] + [(float(i * 100), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0) for i in range(20)]
    pieces = states.state_pieces(frame(spark, [(t, *r) for r in rows for t in "ab"], "target string, "), ["target"])
    samples = spark.range(500).select((F.lit(501.0) + F.col("id") * 1e-3).alias("et"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("target"))
    out = states.covered(samples, pieces, ["target"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "HashJoin" in plan
    assert out.count() == 500


def test_hermite_is_exact_for_cubics(spark):
    f = lambda c, t: c[0] + c[1] * t + c[2] * t * t + c[3] * t**3
    d = lambda c, t: c[1] + 2 * c[2] * t + 3 * c[3] * t * t
    rng = np.random.default_rng(3)
    c = rng.normal(size=(3, 4)) * [10, 1, 0.1, 0.01]
    at = sorted(rng.uniform(0, 30, 12))
    table = frame(spark, [(float(t), *(float(f(x, t)) for x in c), *(float(d(x, t)) for x in c)) for t in at])
    asked = rng.uniform(at[0], at[-1], 60)
    got = states.interpolated(spark.createDataFrame([(float(t),) for t in asked], "et double"), table).collect()
    assert len(got) == 60
    for r in got:
        assert [r.mx, r.my, r.mz] == pytest.approx([f(x, r.et) for x in c], abs=1e-8)
        assert [r.mvx, r.mvy, r.mvz] == pytest.approx([d(x, r.et) for x in c], abs=1e-8)


def test_of_states_at_one_time_one_counts_and_empty_tables_leave_samples(spark):
    table = frame(spark, [(0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0), (0.0, 3.0, 0.0, 0.0, 0.0, 0.0, 0.0), (10.0, 3.0, 0.0, 0.0, 0.0, 0.0, 0.0)])
    samples = spark.createDataFrame([(5.0,), (10.0,), (-1.0,)], "et double")
    assert sorted(((r.et, r.mx) for r in states.interpolated(samples, table).collect()), key=str) == sorted([(5.0, 3.0), (10.0, None), (-1.0, None)], key=str)
    assert [r.mx for r in states.interpolated(samples, table.limit(0)).collect()] == [None] * 3
    assert states.interpolated(samples.limit(0), table).count() == 0


def test_every_state_is_a_piece_also_at_one_time(spark):
    """Copies of a time follow each other within a chunk and beyond it; the order that SQL leaves open is that of the states."""
    rows = [(t, float(x), 0.0, 0.0, 0.0, 0.0, 0.0) for t, x in [(0.0, 5), (0.0, 1), (0.0, 1), (10.0, 7), (10.0, 2), (95.0, 4), (95.0, 3)]]
    got = states.state_pieces(frame(spark, [(k, *r) for k in "ab" for r in rows], "target string, ").repartition(3), ["target"], chunk=50.0).select("target", "lo", "hi", "p.x", "q.x").collect()
    want = [(0.0, 0.0, 1, 1), (0.0, 0.0, 1, 5), (0.0, 10.0, 5, 2), (10.0, 10.0, 2, 7), (10.0, 95.0, 7, 3), (95.0, 95.0, 3, 4)]
    assert sorted(map(tuple, got)) == [(k, *w) for k in "ab" for w in want]
    asked = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (95.0,)], "et double")
    held = states.covered(asked, states.state_pieces(frame(spark, rows), chunk=50.0)).select("et", "p.x", "q.x").collect()
    assert sorted(map(tuple, held), key=lambda r: r[0]) == [(0.0, 5, 2), (5.0, 5, 2), (10.0, 7, 3), (95.0, None, None)]


def test_pieces_of_copied_events_are_those_of_the_sql(spark, tmp_path):
    """A table whose rows all come three times under other ids."""
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.crossJoin(spark.range(3).withColumnRenamed("id", "_i")).withColumn("event_id", F.col("event_id") + F.col("_i") * 1_000_000).drop("_i").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    want = con.sql(f"SELECT target, lo, hi, x0, x1, z0, z1 FROM ({catalogue.SQL['ephemeris_pieces']})").fetchall()
    got = catalogue.QUERIES["ephemeris_pieces"](spark, str(tmp_path)).select("target", "lo", "hi", "x0", "x1", "z0", "z1").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_solar_vectors_of_tied_times_follow_one_order(spark, tmp_path):
    """Events at one time under other ids and users: the SQL's vectors once its order is told apart by the states."""
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").crossJoin(spark.range(3).withColumnRenamed("id", "_i"))
    e.withColumns({"event_id": F.col("event_id") + F.col("_i") * 1001, "user_id": F.col("user_id") + F.col("_i") * 15, "value": F.col("value") + F.col("_i")}).drop("_i").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    for t in ("events", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    sql = catalogue.SQL["solar_vectors"]
    told = sql.replace("(ORDER BY lo)", "(ORDER BY lo, x, y, z, vx, vy, vz)").replace("(SELECT * FROM pieces)", "(SELECT * FROM pieces WHERE hi IS NULL OR hi > lo)")
    assert told.count("lo, x, y") == told.count("hi > lo") == 1
    want, got = (x.sort_values(["key", "line", "nx", "mx", "cx"]).reset_index(drop=True) for x in (con.sql(told).df(), catalogue.QUERIES["solar_vectors"](spark, str(tmp_path)).toPandas()))
    assert len(got) == len(want)
    for c in want.columns:
        assert np.allclose(got[c].astype(float), want[c].astype(float), rtol=0, atol=0.011, equal_nan=True), c


@pytest.mark.parametrize("name", ["solar_vectors", "asof_states", "ephemeris_pieces"])
def test_tied_events_follow_their_number_as_in_the_sql(spark, tmp_path, name):
    """Events at one time, whose order by number is not that of their states: of so few the unchanged SQL on one thread keeps the file's, by number. Every digit counts."""
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").crossJoin(spark.range(3).withColumnRenamed("id", "_i"))
    e = e.withColumns({"event_id": F.col("event_id") + F.col("_i") * 1001, "user_id": F.col("user_id") + F.col("_i") * 15, "value": F.col("value") - F.col("_i")})
    e.drop("_i").coalesce(1).sortWithinPartitions("event_id").write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.sql("SET threads = 1")
    for t in ("events", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want, got = con.sql(catalogue.SQL[name]).fetchall(), [tuple(x) for x in catalogue.QUERIES[name](spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and sorted(got, key=repr) == sorted(want, key=repr)


def test_asof_states_of_many_tied_events_keep_every_sample(spark, tmp_path):
    """Sixty events at one time: a row a sample, the SQL's once its order is told apart by number and no sample meets a piece of no length. Every digit counts."""
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").crossJoin(spark.range(60).withColumnRenamed("id", "_i"))
    e = e.withColumns({"event_id": F.col("event_id") + F.col("_i") * 1001, "user_id": F.col("user_id") + F.col("_i") * 15})
    e.drop("_i").coalesce(1).sortWithinPartitions(F.hash("event_id")).write.parquet(f"{tmp_path}/events.parquet")
    samples = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    samples.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    for t in ("events", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    told = catalogue.SQL["asof_states"]
    for old, new in ((" AS vz FROM events", " AS vz, event_id FROM events"), ("ORDER BY lo)", "ORDER BY lo, event_id)"), ("ASOF LEFT JOIN pieces", "ASOF LEFT JOIN (SELECT * FROM pieces WHERE hi > lo)"), ("ASOF JOIN pieces", "ASOF JOIN (SELECT * FROM pieces WHERE hi > lo)")):
        assert told.count(old) == 1
        told = told.replace(old, new)
    want, got = con.sql(told).fetchall(), [tuple(x) for x in catalogue.QUERIES["asof_states"](spark, str(tmp_path)).collect()]
    assert len(got) == len(want) == samples.count() and sorted(got, key=repr) == sorted(want, key=repr)


def test_ties_come_before_components_and_null_first(spark):
    rows = [(n, 0.0 if n != 9 else 10.0, x, 0.0, 0.0, 0.0, 0.0, 0.0) for n, x in [(2, 1.0), (1, 5.0), (1, 4.0), (None, 3.0), (9, 7.0)]]
    table = frame(spark, rows, "n int, ").repartition(3)
    got = states.state_pieces(table, ties=["n"]).select("lo", "hi", "p.x", "q.x").collect()
    assert sorted(map(tuple, got)) == [(0.0, 0.0, 3.0, 4.0), (0.0, 0.0, 4.0, 5.0), (0.0, 0.0, 5.0, 1.0), (0.0, 10.0, 1.0, 7.0)]
    assert states.interpolated(spark.createDataFrame([(0.0,)], "et double"), table, ties=["n"]).first().mx == 1.0


def test_hermite_and_light_time_are_the_twins_to_the_last_bit(spark):
    """Factors are taken in one order on both sides, so that no rounded value differs."""
    rng = np.random.default_rng(8)
    rows = [tuple(map(float, (i, *r))) for i, r in enumerate(np.column_stack([rng.random(20_000), rng.uniform(0.1, 3600, 20_000), rng.normal(size=(20_000, 4)) * 1e6]))]
    names = ("i", "s", "h", "x", "vx", "x1", "vx1")
    con = duckdb.connect()
    con.sql(f"CREATE TABLE t ({', '.join(f'{c} DOUBLE' for c in names)})")
    con.append("t", pd.DataFrame(rows, columns=names))
    far = "sqrt(x * x + x1 * x1 + h * h)"
    want = con.sql(f"SELECT i, {catalogue_tables._hermite_sql('x')}, {catalogue_tables._slope_sql('x')}, x - vx * {far} / {LIGHT_SPEED / 1000.0!r}::DOUBLE FROM t ORDER BY i").fetchall()
    c = F.col
    late = states.light_time([c("x"), c("x1"), c("h")], [c("vx"), c("vx1"), c("s")], rounds=1)[0]
    got = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).select("i", *states.hermite(c("s"), c("h"), c("x"), c("vx"), c("x1"), c("vx1")), late).collect()
    assert [tuple(r) for r in got] == want


def test_chebyshev(spark):
    rng = np.random.default_rng(5)
    rows = [(float(k * 10), float(k * 10 + 10), *[[float(x) for x in rng.normal(size=n)] for n in (6, 1, 2)]) for k in range(5) if k != 2]
    records = spark.createDataFrame(rows, "lo double, hi double, x array<double>, y array<double>, z array<double>")
    times = [float(x) for x in rng.uniform(0, 50, 80)] + [0.0, 10.0]
    got = states.chebyshev_states(spark.createDataFrame([(t,) for t in times], "et double"), records).collect()
    assert len(got) == 82
    for r in got:
        own = next((x for x in rows if x[0] <= r.et < x[1]), None)
        if own is None:
            assert r.mx is None
        else:
            u = (2 * r.et - own[0] - own[1]) / 10
            assert [r.mx, r.my, r.mz] == pytest.approx([np.polynomial.chebyshev.chebval(u, c) for c in own[2:]], abs=1e-9)


def test_rotation_is_one_and_light_time_converges(spark):
    one = spark.range(1)
    m = states.rotation(F.lit(0.7), F.lit(4.2), F.lit(1.1))
    got = np.array(one.select(*[x.alias(f"c{i}{j}") for i, row in enumerate(m) for j, x in enumerate(row)]).first()).reshape(3, 3)
    assert np.allclose(got @ got.T, np.eye(3)) and np.linalg.det(got) == pytest.approx(1)
    assert got[:, 2] == pytest.approx([math.cos(1.1) * math.cos(4.2), math.cos(1.1) * math.sin(4.2), math.sin(1.1)])
    v = [F.lit(x) for x in (1.0, -2.0, 3.0)]
    there = states.turned(m, states.turned(m, v), back=True)
    assert list(one.select(*[x.alias(n) for x, n in zip(there, "abc")]).first()) == pytest.approx([1, -2, 3])
    p, s = (1.5e8, 1e6, -2e6), (20.0, -30.0, 5.0)
    seen = np.array(one.select(*[x.alias(n) for x, n in zip(states.light_time([F.lit(x) for x in p], [F.lit(x) for x in s]), "abc")]).first())
    late = np.linalg.norm(seen) / 299792.458
    assert seen == pytest.approx(np.array(p) - np.array(s) * late, abs=1e-3)


def test_sun_vectors_of_a_point_under_the_sun(spark):
    sun = frame(spark, [(float(t), 1.496e8, 0.0, 0.0, 0.0, 0.0, 0.0) for t in (0, 1000)])
    samples = spark.createDataFrame([(0.0, 0.0, 100.0, 500.0), (0.0, 90.0, 100.0, 500.0), (0.0, 0.0, 100.0, 5000.0)], "lat double, lon double, d double, et double")
    still = states.rotation(F.lit(-math.pi / 2), F.lit(0.0), F.lit(math.pi / 2))
    got = {(r.lon, r.et): r for r in states.sun_vectors(samples, sun, still, 1737.4).collect()}
    r = got[0.0, 500.0]
    assert (r.mx, r.bx, r.cx, r.nx, r.ltst) == pytest.approx((1.496e8, 1.496e8 - 1737.4, 1.496e8 - 1837.4, 1737.4, 0.5))
    assert got[90.0, 500.0].ltst == pytest.approx(0.75) and got[0.0, 5000.0].mx is None and got[0.0, 5000.0].nx == pytest.approx(1737.4)
