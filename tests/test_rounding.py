"""Rounding of footprint points against the twins'."""

from __future__ import annotations

import math

import duckdb
import numpy as np

from gridlark.plans import catalogue


def test_binary_rounding_is_the_twins(spark):
    """Signs, halves, halves that are none in binary, small and large numbers, null, NaN and infinity."""
    rng = np.random.default_rng(4)
    values = [*(rng.normal(size=2000) * 10.0 ** rng.integers(-8, 9, 2000)), *(rng.integers(-(10**9), 10**9, 2000) / 2e6), 0.0, -0.0, 5e-7, -5e-7, 0.49999999999999994e-6, 1.0000005, 2.5e-6, -1.5e-6, 4e15, -1e300]
    rows = [(i, float(v)) for i, v in enumerate(values)]
    con = duckdb.connect()
    con.sql("CREATE TABLE t (i BIGINT, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    want = dict(con.sql(f"SELECT i, {catalogue.q('v')} FROM t").fetchall())
    df = spark.createDataFrame([*rows, (-1, None), (-2, math.nan), (-3, math.inf), (-4, -math.inf)], "i long, v double")
    got = {x.i: x.v for x in df.select("i", catalogue.r2(df.v).alias("v")).collect()}
    assert got[-1] is None and math.isnan(got[-2]) and (got[-3], got[-4]) == (math.inf, -math.inf)
    assert {i: v for i, v in got.items() if i >= 0} == want
    assert not any(math.copysign(1, v) < 0 for v in got.values() if v == 0)


def test_short_rounding_is_the_twins(spark):
    """Halves in binary, such that are halves in decimal only (r differs there), null, NaN and infinity, to two digits."""
    values = [*(n / 1000 for n in range(-20_005, 20_005, 10)), 0.0, -0.0, 0.125, -0.125, 1.005, -1.005, 1040925.385, 4e15, -1e300]
    rows = [(i, float(v)) for i, v in enumerate(values)]
    con = duckdb.connect()
    con.sql("CREATE TABLE t (i BIGINT, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    want = dict(con.sql(f"SELECT i, {catalogue.q('v', 2)} FROM t").fetchall())
    df = spark.createDataFrame([*rows, (-1, None), (-2, math.nan), (-3, math.inf), (-4, -math.inf)], "i long, v double")
    got = {x.i: (x.v, x.w) for x in df.select("i", catalogue.r1(df.v, 2).alias("v"), catalogue.r(df.v, 2).alias("w")).collect()}
    assert got[-1] == (None, None) and math.isnan(got[-2][0]) and (got[-3][0], got[-4][0]) == (math.inf, -math.inf)
    assert {i: v for i, (v, _) in got.items() if i >= 0} == want
    assert any(v != w for v, w in got.values() if v == v)
    assert not any(math.copysign(1, v) < 0 for v, _ in got.values() if v == 0)


def test_points_are_rounded_without_decimals(spark):
    """Each value of a point is rounded in binary; the decimal way is left for numbers without a fraction."""
    for name in ("flat_offsets", "footprint_project"):
        plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("rint(") >= 2, name
