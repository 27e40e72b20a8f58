"""Ordinals, even groups, dictionaries and exact quantiles against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlark.operators import grids, order, ranks


@pytest.mark.parametrize("n, parts", [(0, 1), (1, 3), (1000, 7)])
def test_ordinals(spark, n, parts):
    rng = random.Random(n)
    rows = [(rng.randrange(20), i, f"v{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "a int, b int, c string").repartition(parts)
    got = order.ordinals(df, ["a", F.col("b").desc()], "place", 5).collect()
    want = sorted(rows, key=lambda r: (r[0], -r[1]))
    assert [(r.a, r.b, r.c) for r in sorted(got, key=lambda r: r.place)] == want and sorted(r.place for r in got) == list(range(5, 5 + n))


def test_ordinals_use_all_tasks(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("x"))
    plan = order.ordinals(df, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # of the counts, a row a range
    assert order.ordinals(df, ["x"]).where("x <> ordinal").count() == 0


@pytest.mark.parametrize("n, groups", [(10, 3), (3, 7), (100, 7), (7, 7), (0, 2)])
def test_even_groups(spark, n, groups):
    df = spark.range(n).select((F.col("id") * 37 % 101).alias("x"))
    want = {r.x: r.g for r in df.select("x", F.ntile(groups).over(order.Window.orderBy("x")).alias("g")).collect()}
    assert {r.x: r.g for r in order.even_groups(df, ["x"], groups, "g").collect()} == want
    firsts = {}
    for x, g in sorted(want.items()):
        firsts.setdefault(g, x)
    assert sorted(r.x for r in grids.representatives(df, "x", groups).collect()) == sorted(firsts.values())


def test_dictionaries(spark, monkeypatch):
    rows = [(i, None if i % 10 == 0 else f"w{i * 7 % 23}") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, w string").repartition(4)
    codes = order.dictionary(df, "w")
    table = {r.value: r.code for r in codes.collect()}
    assert table == {w: k for k, w in enumerate(sorted({w for _, w in rows if w}))}
    assert table == {r.value: r.code for r in order.dictionary(df.repartition(9), "w").collect()}
    for bound in (100_000, 1):
        monkeypatch.setattr(order, "BROADCAST_VALUES", bound)
        got = order.encode(df, "w", codes)
        assert {r.id: r.w for r in got.collect()} == {i: table.get(w) for i, w in rows}
    assert sorted(map(tuple, order.decode(got, "w", codes).select("id", "w").collect())) == sorted(rows)
    assert order.encode(df, "w", codes.where("code > 3"), "code").where("code is null").count() > 30


def test_unified_dictionaries(spark):
    a, b = spark.createDataFrame([("x",), ("m",)], "w string"), spark.createDataFrame([("a",), ("x",), ("z",)], "w string")
    one, two = order.dictionary(a, "w"), order.dictionary(b, "w")
    whole, remap = order.unify(one, two)
    values = {r.value: r.code for r in whole.collect()}
    assert values == {"a": 0, "m": 1, "x": 2, "z": 3}
    for k, (df, codes) in enumerate(((a, one), (b, two))):
        own = order.encode(df, "w", codes, "c")
        assert {r.w: r.c for r in order.recode(own, "c", remap, k).collect()} == {w: c for w, c in values.items() if w in {r.w for r in df.collect()}}


SHARES = [0.0, 0.02, 0.25, 0.5, 0.7, 0.98, 1.0]


@pytest.mark.parametrize("case", ["small", "wide", "hot", "two", "one", "extreme"])
@pytest.mark.parametrize("sketch, in_brackets", [(16384, 50_000), (64, 50_000), (64, 3)])
def test_exact_quantiles(spark, monkeypatch, case, sketch, in_brackets):
    """Sketches that hold all, brackets that are counted, and brackets with too many values, on ties and extreme values."""
    monkeypatch.setattr(ranks, "SKETCH", sketch)
    monkeypatch.setattr(ranks, "ERROR", 0.1 if sketch == 64 else ranks.ERROR)
    monkeypatch.setattr(ranks, "SORTED", in_brackets)
    rng = np.random.default_rng(7)
    v = {"small": [3.0, 1.0, 2.0], "wide": rng.normal(size=3000) * 10.0 ** rng.integers(-5, 5, 3000), "hot": np.where(rng.random(3000) < 0.6, 5.0, rng.integers(0, 9, 3000)), "two": np.repeat([1.0, 2.0], 700), "one": np.full(900, -4.0), "extreme": np.r_[rng.normal(size=2000), 1e300, -1e300]}[case]
    rows = [(float(x),) for x in v] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "v double").repartition(5)
    got = ranks.exact_quantiles(df, {"v": F.col("v"), "w": F.col("v") * 2, "none": F.lit(None).cast("double")}, SHARES)
    assert got["v"] == pytest.approx(np.quantile(v, SHARES).tolist(), rel=1e-12)
    assert got["w"] == pytest.approx(np.quantile(np.array(v) * 2, SHARES).tolist(), rel=1e-12) and got["none"] == [None] * len(SHARES)
    assert ranks.exact_quantiles(df.limit(0), {"v": F.col("v")}, [0.5]) == {"v": [None]}


def test_two_scans_whatever_the_size(spark):
    """Reads of the table, counted by the jobs that run."""
    df = spark.range(0, 200_000, 1, 4).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    want = np.quantile(np.array([r.v for r in df.collect()]), [0.1, 0.9]).tolist()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("scans", "scans")
    try:
        assert ranks.exact_quantiles(df, {"v": F.col("v")}, [0.1, 0.9])["v"] == pytest.approx(want)
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("scans") for s in tracker.getJobInfo(j).stageIds]
        assert sum(s is not None and s.numTasks == 4 and s.numCompletedTasks == 4 for s in stages) <= 3
    finally:
        spark.sparkContext._jsc.clearJobGroup()
