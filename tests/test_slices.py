"""Sliced tables read few files; nested labels; tile functions; smoothing by tiles; distributed fits; the lock of a writer."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlark.operators import flags, grids, tile_functions
from gridlark.plans import catalogue
from gridlark.sources import labels, sinks, slices
from gridlark.sources.tables import samples_view

SF = "/root/testdata/sf0.01"


def read_files(df):
    return df.select(F.col("_metadata.file_name")).distinct().count()


def test_a_slice_reads_few_files(spark, tmp_path):
    s = samples_view(spark, SF).select("key", "line", "lat", "lon", "ltst")
    slices.write_sliced(s, f"{tmp_path}/t", files=64)
    files = slices.read_manifest(spark, f"{tmp_path}/t")
    assert files.agg(F.sum("rows")).first()[0] == s.count() and 50 <= files.count() <= 64
    box = {"lat": [(-20.0, 10.0)], "lon": [(30.0, 75.0)], "ltst": [(0.9, 1.0), (0.0, 0.1)]}
    got = slices.read_slice(spark, f"{tmp_path}/t", box)
    want = s.where("lat >= -20 and lat < 10 and lon >= 30 and lon < 75 and (ltst >= 0.9 or ltst < 0.1)")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 50
    assert len(got.inputFiles()) <= 0.25 * files.count()
    assert slices.read_slice(spark, f"{tmp_path}/t", {"lat": [(200.0, 300.0)]}).count() == 0
    assert slices.read_slice(spark, f"{tmp_path}/t", {}).count() == s.count()


def test_slices_keep_nulls_and_edges(spark, tmp_path):
    rows = [(None, 0.0, 0.5, 1), (float("nan"), 0.0, 0.5, 2), (90.0, 180.0, 1.0, 3), (-90.0, -180.0, 0.0, 4), (500.0, -900.0, 7.0, 5)]
    df = spark.createDataFrame(rows, "lat double, lon double, ltst double, id int")
    slices.write_sliced(df, f"{tmp_path}/t", files=3)
    ids = lambda b: sorted(r.id for r in slices.read_slice(spark, f"{tmp_path}/t", b).collect())
    assert ids({}) == [1, 2, 3, 4, 5] and ids({"lat": [(90.0, 91.0)]}) == [3] and ids({"lat": [(-90.0, 1000.0)]}) == [3, 4, 5] and ids({"ltst": [(0.4, 0.6)]}) == [1, 2]
    slices.write_sliced(df.limit(0), f"{tmp_path}/e")
    assert slices.read_slice(spark, f"{tmp_path}/e", {"lat": [(0.0, 1.0)]}).count() == 0


def test_z_keys_interleave_bits(spark):
    df = spark.createDataFrame([(a / 65536, b / 65536) for a, b in ((0, 0), (1, 0), (0, 1), (2, 0), (65535, 65535), (40000, 12345))], "a double, b double")
    got = [r[0] for r in df.select(slices.z_key({"a": (0.0, 1.0), "b": (0.0, 1.0)})).collect()]
    spread = lambda x: sum((x >> k & 1) << 2 * k for k in range(16))
    assert got == [spread(a) | spread(b) << 1 for a, b in ((0, 0), (1, 0), (0, 1), (2, 0), (65535, 65535), (40000, 12345))]


XML = """<?xml version="1.0"?>
<!-- a note --><Product xmlns="http://x"><Id><logical_id>urn:a</logical_id><version>1.10</version><flag>true</flag></Id>
<File size="{n}"><Table><records unit="row">{n}</records><bands><band>a</band><band>b</band></bands></Table><empty/></File></Product>"""


def test_nested_labels(spark, tmp_path):
    for n in (1, 22):
        (tmp_path / f"l{n}.xml").write_text(XML.format(n=n))
    got = labels.read_xml_labels(spark, str(tmp_path), "Product")
    own = {(r.file.rsplit("/", 1)[1], r.path): r.value for r in got.collect()}
    for n in (1, 22):
        f = f"l{n}.xml"
        assert own[f, "Product/Id/logical_id"] == "urn:a" and own[f, "Product/Id/version"] == "1.10" and own[f, "Product/Id/flag"] == "true" and own[f, "Product/File/Table/records"] == str(n) and own[f, "Product/File/_size"] == str(n)
        assert own[f, "Product/File/Table/records/_unit"] == "row" and [own[f, f"Product/File/Table/bands/band[{k}]"] for k in (0, 1)] == ["a", "b"]
    found = {(r.file.rsplit("/", 1)[1], r.asked): r.value for r in labels.find(got, ["LOGICAL_ID", "record", "absent", "band"]).collect()}
    assert found == {(f"l{n}.xml", a): v for n in (1, 22) for a, v in (("LOGICAL_ID", "urn:a"), ("record", str(n)), ("band", "a"))}
    rows = labels.as_records(got, {"id": "logical_id", "none": "absent"}).collect()
    assert [(r.id, r.none) for r in rows] == [("urn:a", None)] * 2


def test_tile_function_from_sql(spark):
    tile_functions.register(spark)
    df = spark.createDataFrame([(i % 3, f"k{i % 2}", None if i % 7 == 0 else float(i * i)) for i in range(60)] + [(9, "k0", None)], "a int, b string, v double")
    df.createOrReplaceTempView("tf_rows")
    got = {(r.a, r.b): r for r in spark.sql("SELECT * FROM tile_statistics(TABLE(tf_rows), 'a, b', 'v')").collect()}
    want = {(r.a, r.b): r for r in df.groupBy("a", "b").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k].n == w.n and [got[k][c] for c in ("mean", "std", "lo", "hi")] == pytest.approx([w[c] for c in ("mean", "std", "lo", "hi")])
    assert tile_functions.tile_statistics(df, ["b"], "v").count() == 2
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM tile_statistics(TABLE(tf_rows), 'a', 'nope')").collect()


# --- smoothing

def plain_smooth(rows, sigma, truncate=4.0):
    out = {}
    k = grids.gaussian_weights(sigma, truncate)
    for key, y, x, v in rows:
        for dy, a in k:
            for dx, b in k:
                at = key, y + dy, x + dx
                out.setdefault(at, None)
                if v is not None:
                    out[at] = (out[at] or 0.0) + v * a * b
    return out


@pytest.mark.parametrize("sigma, tile", [(1.0, 8), (1.0, 9), (2.0, 5), (0.5, 256), (0.1, 4)])
def test_smoothing_by_tiles(spark, sigma, tile):
    rng = np.random.default_rng(3)
    rows = [(k, int(y), int(x), None if rng.random() < 0.1 else float(rng.normal())) for k in ("p", "q") for y, x in {tuple(c) for c in rng.integers(-13, 30, (60, 2))}]
    df = spark.createDataFrame(rows, "k string, lat_ix int, lon_ix int, w double").repartition(3)
    got = {(r.k, r.lat_ix, r.lon_ix): r.w for r in grids.smooth(df, sigma, ["w"], keys=["k"], tile=tile).collect()}
    want = plain_smooth(rows, sigma)
    assert got.keys() == want.keys()
    for at, v in want.items():
        assert got[at] == (None if v is None else pytest.approx(v, abs=1e-12)), at


def test_a_cell_is_shuffled_about_once(spark):
    """At 32 cells a degree and sigma 3: rows that leave the tasks, by the explode's own counts."""
    df = spark.range(800 * 800).select(F.floor(F.col("id") / 800).cast("int").alias("lat_ix"), (F.col("id") % 800).cast("int").alias("lon_ix"), F.lit(1.0).alias("w"))
    reach = len(grids.gaussian_weights(3.0)) // 2
    inside = lambda c: F.pmod(F.col(c), F.lit(grids.TILE))
    copies = lambda c: F.lit(1) + (inside(c) < reach).cast("int") + (inside(c) >= grids.TILE - reach).cast("int")
    assert df.agg(F.sum(copies("lat_ix") * copies("lon_ix")) / F.count(F.lit(1))).first()[0] < 1.5
    out = grids.smooth(df, 3.0, ["w"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert out.where("lat_ix between 20 and 700 and lon_ix between 20 and 700 and abs(w - 1) > 1e-9").count() == 0


# --- fits

def test_fits_of_all_orbits_match_the_plain_fit(spark):
    rng = np.random.default_rng(6)
    rows = []
    for orbit in range(12):
        n = 1 if orbit == 11 else 150
        lat = rng.uniform(-84, 84, n)
        t = (200 + 9 * orbit) * np.cos(np.radians(lat)) ** (0.1 * orbit) + rng.normal(0, 3, n)
        rows += [(orbit, float(a), float(b), 0) for a, b in zip(lat, t)]
    rows += [(3, 10.0, None, 0), (3, 10.0, float("nan"), 0), (3, 89.0, 999.0, 0), (3, 10.0, 999.0, 4), (None, 1.0, 1.0, 0)]
    df = spark.createDataFrame(rows, "orbit int, lat double, t1 double, flag int").repartition(4)
    got = {r.orbit: (r.a, r.b) for r in flags.latitude_fits(df).collect()}
    assert sorted(got) == list(range(11))
    for orbit, (a, b) in got.items():
        own = [(x, t) for o, x, t, f in rows if o == orbit and f == 0 and t is not None and t == t and abs(x) < 85]
        want = flags.fit_cosine_power(np.array([x for x, _ in own]), np.array([t for _, t in own]))
        assert (a, b) == pytest.approx(want, rel=1e-6, abs=1e-7), orbit
    assert flags.latitude_fits(df.limit(0)).count() == 0


def test_one_orbit_of_a_million_rows(spark):
    """All tasks sum it; what meets in one place is six numbers a task."""
    lat = F.col("id") / 1e6 * 160 - 80
    df = spark.range(0, 1_000_000, 1, 8).select(F.lit(7).alias("orbit"), lat.alias("lat"), (F.lit(250.0) * F.pow(F.cos(F.radians(lat)), F.lit(0.3))).alias("t1"), F.lit(0).alias("flag"))
    (r,) = flags.latitude_fits(df).collect()
    assert (r.orbit, r.a, r.b) == (7, pytest.approx(250, abs=1e-6), pytest.approx(0.3, abs=1e-8))


def test_fits_use_no_python_worker(spark):
    seen = []
    real = flags.written

    def watched(df, what):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, what)

    flags.written = watched
    try:
        catalogue.QUERIES["flag_latmodel"](spark, "/root/testdata/sf0.001").count()
    finally:
        flags.written = real
    assert len(seen) >= 3 and not any(x in p for p in seen for x in ("Python", "Arrow", "Pandas"))


def test_mad_of_no_rows_and_of_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "orbit int, a double")
    assert flags.mad_outliers(df, ["a"], 1).count() == 0 and flags.mad_outliers(df.limit(0), ["a"], 1).count() == 0
    assert flags.lat_cut_orbits(spark.createDataFrame([], "orbit int, votes long")).count() == 0


# --- writers

def test_a_second_writer_is_kept_out(spark, tmp_path):
    path = f"{tmp_path}/t"
    (tmp_path / "t__lock").touch()
    with pytest.raises(sinks.Locked):
        sinks.write_once(spark.range(3), path)
    (tmp_path / "t__lock").unlink()
    assert sinks.write_once(spark.range(3), path) and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["t"]


def test_the_old_output_comes_back_if_the_new_one_cannot_be_moved(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    sinks.write_once(spark.range(3), path)
    real = sinks._replace

    class Bad:
        def __init__(self, fs):
            self.fs, self.moves = fs, 0

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            self.moves += 1
            return False if self.moves == 2 else self.fs.rename(a, b)

    with monkeypatch.context() as m:
        m.setattr(sinks, "_replace", lambda fs, *a: real(Bad(fs), *a))
        with pytest.raises(OSError, match="cannot move"):
            sinks.write_once(spark.range(5), path, overwrite=True)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["t"]


def test_scratch_goes_after_the_session_has_stopped(tmp_path):
    """In a process of its own: a query's scratch is gone when the process ends, though its session was stopped first."""
    import subprocess
    import sys

    code = f"""
import sys
sys.path.insert(0, {str(catalogue.__file__.rsplit('/', 3)[0])!r})
from pyspark.sql import SparkSession
from gridlark.operators import order
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
assert order.ordinals(s.range(9), ["id"]).count() == 9
import os
assert os.listdir("{tmp_path}/shared")
s.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, capture_output=True)
    assert not [p for p in (tmp_path / "shared").iterdir() if p.name.startswith("gridlark")]
    assert math.isfinite(1.0)
