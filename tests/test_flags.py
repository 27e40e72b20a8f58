from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlark.operators import flags

COLUMNS = "id int, orbiter string, orbit int, utc string, lat double, t1 double, t2 double, t3 double, t4 double, mflag string"


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def by_id(df):
    return {r["id"]: r["flag"] for r in df.collect()}


def test_row_flags_add_one_bit_and_ignore_missing_values(spark):
    rows = [
        (1, "a", 1, "t1", 0.5, 200.0, 200.0, 200.0, 200.0, "ok"),
        (2, "a", 1, "t2", 0.5, 33.0, 200.0, 200.0, 200.0, "ok"),
        (3, "a", 1, "t3", 0.5, 200.0, 280.0, 200.0, 200.0, "ok"),
        (4, "a", 1, "t4", 0.5, 20.0, 280.0, 200.0, 200.0, "bad"),
        (5, "a", 1, "t5", 0.5, None, 280.0, 200.0, 200.0, "ok"),
        (6, "a", 1, "t6", 0.5, 34.0, 109.0, 100.0, 100.0, "ok"),
    ]
    df = flags.mission({"a": "ok"})(frame(spark, rows))
    got = by_id(flags.channel_spread(75.0)(flags.low_temp(34.0)(df)))
    assert got == {1: 0, 2: 2, 3: 4, 4: 1, 5: 0, 6: 0}


def test_small_orbits_count_unflagged_rows_and_skip_fully_flagged_orbits(spark):
    rows = [(i, "a", 1 if i < 3 else 2, f"t{i}", 0.5, 200.0, 200.0, 200.0, 200.0, "ok") for i in range(8)]
    rows += [(100, "a", 3, "t100", 0.5, 200.0, 200.0, 200.0, 200.0, "bad")]
    df = flags.mission({"a": "ok"})(frame(spark, rows))
    got = by_id(flags.small_orbits(4)(df))
    assert [got[i] for i in range(8)] == [16, 16, 16, 0, 0, 0, 0, 0]
    assert got[100] == 1


def test_repeated_times_see_flagged_rows_too(spark):
    rows = [(1, "a", 1, "t", 0.5, 200.0, 200.0, 200.0, 200.0, "ok"), (2, "a", 1, "t", 0.5, 200.0, 200.0, 200.0, 200.0, "bad"), (3, "a", 1, "u", 0.5, 200.0, 200.0, 200.0, 200.0, "ok")]
    assert by_id(flags.time_twice()(flags.mission({"a": "ok"})(frame(spark, rows)))) == {1: 32, 2: 1, 3: 0}


def test_order_of_steps_matters(spark):
    rows = [(i, "a", 1, f"t{i}", 0.5, 10.0 if i < 3 else 200.0, 200.0, 200.0, 200.0, "ok") for i in range(5)]
    df = frame(spark, rows)
    first = flags.mission({"a": "ok"})
    assert sum(by_id(flags.apply_flags(df, first, [flags.small_orbits(4), flags.low_temp(34.0)])).values()) == 6
    assert sum(by_id(flags.apply_flags(df, first, [flags.low_temp(34.0), flags.small_orbits(4)])).values()) == 6 + 32


def test_integer_latitudes_have_no_tile(spark):
    rows = [(i, "a", 1, f"t{i}", 3.0, 200.0, 200.0, 200.0, 200.0, "ok") for i in range(20)]
    assert flags.latitude_votes(flags.mission({"a": "ok"})(frame(spark, rows))).count() == 0


def test_fit_finds_the_parameters():
    lat = np.linspace(-80, 80, 200)
    a, b = flags.fit_cosine_power(lat, 250 * np.cos(np.radians(lat)) ** 0.3)
    assert a == pytest.approx(250, abs=1e-6) and b == pytest.approx(0.3, abs=1e-8)
    assert np.isnan(flags.fit_cosine_power(lat[:1], lat[:1])[0])


def test_mad_outliers(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 100])], "orbit int, a double")
    assert [r["orbit"] for r in flags.mad_outliers(df, ["a"], 8).collect()] == [5]


def test_summary_counts_disjoint_bits(spark):
    df = spark.createDataFrame([(0,), (1,), (4,), (4,)], "flag int")
    got = {r["bit"]: (r["n"], r["percent"]) for r in flags.summary(df).collect()}
    assert got[1] == (1, 25.0) and got[4] == (2, 50.0) and got[256] == (0, 0.0)
    assert flags.add_bit(df, F.lit(True), 8).where("flag = 8").count() == 1


def test_tables_between_steps_change_nothing(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, "a", i % 9, f"t{i}", float(rng.uniform(-80, 80)), *(float(x) for x in rng.normal(220 + 25 * (i % 9 == 4), 6, 4)), "ok") for i in range(900)]
    df, cuts = frame(spark, rows), []

    def between(held):
        cuts.append(len(cuts))
        held.write.parquet(f"{tmp_path}/{cuts[-1]}")
        return spark.read.parquet(f"{tmp_path}/{cuts[-1]}")

    rules = flags.FlagRules(channel_spread=40.0, min_orbit_size=5, mad_limit=3.0, vote_percentile=0.5, min_tile_count=1)
    first, steps = flags.mission({"a": "ok"}), flags.standard_steps(rules)
    plain, cut = by_id(flags.apply_flags(df, first, steps)), by_id(flags.apply_flags(df, first, steps, between))
    assert plain == cut and len(cuts) == 2 and {flags.LAT_MODEL, flags.LAT_CUT} & set(plain.values())
