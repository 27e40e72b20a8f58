from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridlark.functions import names
from gridlark.plans import templates
from gridlark.schema import SAMPLES, conform
from gridlark.sources import sinks, tables

LABEL = "PDS_VERSION_ID = 3\nRECORD_TYPE = STREAM\nEND\n{sep}\n"


@pytest.fixture
def orbit_files(tmp_path):
    (tmp_path / "sub").mkdir()
    row = "2007-11-27T16:18:16.123Z 200.1 210.2 220.3 230.4 10.0 20.0 {lon} -12.5 201.5 {flag}\n"
    (tmp_path / "sub" / "X_20071127_0241_A.2C").write_text(LABEL.format(sep="---") + row.format(lon=190.5, flag="0X000000") + row.format(lon=9999.9999, flag="0X000001"))
    (tmp_path / "X_20071128_0242_A.2C").write_text(LABEL.format(sep=""))
    (tmp_path / "X_20071129_0243_B.2C").write_text(LABEL.format(sep="==") + row.format(lon=-5.0, flag="00"))
    (tmp_path / "X_20071129_0243_B.2B").write_text("other")
    return str(tmp_path)


def test_orbit_texts(spark, orbit_files):
    raw = tables.read_orbit_texts(spark, orbit_files, "a")
    got = sorted((r.orbit, r.lon, r.flag) for r in raw.collect())
    assert got == [(241, "190.5", "0X000000"), (241, "9999.9999", "0X000001"), (243, "-5.0", "00")]
    assert [r.orbit for r in tables.empty_orbits(spark, orbit_files).collect()] == [242]
    typed = sorted((r.orbit, round(r.lon, 3), r.mflag, str(r.utc)) for r in tables.typed_samples(raw).collect())
    assert typed[0] == (241, -169.5, "0X000000", "2007-11-27 16:18:16.123000")
    assert typed[2][2] == "0"


def test_texts_are_read_once_and_not_shuffled(spark, orbit_files):
    """One scan with content and no exchange, whether or not an orbit has several files; the last by path counts."""
    typed = lambda: tables.typed_samples(tables.read_orbit_texts(spark, orbit_files, "a"), ordered=False)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    first = plan(typed())
    assert first.count("FileScan text") == 1 and "Exchange" not in first
    with open(f"{orbit_files}/X_20071130_0243_A.2C", "w") as f:
        f.write(LABEL.format(sep="") + "2007-11-30T16:18:16.123Z 1 2 3 4 5 6 7 8 9 0X000000\n" * 2)
    with open(f"{orbit_files}/unnumbered.2C", "w") as f:
        f.write(LABEL.format(sep="") + "x\n")
    second = typed()
    assert plan(second).count("FileScan text") == 1 and "SortMergeJoin" not in plan(second) and "rangepartitioning" not in plan(second)
    key = lambda r: (r.orbit, r.utc, r.lon, r.mflag)
    want = tables.typed_samples(tables.read_orbit_texts(spark, orbit_files, "a")).collect()
    assert sorted(map(key, second.collect())) == sorted(map(key, want)) and [r.orbit for r in want] == [241, 241, 243, 243]
    assert {str(r.utc.date()) for r in want if r.orbit == 243} == {"2007-11-30"}


def test_conform_adds_and_drops(spark):
    out = conform(spark.createDataFrame([(1, "x")], "ORBIT int, other string"))
    assert out.schema == SAMPLES or [f.name for f in out.schema] == SAMPLES.fieldNames()
    assert out.first()["orbit"] == 1 and out.first()["ox"] is None


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 2, "TEMP", 0, i, 0, 200.0 + i) for i in range(3)], "orbiter string, channel int, maptype string, bin_start int, lat_ix int, lon_ix int, value double")
    sinks.write_maps(df, f"{tmp_path}/m", rows=3, value="value")
    back = tables.read_maps(spark, f"{tmp_path}/m", maptype="TEMP")
    assert sorted((r.lat_ix, round(r.q * r.scale + r.zero)) for r in back.collect()) == [(0, 202), (1, 201), (2, 200)]
    assert sinks.write_once(df, f"{tmp_path}/once") and not sinks.write_once(df, f"{tmp_path}/once")
    sinks.write_clustered(df.withColumn("lat", F.col("value")), f"{tmp_path}/c")
    sinks.write_table(df, f"{tmp_path}/meta", metadata={"source": "test"})
    assert spark.read.parquet(f"{tmp_path}/meta").count() == 3
    sinks.write_by_month(df.withColumn("utc", F.lit("2007-11-27 00:00:00").cast("timestamp_ntz")), f"{tmp_path}/by")
    assert (tmp_path / "by" / "orbiter=a" / "month=200711").exists()


def test_names(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(names.bin_clock_label(F.lit("TEMP_22_24"))) == "22:00-24:00"
    assert one(names.bin_clock_label(F.lit("LATITUDE"))) is None
    assert names.lookup({"Alpha": 1, "beta_one": 2}, "alpha") == 1 and names.lookup({"Alpha": 1, "beta_one": 2}, "ONE") == 2
    with pytest.raises(KeyError):
        names.lookup({"ab": 1, "ac": 2}, "a")


def test_templates(spark):
    text = "a {x}\n  {delete:map}\nonly tables\n  {stop:map}\n<!-- note -->\n{delete:table}\nonly maps\n{stop:table}\nend"
    want = "a {x}\nonly maps\nend"
    assert templates.delete_lines(text, ["map"]) == want
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(text.split("\n"))], "f int, n int, line string")
    got = templates.delete_lines_frame(lines, ["map"], ["f"]).orderBy("n").collect()
    assert "\n".join(r.line for r in got) == want
    assert templates.fill(want, {"x": 3}).startswith("a 3")
    with pytest.raises(ValueError):
        templates.fill(want, {"x": None})
    assert templates.associate({"PPD": 4}, {"mpp": ("ppd", lambda v: v * 2)}) == {"mpp": 8}
    assert templates.round_element("<v>1.23456</v>", "v", 2) == "<v>1.23</v>"
    assert templates.xml_element("a", "<") == "<a>&lt;</a>"
    assert templates.indent("<a><b/></a>") == "<a>\n  <b />\n</a>"


def test_label_metadata_and_spans(spark, orbit_files):
    got = {(r.orbit, r.key): r.value for r in tables.read_label_metadata(spark, orbit_files).collect()}
    assert got[241, "RECORD_TYPE"] == "STREAM" and got[242, "PDS_VERSION_ID"] == "3"
    typed = tables.typed_samples(tables.read_orbit_texts(spark, orbit_files, "a"))
    assert tables.time_span(typed).count() == 2
    assert tables.spot_check(typed, 2).collect() == tables.spot_check(typed.repartition(3), 2).collect()


def test_command_line(spark, tmp_path):
    from gridlark.__main__ import main

    rows = [("a", 1, float(x), float(x * 2), 100.0, (x % 24) / 24, 240.0, 240.0, 240.0, 240.0, 0) for x in range(-50, 50, 5)]
    spark.createDataFrame(rows, "orbiter string, orbit int, lat double, lon double, d double, ltst double, t1 double, t2 double, t3 double, t4 double, flag int").write.parquet(f"{tmp_path}/s")
    main(["map", f"{tmp_path}/s", f"{tmp_path}/m", "--orbiter", "a", "--channel", "2", "--hours", "12", "--resolution", "5", "--kernel-step", "4", "--sigma", "1"])
    main(["products", f"{tmp_path}/m", f"{tmp_path}/p"])
    out = spark.read.parquet(f"{tmp_path}/p")
    assert {r.maptype for r in out.select("maptype").distinct().collect()} == {"TEMP", "STDEV", "LATSHIFT"}
    assert out.where("maptype = 'TEMP'").agg(F.min("value"), F.max("value")).first()[0] == pytest.approx(240)


def test_cached_tables_and_failed_writes(spark, tmp_path):
    made = []

    def make(n):
        made.append(n)
        return spark.range(n)

    path = f"{tmp_path}/t"
    assert sinks.cached(spark, path, lambda: make(3)).count() == 3
    assert sinks.cached(spark, path, lambda: make(4)).count() == 3
    assert sinks.cached(spark, path, lambda: make(5), overwrite=True).count() == 5 and made == [3, 5]
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        sinks.write_once(bad, path, overwrite=True)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_provenance_stays_with_the_maps(spark, tmp_path):
    df = spark.createDataFrame([("a", 2, "TEMP", 0, 0, 0, 1.0)], "orbiter string, channel int, maptype string, bin_start int, lat_ix int, lon_ix int, value double")
    sinks.write_maps(df.select("lat_ix", "lon_ix", "value", "orbiter", "channel", "maptype", "bin_start"), f"{tmp_path}/m", provenance={"sigma": "3"})
    assert {"sigma": "3"} in tables.metadata(spark.read.parquet(f"{tmp_path}/m")).values()
