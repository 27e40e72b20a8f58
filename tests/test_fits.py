"""FITS sources and sinks: splits against the whole-file reader, commit and rollback."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlark.sources import fits, rasters
from tests.test_rasters import card, unit


def cells_of(df):
    return {(r.name, r.lat_ix, r.lon_ix): r.value for r in df.collect()}


@pytest.fixture
def images(tmp_path):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(300, 40)).astype(np.float32)
    a[7, 3] = np.nan
    b = rng.integers(-99, 99, (50, 7)).astype(np.int16)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.fits").write_bytes(unit(a, card("SIMPLE", "T")) + unit(b, card("XTENSION", "IMAGE"), EXTNAME="TEMP_0_2", BSCALE=0.5, BZERO=100, BLANK=5))
    (tmp_path / "in" / "y.fits").write_bytes(unit(b[:3], card("SIMPLE", "T"), EXTNAME="other"))
    return tmp_path / "in"


@pytest.mark.parametrize("split", [1000, 10_000, 1 << 26])
def test_splits_give_what_the_whole_file_reader_gives(spark, images, split):
    got, want = fits.read_images(spark, str(images), split=split), rasters.read_fits(spark, str(images))
    assert cells_of(got) == cells_of(want) and got.count() == want.count()
    parts = got.rdd.getNumPartitions()
    assert parts == sum(max(1, -(-f.stat().st_size // split)) for f in images.iterdir())
    assert cells_of(fits.read_images(spark, f"file://{images}", prefix="TEMP", split=split)) == cells_of(rasters.read_fits(spark, str(images), "TEMP"))


def test_a_crop_reads_only_its_lines(images):
    """Bytes that a reader asks for, counted: headers and the crop's lines, or its samples where it is narrow."""
    class Counted:
        def __init__(self, f):
            self.f, self.n = f, 0

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            self.n += n
            return self.f.read(n)

        def read_at(self, n, at):
            self.n += n
            return self.f.read_at(n, at)

    def asked(**options):
        reader, total, rows = fits.ImageReader({"path": str(images), "pattern": "x.fits", "prefix": "PRIMARY", "split": "9000", **options}), 0, 0
        for s in reader.partitions():
            with fits.opened(str(images))[0].open_input_file(s.file) as f:
                c = Counted(f)
                rows += sum(b.num_rows for b in reader.rows(c, s))
                total += c.n
        return total - len(reader.partitions()) * 2 * fits.BLOCK, rows

    assert asked() == (300 * 40 * 4, 300 * 40)
    assert asked(lines="10:30") == (20 * 40 * 4, 20 * 40)
    assert asked(lines="10:30", samples="5:9") == (20 * 4 * 4, 20 * 4)
    assert asked(lines="400:500") == (0, 0)


def test_conditions_narrow_the_read(spark, images):
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = fits.read_images(spark, str(images)).where("lat_ix >= 5 and lat_ix < 9 and lon_ix = 3 and name = 'PRIMARY'")
        want = {k: v for k, v in cells_of(rasters.read_fits(spark, str(images))).items() if k[0] == "PRIMARY" and 5 <= k[1] < 9 and k[2] == 3}
        assert cells_of(df) == want and len(want) == 4
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)
    box = fits.Box()
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThanOrEqual

    for f in (GreaterThan(("lat_ix",), 4), LessThanOrEqual(("lat_ix",), 8), EqualTo(("lon_ix",), 3), EqualTo(("name",), "x")):
        box.narrow(f)
    assert box.lines == (5, 9) and box.samples == (3, 4) and box.equal == {"name": "x"}


def test_pds3_in_splits(spark, tmp_path):
    data = np.arange(600, dtype="<i2").reshape(100, 6)
    label = "RECORD_BYTES = 600\r\n^IMAGE = 2\r\nPRODUCT_ID = \"S\"\r\nLINES = 100\r\nLINE_SAMPLES = 6\r\nSAMPLE_TYPE = LSB_INTEGER\r\nSAMPLE_BITS = 16\r\nMISSING_CONSTANT = 77\r\nEND\r\n"
    (tmp_path / "s.IMG").write_bytes(label.encode().ljust(600) + data.tobytes())
    got = fits.read_images(spark, str(tmp_path), "*.IMG", "pds3", split=400)
    assert got.rdd.getNumPartitions() == 5 and cells_of(got) == cells_of(rasters.read_pds3(spark, str(tmp_path)))


def test_images_are_written_in_parallel_and_read_back(spark, tmp_path):
    rows = [(n, i, j, None if (i + j) % 9 == 0 else float(i * 10 + j)) for n in ("A", "B") for i in range(0, 50) for j in range(0, 11, 2)]
    df = spark.createDataFrame(rows, "name string, lat_ix int, lon_ix int, value double").repartition(5)
    fits.write_images(df, f"{tmp_path}/out", samples=11, lines=8)
    files = sorted(p.name for p in (tmp_path / "out").iterdir() if p.name.endswith(".fits"))
    assert len(files) == 14 and (tmp_path / "out" / "_SUCCESS").exists() and [p.name for p in tmp_path.iterdir()] == ["out"]
    want = {r[:3]: r[3] for r in rows if r[3] is not None}
    for read in (fits.read_images(spark, f"{tmp_path}/out", split=500), fits.read_images(spark, f"{tmp_path}/out")):
        assert {k: v for k, v in cells_of(read).items() if v is not None} == want
    with pytest.raises(Exception, match="outside of the image"):
        fits.write_images(df, f"{tmp_path}/out", samples=5)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.name.endswith(".fits")) == files


TABLE = "i int, k long, s short, f float, d double, b boolean, t string"
ROWS = [(1, 2**40, 3, 1.5, 2.5, True, "é text"), (None, None, None, None, None, None, None), (-5, -(2**62), -7, -1.0, 1e300, False, ""), (7, 8, 9, 0.0, math.pi, True, "it's")]


def test_small_files_of_a_table_are_read_together(spark, tmp_path):
    """Tasks grow with bytes, not with files or splits; every row is read once."""
    fits.write_binary_table(spark.range(1000).coalesce(1), f"{tmp_path}/t", rows=10)
    back = fits.read_binary_table(spark, f"{tmp_path}/t", split=2000)
    assert len(list((tmp_path / "t").glob("*.fits"))) == 100 and back.rdd.getNumPartitions() == 1
    assert sorted(r.id for r in back.collect()) == list(range(1000))


@pytest.mark.parametrize("most", [1, 70, 130, 1000])
def test_packed_splits_cover_all_lines(most):
    sizes = {"a": 100, "b": 10, "c": 250}
    packs = fits.packed([fits.Split(f, n, k, -(-n // 60)) for f, n in sizes.items() for k in range(-(-n // 60))], most)
    got = [(s.file, i) for p in packs for s in p.splits for i in range(*s.lines(0, sizes[s.file]))]
    assert sorted(got) == [(f, i) for f, n in sizes.items() for i in range(n)] and len(packs) == {1: 8, 70: 7, 130: 4, 1000: 1}[most]


def test_texts_of_one_width_and_back():
    held = pa.array(["x", None, "", "é text", " a ", "it's", "  ", "b\0c", None], pa.string())
    for part in (held, held.slice(2, 5), held.slice(1, 2)):
        want = [None if x is None else x.rstrip(" ") for x in part.to_pylist()]
        assert fits.texts(fits.fixed_texts(part)).to_pylist() == want
    with pytest.raises(pa.ArrowInvalid):
        fits.texts(np.array([b"\xff"], "S1"))


@pytest.mark.parametrize("rows, split", [(3, 300), (1000, 1 << 20)])
def test_binary_tables_read_back(spark, tmp_path, rows, split):
    df = spark.createDataFrame(ROWS * 5, TABLE).repartition(3)
    fits.write_binary_table(df, f"{tmp_path}/t", rows=rows)
    back = fits.read_binary_table(spark, f"{tmp_path}/t", split=split)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert {r.t for r in fits.read_binary_table(spark, f"{tmp_path}/t", schema="t string").collect()} == {"é text", None, "", "it's"}
    heads = {r.key for r in rasters.fits_headers(spark, f"{tmp_path}/t").collect()}
    assert {"XTENSION", "TFORM7", "TTYPE1"} <= heads


def test_failed_tasks_leave_the_old_output(spark, tmp_path):
    path = f"{tmp_path}/t"
    fits.write_binary_table(spark.range(5), path)
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        fits.write_binary_table(bad, path)
    assert [p.name for p in tmp_path.iterdir()] == ["t"] and fits.read_binary_table(spark, path).count() == 5
    fits.write_binary_table(spark.range(3), path, mode="append")
    assert fits.read_binary_table(spark, path).count() == 8
    fits.write_binary_table(spark.range(2), path)
    assert fits.read_binary_table(spark, path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_commit_takes_committed_attempts_only_and_restores(tmp_path, monkeypatch):
    """Files of attempts that did not count are deleted; if the new folder cannot be moved, the old one is back."""
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "old.fits").write_text("old")

    def writer():
        w = fits.TableWriter(fits.T.StructType([fits.T.StructField("i", fits.T.LongType())]), {"path": f"{tmp_path}/out"}, True)
        fits.opened(w.beside)[0].create_dir(w.beside)
        for n in ("good", "stray"):
            (tmp_path / w.beside.rsplit("/", 1)[1] / n).write_text(n)
        return w

    w = writer()
    real = fits.fs.LocalFileSystem.move

    class Bad:
        """A filesystem whose second move fails."""

        def __init__(self, inner):
            self.inner, self.moves = inner, 0

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def move(self, a, b):
            self.moves += 1
            if self.moves == 2:
                raise OSError("no space")
            real(self.inner, a, b)

    bad = Bad(fits.fs.LocalFileSystem())
    with monkeypatch.context() as m:
        m.setattr(fits, "opened", lambda p: (bad, p))
        with pytest.raises(OSError, match="no space"):
            w.commit([fits.Written([("good", "good")]), None])
    assert [p.name for p in tmp_path.iterdir()] == ["out"] and [p.name for p in (tmp_path / "out").iterdir()] == ["old.fits"]
    writer().commit([fits.Written([("good", "better")])])
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["_SUCCESS", "better"] and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_types_that_tables_lack_and_values_that_stand_for_null(spark, tmp_path):
    with pytest.raises(Exception, match="cast it"):
        fits.write_binary_table(spark.range(1).select(F.current_date().alias("d")), f"{tmp_path}/t")
    with pytest.raises(Exception, match="stands for null"):
        fits.write_binary_table(spark.createDataFrame([(-(2**31),), (None,)], "i int").coalesce(1), f"{tmp_path}/t")
    assert not list(tmp_path.iterdir())


def test_empty_tables(spark, tmp_path):
    fits.write_binary_table(spark.range(0), f"{tmp_path}/t")
    assert fits.read_binary_table(spark, f"{tmp_path}/t", schema="id long").count() == 0
    fits.write_images(spark.createDataFrame([], "name string, lat_ix int, lon_ix int, value double"), f"{tmp_path}/i", samples=4)
    assert fits.read_images(spark, f"{tmp_path}/i").count() == 0


def test_text_files_and_copies(spark, tmp_path):
    df = spark.createDataFrame([(f"f{i}.xml", f"<a>{i}</a>") for i in range(9)], "name string, label string").repartition(3)
    fits.write_text_files(df, f"{tmp_path}/l")
    assert {p.name: p.read_text() for p in (tmp_path / "l").glob("*.xml")} == {r.name: r.label for r in df.collect()}
    with pytest.raises(Exception, match="one file name"):
        fits.write_text_files(spark.createDataFrame([("x", "1"), ("x", "2")], "name string, label string"), f"{tmp_path}/l")
    assert len(list((tmp_path / "l").glob("*.xml"))) == 9
    copied = fits.copy_files(df.select(F.concat(F.lit(f"{tmp_path}/l/"), "name").alias("source"), F.concat(F.lit(f"{tmp_path}/copy/sub/"), "name").alias("target")), 3)
    assert copied.agg(F.sum("bytes")).first()[0] == 9 * 8 and (tmp_path / "copy" / "sub" / "f3.xml").read_text() == "<a>3</a>"
