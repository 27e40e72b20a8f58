from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from gridlark.functions import times
from gridlark.plans import templates
from gridlark.sources import rasters


def card(key: str, value: object) -> bytes:
    text = f"'{value}'" if isinstance(value, str) else f"{value:>20}"
    return f"{key:<8}= {text} / a comment".ljust(80)[:80].encode()


def unit(data: np.ndarray, first: bytes, **more: object) -> bytes:
    kinds = {"u1": 8, "i2": 16, "f4": -32}
    cards = [first, card("BITPIX", kinds[data.dtype.str[1:]]), card("NAXIS", 2), card("NAXIS1", data.shape[1]), card("NAXIS2", data.shape[0]), *(card(k, v) for k, v in more.items()), b"END".ljust(80)]
    pad = lambda x, c: x + c * (-len(x) % 2880)
    return pad(b"".join(cards), b" ") + pad(data.astype(data.dtype.newbyteorder(">")).tobytes(), b"\0")


def test_fits_images(spark, tmp_path, monkeypatch):
    a = np.arange(12, dtype=np.float32).reshape(3, 4)
    a[1, 2] = np.nan
    b = np.arange(6, dtype=np.int16).reshape(2, 3)
    (tmp_path / "x.fits").write_bytes(unit(a, card("SIMPLE", "T")) + unit(b, card("XTENSION", "IMAGE"), EXTNAME="TEMP_0_2", BSCALE=0.5, BZERO=100, BLANK=5))
    got = {(r.name, r.lat_ix, r.lon_ix): r.value for r in rasters.read_fits(spark, str(tmp_path)).collect()}
    assert len(got) == 18 and got["PRIMARY", 2, 3] == 11 and got["PRIMARY", 1, 2] is None
    assert got["TEMP_0_2", 1, 0] == 101.5 and got["TEMP_0_2", 1, 2] is None
    assert rasters.read_fits(spark, str(tmp_path), "TEMP").select("name").distinct().count() == 1
    heads = {(r.hdu, r.key): r.value for r in rasters.fits_headers(spark, str(tmp_path)).collect()}
    assert heads[1, "EXTNAME"] == "TEMP_0_2" and heads[0, "NAXIS1"] == "4" and heads[1, "BZERO"] == "100"


def test_pds3_images(spark, tmp_path):
    data = np.array([[1, 2, -32768], [4, 5, 6]], "<i2")
    label = 'PDS_VERSION_ID = PDS3\r\nRECORD_BYTES = 600\r\n^IMAGE = 2\r\nPRODUCT_ID = "SLOPE"\r\nOBJECT = IMAGE\r\n LINES = 2\r\n LINE_SAMPLES = 3\r\n SAMPLE_TYPE = LSB_INTEGER\r\n SAMPLE_BITS = 16\r\n SCALING_FACTOR = 0.5\r\n OFFSET = 10.0 <K>\r\n MISSING_CONSTANT = -32768\r\nEND_OBJECT = IMAGE\r\nEND\r\n'
    (tmp_path / "s.IMG").write_bytes(label.encode().ljust(600) + data.tobytes())
    got = {(r.lat_ix, r.lon_ix): r.value for r in rasters.read_pds3(spark, str(tmp_path)).where("name = 'SLOPE'").collect()}
    assert got == {(0, 0): 10.5, (0, 1): 11.0, (0, 2): None, (1, 0): 12.0, (1, 1): 12.5, (1, 2): 13.0}


def test_dates_and_hooks(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    assert rasters.file_dates(spark, str(tmp_path)).where(F.col("modified").rlike(r"^\d{4}-\d\d-\d\d$")).count() == 1
    assert spark.range(1).select(times.creation_time().rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$")).first()[0]
    assert templates.describe({"a": 2, "b": 3}, {"a": lambda x: x * 10}, {"sum": lambda p: p["a"] + p["b"]}) == {"a": 20, "b": 3, "sum": 23}
