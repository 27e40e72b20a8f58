"""Whole-file raster readers: FITS images and PDS3 images with attached labels, as long tables of cells.

A file is read in one task, wherever Spark can read; `sources.fits` reads large
files in splits. Lines keep their order in the file; values are scaled, and blank
or missing ones are null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells that a task hands on at once.
CELLS = 1_000_000
# Sizes of the FITS format.
BLOCK, CARD = 2880, 80
FITS_TYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}


def card_value(text: str) -> str | None:
    """The value of a header card, without quotes and comment."""
    text = text.strip()
    if text.startswith("'"):
        m = re.match(r"'((?:[^']|'')*)'", text)
        return m[1].replace("''", "'").rstrip() if m else text
    value = text.split("/", 1)[0].strip()
    return value or None


def fits_units(raw: bytes) -> Iterator[tuple[int, dict[str, str | None], int]]:
    """(number, header, offset of the data) of each header and data unit."""
    at, number = 0, 0
    while at + BLOCK <= len(raw) and raw[at : at + CARD].strip(b"\0 "):
        header: dict[str, str | None] = {}
        while True:
            card = raw[at : at + CARD].decode("latin-1")
            at += CARD
            key = card[:8].strip()
            if key == "END" or not card:
                break
            if card[8:10] == "= ":
                header.setdefault(key, card_value(card[10:]))
        at = -(-at // BLOCK) * BLOCK
        yield number, header, at
        axes = [int(header.get(f"NAXIS{i + 1}") or 0) for i in range(int(header.get("NAXIS") or 0))]
        size = abs(int(header.get("BITPIX") or 8)) // 8 * (int(np.prod(axes)) if axes else 0)
        size = int(header.get("GCOUNT") or 1) * (size + int(header.get("PCOUNT") or 0))
        at += -(-size // BLOCK) * BLOCK
        number += 1


def unit_name(number: int, header: dict[str, str | None]) -> str:
    return header.get("EXTNAME") or ("PRIMARY" if number == 0 else f"HDU{number}")


def _values(raw: np.ndarray, scale: float, zero: float, blank: float | None) -> pa.Array:
    held = raw.astype(np.float64)
    none = ~np.isfinite(held) if blank is None else (held == blank) | ~np.isfinite(held)
    return pa.array(held * scale + zero, pa.float64(), mask=none)


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("path").alias("file"), "content")


def _cells(file: str, name: str, grid: np.ndarray, scale: float, zero: float, blank: float | None) -> Iterator[pa.RecordBatch]:
    lines, samples = grid.shape
    step = max(1, CELLS // max(1, samples))
    for a in range(0, lines, step):
        part = grid[a : a + step]
        k = part.size
        lat = np.repeat(np.arange(a, a + len(part), dtype=np.int32), samples)
        yield pa.RecordBatch.from_arrays([pa.array([file] * k), pa.array([name] * k), pa.array(lat), pa.array(np.tile(np.arange(samples, dtype=np.int32), len(part))), _values(part.ravel(), scale, zero, blank)], names=["file", "name", "lat_ix", "lon_ix", "value"])


CELL_SCHEMA = "file string, name string, lat_ix int, lon_ix int, value double"


def read_fits(spark: SparkSession, path: str, prefix: str = "", pattern: str = "*.fit*") -> DataFrame:
    """(file, name, lat_ix, lon_ix, value) of the two-dimensional images whose names begin with prefix."""
    def run(batches):
        for b in batches:
            for file, raw in zip(b.column("file").to_pylist(), b.column("content").to_pylist()):
                for number, h, at in fits_units(raw):
                    image = number == 0 or h.get("XTENSION") == "IMAGE"
                    if image and h.get("NAXIS") == "2" and unit_name(number, h).startswith(prefix):
                        shape = int(h["NAXIS2"]), int(h["NAXIS1"])
                        grid = np.frombuffer(raw, FITS_TYPES[int(h["BITPIX"])], shape[0] * shape[1], at).reshape(shape)
                        yield from _cells(file, unit_name(number, h), grid, float(h.get("BSCALE") or 1), float(h.get("BZERO") or 0), float(h["BLANK"]) if h.get("BLANK") else None)

    return _files(spark, path, pattern).mapInArrow(run, CELL_SCHEMA)


def fits_headers(spark: SparkSession, path: str, pattern: str = "*.fit*") -> DataFrame:
    """(file, hdu, name, key, value) of every header card with a value: the listing of a file's units."""
    def run(batches):
        for b in batches:
            for file, raw in zip(b.column("file").to_pylist(), b.column("content").to_pylist()):
                rows = [(file, n, unit_name(n, h), k, v) for n, h, _ in fits_units(raw) for k, v in h.items()]
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()))], names=["file", "hdu", "name", "key", "value"])

    return _files(spark, path, pattern).mapInArrow(run, "file string, hdu int, name string, key string, value string")


#: Sample types of PDS3 images: byte order and kind.
PDS3_TYPES = {"MSB_INTEGER": ">i", "LSB_INTEGER": "<i", "MSB_UNSIGNED_INTEGER": ">u", "LSB_UNSIGNED_INTEGER": "<u", "UNSIGNED_INTEGER": ">u", "PC_REAL": "<f", "IEEE_REAL": ">f"}


def pds3_label(raw: bytes) -> dict[str, str]:
    """KEY = VALUE pairs of an attached label; the first of repeated keys counts."""
    text = raw[: 1 << 16].decode("latin-1")
    end = re.search(r"(?m)^END[ \t]*\r?$", text)
    out: dict[str, str] = {}
    for m in re.finditer(r"(?m)^\s*([\w^:]+)\s*=\s*(.*?)\s*$", text[: end.start()] if end else text):
        out.setdefault(m[1], m[2].strip('"'))
    return out


def _number(text: str | None) -> float | None:
    m = re.match(r"[-+]?[0-9.]+(?:[eEdD][-+]?\d+)?", text or "")
    return float(m[0].replace("D", "E").replace("d", "e")) if m else None


def read_pds3(spark: SparkSession, path: str, pattern: str = "*.IMG") -> DataFrame:
    """(file, name, lat_ix, lon_ix, value) of images with attached labels; name is the product's id."""
    def run(batches):
        for b in batches:
            for file, raw in zip(b.column("file").to_pylist(), b.column("content").to_pylist()):
                h = pds3_label(raw)
                start = h["^IMAGE"]
                at = int(_number(start)) - 1
                at = at if "BYTES" in start.upper() else at * int(h["RECORD_BYTES"])
                shape = int(h["LINES"]), int(h["LINE_SAMPLES"])
                grid = np.frombuffer(raw, f"{PDS3_TYPES[h['SAMPLE_TYPE']]}{int(h['SAMPLE_BITS']) // 8}", shape[0] * shape[1], at).reshape(shape)
                scale, zero = _number(h.get("SCALING_FACTOR")), _number(h.get("OFFSET"))
                yield from _cells(file, h.get("PRODUCT_ID", ""), grid, 1.0 if scale is None else scale, zero or 0.0, _number(h.get("MISSING_CONSTANT")))

    return _files(spark, path, pattern).mapInArrow(run, CELL_SCHEMA)


def file_dates(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file, modified): the day, UTC, of each file's last change, as text."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("path").alias("file"), F.date_format(F.to_utc_timestamp("modificationTime", F.current_timezone()), "yyyy-MM-dd").alias("modified"))
