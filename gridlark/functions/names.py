"""Names of files and products, and fuzzy key lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File name of an orbit's table; the number is the orbit's, of four digits or more.
ORBIT_FILE = r"_(\d{4,7})_[AB]\.2[BC]"
BIN_NAME = r"(\d+)_(\d+)$"
BROWSE_NAME = r"(?:(\w{3})_)?(t\d)_(\w+?)_(\d+_\d+)(\w+)?\.png"


def orbit_number(path: Column) -> Column:
    """The orbit of a file name; null if the name has none."""
    return F.nullif(F.regexp_extract(path, ORBIT_FILE, 1), F.lit("")).cast("int")


def hour_label(start: Column, stop: Column) -> Column:
    """Day fractions to 'h_h'."""
    return F.concat_ws("_", F.round(start * 24).cast("int").cast("string"), F.round(stop * 24).cast("int").cast("string"))


def bin_clock_label(name: Column) -> Column:
    """A product name that ends in h_h to 'hh:00-hh:00'; null for other names."""
    part = lambda i: F.concat(F.lpad(F.regexp_extract(name, BIN_NAME, i), 2, "0"), F.lit(":00"))
    return F.when(name.rlike(BIN_NAME), F.concat_ws("-", part(1), part(2)))


def coordinate_text(x: Column) -> Column:
    """One decimal, without a trailing .0, minus as m, the point as _."""
    text = F.regexp_replace(F.format_string("%.1f", F.round(x, 1)), r"\.0$", "")
    return F.translate(text, "-.", "m_")


def map_name(orbiter: Column, channel: Column, ltst: Sequence[Column], lat: Sequence[Column], lon: Sequence[Column]) -> Column:
    """The name of a map from its bounds; local time in day fractions."""
    pair = lambda two, scale=1: F.concat_ws("_", *[coordinate_text(x * scale) for x in two])
    return F.concat(orbiter, F.lit("_t"), channel.cast("string"), F.lit("_ltst_"), pair(ltst, 24), F.lit("_lat_"), pair(lat), F.lit("_lon_"), pair(lon), F.lit("_deconv"))


def month_folder(orbiter: Column, ts: Column) -> Column:
    return F.concat_ws("/", orbiter, F.date_format(ts, "yyyyMM"))


def lookup(table: Mapping[str, object], key: str) -> object:
    """The value of key: exact, else without regard to case, else the one key that contains it."""
    if key in table:
        return table[key]
    low = key.lower()
    same = [k for k in table if k.lower() == low]
    near = same or [k for k in table if low in k.lower()]
    if len(near) == 1:
        return table[near[0]]
    raise KeyError(f"{key}: {len(near)} keys match")
