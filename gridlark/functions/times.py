"""Times: Julian dates, dynamical time, ephemeris seconds, local solar time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The days on which TAI - UTC grew, and what it has been since.
LEAP_SECONDS = [
    ("1972-01-01", 10), ("1972-07-01", 11), ("1973-01-01", 12), ("1974-01-01", 13), ("1975-01-01", 14), ("1976-01-01", 15), ("1977-01-01", 16),
    ("1978-01-01", 17), ("1979-01-01", 18), ("1980-01-01", 19), ("1981-07-01", 20), ("1982-07-01", 21), ("1983-07-01", 22), ("1985-07-01", 23),
    ("1988-01-01", 24), ("1990-01-01", 25), ("1991-01-01", 26), ("1992-07-01", 27), ("1993-07-01", 28), ("1994-07-01", 29), ("1996-01-01", 30),
    ("1997-07-01", 31), ("1999-01-01", 32), ("2006-01-01", 33), ("2009-01-01", 34), ("2012-07-01", 35), ("2015-07-01", 36), ("2017-01-01", 37),
]
TT_MINUS_TAI = 32.184
UNIX_EPOCH_JD, J2000_JD = 2440587.5, 2451545.0


def parse_utc(text: Column) -> Column:
    """ISO 8601 text, with or without a Z, to a timestamp without zone."""
    return F.to_timestamp_ntz(F.regexp_replace(F.rtrim(text), "Z$", ""))


def unix_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zoneless timestamp taken as UTC, with its fraction."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz")).cast("double") / 1e6


def julian_date(unix: Column) -> Column:
    return unix / 86400.0 + UNIX_EPOCH_JD


def tai_minus_utc(unix: Column) -> Column:
    out = F.lit(float(LEAP_SECONDS[0][1]))
    for day, s in LEAP_SECONDS[1:]:
        at = dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc).timestamp()
        out = F.when(unix >= at, F.lit(float(s))).otherwise(out)
    return out


def ephemeris_seconds(unix: Column) -> Column:
    """Seconds past J2000 in dynamical time, without its periodic terms (2 ms at most)."""
    return unix + tai_minus_utc(unix) + (TT_MINUS_TAI - (J2000_JD - UNIX_EPOCH_JD) * 86400.0)


def tdb_julian_date(unix: Column) -> Column:
    return julian_date(unix + tai_minus_utc(unix) + TT_MINUS_TAI)


def creation_time() -> Column:
    """The time of the query, UTC, as labels write it: to the second, with a Z."""
    return F.concat(F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))


def local_bin(ltst: Column, hours: int = 2) -> Column:
    """Start hour of the local-time bin of a day fraction. hours must divide 24."""
    if 24 % hours:
        raise ValueError(f"{hours} does not divide 24")
    return (F.floor(ltst * 24 / hours) * hours).cast("int")


def hms_fraction(text: Column) -> Column:
    """The day fraction of H:M:S text."""
    p = F.split(text, ":")
    return (p[0].cast("double") * 3600 + p[1].cast("double") * 60 + p[2].cast("double")) / 86400.0
