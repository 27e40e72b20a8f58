"""Sample tables laid out for slices of several axes: Z-ordered files and a manifest of what each holds.

The axes are cut into 2 ** BITS steps, and the steps' bits are interleaved: rows
that are near in all axes are near in the order, so a file of it is a small box in
all of them. The manifest has the bounds of each file; a slice first picks the
files whose boxes it meets and reads no others. Rows are filtered as well, so the
manifest only saves work.

Edge cases: null or NaN in an axis counts as its lower end in the order; a file
with such rows has no bounds on that axis only if it has no others, and is then
read by slices without a condition on it; an empty table has an empty manifest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of an axis in the order's key.
BITS = 16
#: Axes of a sample and what they range over.
AXES = {"lat": (-90.0, 90.0), "lon": (-180.0, 180.0), "ltst": (0.0, 1.0)}
#: Rows for which one file is made.
FILE_ROWS = 4_000_000
#: Half-open ranges of an axis; several are alternatives, as a local time across midnight has them.
Ranges = Sequence[tuple[float, float]]


def _apart(x: Column, by: int) -> Column:
    """The bits of x with by - 1 zeros between neighbours."""
    out = F.lit(0).cast("long")
    for k in range(BITS):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(x, k).bitwiseAND(F.lit(1)), k * by))
    return out


def z_key(axes: Mapping[str, tuple[float, float]] = AXES) -> Column:
    """A row's place in the order."""
    if len(axes) * BITS > 62:
        raise ValueError(f"at most {62 // BITS} axes")
    steps = 1 << BITS
    parts = []
    for name, (lo, hi) in axes.items():
        x = F.floor((F.col(name).cast("double") - lo) / (hi - lo) * steps)
        x = F.coalesce(F.when(~F.isnan(F.col(name).cast("double")), x), F.lit(0))
        parts.append(_apart(F.least(F.lit(steps - 1), F.greatest(F.lit(0), x)).cast("long"), len(axes)))
    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(p, i) for i, p in enumerate(parts)])


def write_sliced(df: DataFrame, path: str, axes: Mapping[str, tuple[float, float]] = AXES, files: int | None = None, mode: str = "errorifexists") -> None:
    """df in Z order, about `files` files of even size (by default one for each FILE_ROWS rows), and its manifest."""
    if files is None:
        files = max(1, -(-df.count() // FILE_ROWS))
    out = df.withColumn("_z", z_key(axes)).repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z")
    out.write.mode(mode).parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    value = lambda a: F.when(~F.isnan(F.col(a).cast("double")), F.col(a).cast("double"))
    ends = [f(value(a)).alias(f"{a}_{n}") for a in axes for n, f in (("lo", F.min), ("hi", F.max))]
    manifest = held.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, axis_lo, axis_hi for each axis)"""
    return spark.read.parquet(f"{path}/_manifest")


def within(column: Column, ranges: Ranges) -> Column:
    return reduce(lambda a, b: a | b, [(column >= lo) & (column < hi) for lo, hi in ranges])


def slice_files(spark: SparkSession, path: str, bounds: Mapping[str, Ranges]) -> list[str]:
    """The files whose boxes meet the bounds."""
    hit = F.lit(True)
    for axis, ranges in bounds.items():
        hit = hit & reduce(lambda a, b: a | b, [(F.col(f"{axis}_hi") >= lo) & (F.col(f"{axis}_lo") < hi) for lo, hi in ranges])
    return sorted(r["file"] for r in read_manifest(spark, path).where(hit).select("file").collect())  # names of files, as the reader lists them too


def read_slice(spark: SparkSession, path: str, bounds: Mapping[str, Ranges]) -> DataFrame:
    """The rows within the half-open bounds of every axis named: only files that can have any are read."""
    files = slice_files(spark, path, bounds) if bounds else []
    whole = spark.read.parquet(path)
    if bounds and not files:
        return whole.where(F.lit(False))
    held = spark.read.schema(whole.schema).parquet(*[f"{path}/{f}" for f in files]) if bounds else whole
    for axis, ranges in bounds.items():
        held = held.where(within(F.col(axis), ranges))
    return held
