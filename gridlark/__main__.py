"""Command line: maps of every channel and local-time bin, and products from them.

    python -m gridlark map SAMPLES OUT --orbiter a --channel 2 --hours 2 --resolution 0.25
    python -m gridlark products MAPS OUT --model MODEL
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridlark.functions.times import local_bin
from gridlark.operators.footprint import kernel
from gridlark.operators.residual import fit_latitude_trend, grid_residual, latitude_residual
from gridlark.plans import maps
from gridlark.schema import MapSpec
from gridlark.sources import sinks
from gridlark.sources.tables import read_maps, read_samples


def make_maps(spark: SparkSession, a: argparse.Namespace) -> None:
    """All slices in one pass over the samples; a folder each of orbiter, channel and bin. A finished output is left alone."""
    samples = read_samples(spark, a.samples).where(F.col("orbiter").isin(*a.orbiter))
    if a.bin:
        samples = samples.where(local_bin(F.col("ltst"), a.hours).isin(*[i * a.hours for i in a.bin]))
    spec = MapSpec("", 1, None, (-a.latitude, a.latitude), resolution=a.resolution, exclude_orbits=tuple(a.exclude_orbit))
    out = maps.footprint_maps(samples, spec, {c: kernel(spark, c, a.kernel_step) for c in a.channel}, a.hours, a.sigma or None)
    out = out.withColumn("bin_stop", F.col("bin_start") + a.hours)
    if not sinks.write_once(out, a.out, ["orbiter", "channel", "bin_start"], a.overwrite):
        print(f"{a.out} is complete; --overwrite makes it again")


def make_products(spark: SparkSession, a: argparse.Namespace) -> None:
    """TEMP, STDEV, LATSHIFT and, with a model, DATMINUS maps."""
    held = read_maps(spark, a.maps)
    keys = ["orbiter", "channel", "bin_start", "bin_stop", "lat_ix", "lon_ix", "lat", "lon"]
    kinds = [(held.select(*keys, F.col("mean").alias("value")), "TEMP"), (held.select(*keys, F.col("std").alias("value")), "STDEV")]
    temp = kinds[0][0]
    for row in temp.select("orbiter", "channel").distinct().collect():  # as many as there are instruments
        own = temp.where((F.col("orbiter") == row["orbiter"]) & (F.col("channel") == row["channel"]))
        kinds.append((latitude_residual(own, *fit_latitude_trend(own)), "LATSHIFT"))
    if a.model:
        kinds.append((grid_residual(temp, spark.read.parquet(a.model)), "DATMINUS"))
    for df, kind in kinds:
        if a.kind and kind not in a.kind:
            continue
        sinks.write_maps(df.withColumn("maptype", F.lit(kind)), a.out, mode="append")


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="gridlark")
    sub = p.add_subparsers(required=True)
    m = sub.add_parser("map")
    m.add_argument("samples")
    m.add_argument("out")
    m.add_argument("--orbiter", nargs="+", required=True)
    m.add_argument("--channel", nargs="+", type=int, default=[1, 2, 3, 4])
    m.add_argument("--hours", type=int, default=2)
    m.add_argument("--resolution", type=float, default=0.25)
    m.add_argument("--latitude", type=float, default=75.0)
    m.add_argument("--kernel-step", type=float, default=0.05)
    m.add_argument("--sigma", type=float, default=3.0, help="of the smoothing, in cells; 0 for none")
    m.add_argument("--bin", nargs="*", type=int, default=[], help="numbers of local-time bins; all by default")
    m.add_argument("--exclude-orbit", nargs="*", type=int, default=[])
    m.add_argument("--overwrite", action="store_true")
    m.set_defaults(run=make_maps)
    d = sub.add_parser("products")
    d.add_argument("maps")
    d.add_argument("out")
    d.add_argument("--model")
    d.add_argument("--kind", nargs="*", default=[], help="TEMP, STDEV, LATSHIFT, DATMINUS; all by default")
    d.set_defaults(run=make_products)
    a = p.parse_args(args)
    a.run(SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
