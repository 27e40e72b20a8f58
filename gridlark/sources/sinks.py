"""Writers: partitioned parquet with the reference layouts' content."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.functions.names import month_folder
from gridlark.operators.grids import flip_latitude
from gridlark.operators.residual import check_quantized, quantize

#: Columns of the exported sample table.
EXPORT = ["orbit", "utc", "et", "ltst", "t1", "t2", "t3", "t4", "lat", "lon", "d", "bx", "by", "bz", "cx", "cy", "cz", "mx", "my", "mz", "nx", "ny", "nz", "flag"]


def write_table(df: DataFrame, path: str, partition: Sequence[str] = (), row_group_bytes: int | None = None, mode: str = "errorifexists", metadata: Mapping[str, str] | None = None) -> None:
    """Parquet; metadata goes onto the first column, where a reader of the schema finds it."""
    if metadata:
        first = df.columns[0]
        df = df.withMetadata(first, dict(metadata))
    w = df.write.mode(mode)
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    if partition:
        w = w.partitionBy(*partition)
    w.parquet(path)


def write_clustered(df: DataFrame, path: str, by: str = "lat", row_group_bytes: int = 1 << 20, mode: str = "errorifexists") -> None:
    """Range-partitioned and sorted, with small row groups: a filter on `by` reads few of them."""
    write_table(df.repartitionByRange(by).sortWithinPartitions(by), path, row_group_bytes=row_group_bytes, mode=mode)


def write_samples(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The exported sample table, a folder an orbiter; times as text, normals in 32 bits."""
    have = [c for c in EXPORT if c in df.columns]
    out = df.select("orbiter", *have).withColumn("utc", F.date_format("utc", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    for c in ("nx", "ny", "nz"):
        if c in have:
            out = out.withColumn(c, F.col(c).cast("float"))
    write_table(out, path, ["orbiter"], mode=mode)


def write_maps(df: DataFrame, path: str, rows: int | None = None, value: str | None = None, mode: str = "errorifexists", provenance: Mapping[str, str] | None = None) -> None:
    """Map products keyed by orbiter, channel and maptype. rows: flip to north up; value: store as checked 16-bit steps; provenance: how they were made."""
    keys = [k for k in ("orbiter", "channel", "maptype") if k in df.columns]
    out = flip_latitude(df, rows) if rows else df
    if value:
        out = check_quantized(quantize(out, value, [*keys, *[k for k in ("bin_start",) if k in df.columns]]), value).drop(value)
    write_table(out, path, keys, mode=mode, metadata=provenance)


def write_by_month(df: DataFrame, path: str, ts: str = "utc", mode: str = "errorifexists") -> None:
    """A folder for each orbiter and month."""
    out = df.withColumn("month", F.element_at(F.split(month_folder(F.col("orbiter"), F.col(ts)), "/"), -1))
    write_table(out, path, ["orbiter", "month"], mode=mode)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table's writer has finished it."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame], overwrite: bool = False) -> DataFrame:
    """The table at path; made and written first if it isn't complete or is to be made again."""
    if overwrite or not complete(spark, path):
        write_once(make(), path, overwrite=True)
    return spark.read.parquet(path)


class Locked(RuntimeError):
    """Another writer holds the output."""


def write_once(df: DataFrame, path: str, partition: Sequence[str] = (), overwrite: bool = False) -> bool:
    """Writes unless the output is complete; whether it has written.

    A lock beside the output (a file that only one writer can make) keeps others
    out: they raise Locked. Rows go to a folder beside the output; when all are
    there, the old output is moved aside, the new one takes its place, and the old
    one is deleted. If anything fails, what was there before is there again.
    """
    spark = df.sparkSession
    place = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    at = path.rstrip("/")
    fs = place(at).getFileSystem(spark._jsc.hadoopConfiguration())
    if not overwrite and complete(spark, at):
        return False
    token = uuid.uuid4().hex
    lock, beside, aside = place(f"{at}__lock"), f"{at}__{token}", place(f"{at}__{token}_old")
    parent = place(at).getParent()
    if parent is not None:
        fs.mkdirs(parent)
    if not _made(fs, lock):
        raise Locked(f"{at} is being written; delete {lock} if no writer is left")
    try:
        write_table(df, beside, partition)
        _replace(fs, place(beside), place(at), aside)
    finally:
        fs.delete(place(beside), True)
        fs.delete(lock, False)
    return True


def _made(fs, path) -> bool:
    """Whether this call has made the file: false if it was there."""
    try:
        return bool(fs.createNewFile(path))
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception.getClass().getName()):
            return False
        raise


def _replace(fs, new, at, aside) -> None:
    """Moves new to at; what was there is moved aside, comes back if that fails, and is deleted last."""
    was = fs.exists(at)
    if was and not fs.rename(at, aside):
        raise OSError(f"cannot move {at} aside")
    try:
        if not fs.rename(new, at):
            raise OSError(f"cannot move {new} to {at}")
    except BaseException:
        if was:
            fs.rename(aside, at)
        raise
    if was:
        fs.delete(aside, True)


def write_labels(df: DataFrame, path: str, column: str = "label", mode: str = "errorifexists") -> None:
    """Label text, a file a partition."""
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)
