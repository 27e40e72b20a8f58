"""Readers: per-orbit text tables, sample tables, model tables, rasters; and the fixture view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.functions.names import orbit_number
from gridlark.functions.times import ephemeris_seconds, julian_date, parse_utc, unix_seconds
from gridlark.functions.units import wrap
from gridlark.schema import BODIES, BODY_COLUMNS, CHANNEL_GHZ, RAW_COLUMNS, nan_to_null

#: Names of files that may be broadcast.
BROADCAST_FILES = 100_000


def read_orbit_texts(spark: SparkSession, path: str, orbiter: str | None = None, pattern: str = "*2C") -> DataFrame:
    """(orbiter, orbit, raw columns as text, file): attached-label text tables below path, read recursively.

    The label ends with a line END and one separator line; rows follow. Lines
    are read in parallel with their byte order; a file's label ends at its first
    END. Of several files of one orbit the last by path counts; files without
    rows give none.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
    # names alone tell which files are not the last of their orbit; as there are few, texts are neither read twice nor shuffled
    names = _text_names(spark, path, pattern)
    former = names.join(names.groupBy("orbit").agg(F.max("file").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "orbit").where("file < _last").select("file")
    n = former.count()
    body = F.split(F.regexp_replace("value", r"(?s)\A(?:.*?\r?\n)??END[ \t]*\r?\n[^\n]*(?:\n|\z)", ""), r"\r?\n")
    held = files.select(F.col("_metadata.file_path").alias("file"), "value").withColumn("orbit", orbit_number(F.col("file"))).where("orbit is not null")
    if n:
        held = held.join(F.broadcast(former) if n <= BROADCAST_FILES else former, "file", "left_anti")
    held = held.select("file", "orbit", F.explode(body).alias("line"))
    fields = F.split(F.btrim("line"), r"\s+")
    rows = held.where(F.btrim("line") != "").select(F.lit(orbiter).alias("orbiter"), "orbit", *[F.get(fields, F.lit(i)).alias(c) for i, c in enumerate(RAW_COLUMNS)], "file")
    return rows


def _text_names(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(file, orbit) of the files, whose content is not read; files without a number are left out."""
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).format("binaryFile").load(path)
    return found.select(F.col("_metadata.file_path").alias("file")).withColumn("orbit", orbit_number(F.col("file"))).where("orbit is not null")


def empty_orbits(spark: SparkSession, path: str, pattern: str = "*2C") -> DataFrame:
    """(orbit) of the files without rows."""
    names = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).format("binaryFile").load(path).select(orbit_number(F.col("path")).alias("orbit"))
    return names.distinct().join(read_orbit_texts(spark, path, None, pattern).select("orbit").distinct(), "orbit", "left_anti")


def typed_samples(raw: DataFrame, ordered: bool = True) -> DataFrame:
    """Raw text columns to the sample table's types; the flag's zeros-only text becomes '0'; NaN becomes null; longitudes within [-180, 180).

    Rows are in order of orbit and time; with ordered=False only within a task, which
    has all of an orbit's: the order of all reads and parses every text twice.
    """
    real = {c: F.col(c).cast("float") for c in RAW_COLUMNS if c not in ("time", "flag")}
    out = raw.withColumns(real | {"utc": parse_utc(F.col("time")), "mflag": F.when(F.col("flag").rlike("^0+$"), F.lit("0")).otherwise(F.col("flag"))}).drop("time", "flag")
    seconds = unix_seconds(F.col("utc"))
    out = out.withColumns({"jd": julian_date(seconds), "et": ephemeris_seconds(seconds)})
    in_range = F.when(F.col("lon") <= 360, wrap(F.col("lon").cast("double"), -180.0, 360.0).cast("float")).otherwise(F.col("lon"))
    out = nan_to_null(out.withColumn("lon", in_range))
    return out.orderBy("orbit", "jd") if ordered else out.sortWithinPartitions("orbit", "jd")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def read_brightness(spark: SparkSession, path: str, channel: int, c: float) -> DataFrame:
    """The model table of a channel and a loss constant; keys are 32-bit, so they are compared as such."""
    t = spark.read.parquet(path)
    same = (F.col("freq") == F.lit(CHANNEL_GHZ[channel]).cast("float")) & (F.col("c") == F.lit(c).cast(t.schema["c"].dataType))
    return t.where(same).select("lat", "albedo", "h", "ltst", "tb")


def read_maps(spark: SparkSession, path: str, **equal: object) -> DataFrame:
    """Map products in order of their bins; conditions on orbiter, channel and maptype prune folders."""
    out = spark.read.parquet(path)
    for k, v in equal.items():
        out = out.where(F.col(k) == v)
    return out


def raster(spark: SparkSession, name: str, rows: list[list[float | None]], per_degree: int = 1) -> DataFrame:
    """(name, lat_ix, lon_ix, value, ppd) of a small dense array."""
    cells = [(name, i, j, None if v is None or v != v else float(v), per_degree) for i, row in enumerate(rows) for j, v in enumerate(row)]
    return spark.createDataFrame(cells, "name string, lat_ix int, lon_ix int, value double, ppd int")


def bodies(spark: SparkSession) -> DataFrame:
    """The catalogue of bodies: (name, BODY_COLUMNS)."""
    return spark.createDataFrame([(k, *v) for k, v in BODIES.items()], ", ".join(["name string", *(f"{c} double" for c in BODY_COLUMNS)]))


def metadata(df: DataFrame) -> Mapping[str, dict]:
    """Metadata attached to columns."""
    return {f.name: dict(f.metadata) for f in df.schema if f.metadata}


def samples_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample table that lineitem stands in for; integer arithmetic, then one division."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    c = F.col
    return li.select(
        F.when(c("l_linestatus") == "F", "a").otherwise("b").alias("orbiter"),
        c("l_suppkey").alias("orbit"), c("l_shipdate").alias("utc"),
        ((c("l_partkey") * 37 % 18000) / F.lit(100.0) - 90).alias("lat"),
        ((c("l_orderkey") * 53 % 36000) / F.lit(100.0) - 180).alias("lon"),
        (c("l_quantity") + 80).alias("d"),
        ((c("l_orderkey") * 7 + c("l_linenumber")) % 240 / F.lit(240.0)).alias("ltst"),
        (c("l_quantity") + 180).alias("t1"), (c("l_extendedprice") / 1000 + 180).alias("t2"),
        (c("l_discount") * 500 + 200).alias("t3"), (c("l_tax") * 500 + 190).alias("t4"),
        c("l_returnflag").alias("mflag"), c("l_orderkey").alias("key"), c("l_linenumber").alias("line"),
    )


def read_label_metadata(spark: SparkSession, path: str, pattern: str = "*2C") -> DataFrame:
    """(file, orbit, key, value) of the KEY = VALUE lines of attached labels; values without quotes; lines that go on are joined."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
    label = F.regexp_replace(F.regexp_extract("value", r"(?s)\A(.*?)(?:^|\n)END[ \t]*\r?\n", 1), r"\r?\n[ \t]+(?![A-Z_0-9:^]+[ \t]*=)", " ")
    held = files.select(F.col("_metadata.file_path").alias("file"), F.explode(F.split(label, r"\r?\n")).alias("line"))
    key, value = F.regexp_extract("line", r"^\s*([\w:^]+)\s*=\s*(.*?)\s*$", 1), F.regexp_extract("line", r"^\s*([\w:^]+)\s*=\s*(.*?)\s*$", 2)
    return held.select("file", orbit_number(F.col("file")).alias("orbit"), key.alias("key"), F.regexp_replace(value, '^"|"$', "").alias("value")).where("key <> ''")


def time_span(samples: DataFrame) -> DataFrame:
    """(orbit, start, stop): the first and last time of each orbit's table."""
    return samples.groupBy("orbit").agg(F.min("utc").alias("start"), F.max("utc").alias("stop"))


def spot_check(df: DataFrame, n: int = 5, seed: int = 0, columns: Sequence[str] | None = None) -> DataFrame:
    """n rows drawn by a seeded hash of the columns named (by default all): the same ones on any partitioning."""
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns or df.columns]).cast("binary"))
    return df.withColumn("_m", mark).orderBy("_m", *(columns or df.columns)).limit(n).drop("_m")


def orbit_texts(samples: DataFrame, label: Sequence[str] = ("PDS_VERSION_ID = 3", "RECORD_TYPE = STREAM"), stem: str = "SAMPLES_20071127", order: Sequence[str] = ("utc",)) -> DataFrame:
    """(name, label): an attached-label text table for each orbit, as read_orbit_texts reads them, to be written by fits.write_text_files.

    samples: orbit, RAW_COLUMNS' values (time as utc, flag as mflag) and the columns of order. A text holds one orbit's rows.
    """
    stamp = F.concat(F.date_format("utc", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    own = {"time": stamp, "flag": F.col("mflag")}
    row = F.concat_ws(" ", *[own.get(c, F.coalesce(F.col(c).cast("string"), F.lit("NaN")) if c in samples.columns else F.lit("0.0")) for c in RAW_COLUMNS])
    held = samples.groupBy("orbit").agg(F.sort_array(F.collect_list(F.struct(*order, row.alias("_row")))).alias("_rows"))
    text = F.concat(F.lit("\n".join([*label, "END", "---", ""])), F.array_join(F.transform("_rows", lambda x: x["_row"]), "\n"), F.lit("\n"))
    return held.select(F.format_string(f"{stem}_%04d_A.2C", F.col("orbit").cast("int")).alias("name"), text.alias("label"))
