"""Tables written to the folder that all executors share: they cut lineage and outlive lost executors.

The folder is spark.checkpoint.dir; only a session without executors of its own
may go without, and then has a temporary one. Scratch tables that a returned plan
reads are deleted when the process ends, also after the session has been stopped.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyarrow import fs
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_roots: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="gridlark-"))
        _roots.add(_own[0])
    return _own[0]


def scratch_path(spark: SparkSession, what: str) -> str:
    """A path of its own, which goes when the process ends."""
    path = f"{shared_dir(spark)}/gridlark-{what}-{uuid.uuid4().hex}"
    _roots.add(path)
    return path


def delete(path: str) -> None:
    """Through Spark while a session runs, else through Arrow."""
    sc = SparkContext._active_spark_context
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    else:
        place, inner = fs.FileSystem.from_uri(path)
        if place.get_file_info(inner).type == fs.FileType.Directory:
            place.delete_dir(inner)
    _roots.discard(path)


@atexit.register
def delete_all() -> None:
    for path in sorted(_roots, reverse=True):
        with contextlib.suppress(Exception):  # another folder may still go
            delete(path)


def written(df: DataFrame, what: str) -> DataFrame:
    """df, written to the shared folder and read again: what was random or costly in it is fixed."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
